"""Reading and writing snapshots and result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column, nan_to_null


def read_snapshot(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    fmt: str | None = None,
    spec: SnapshotSpec = DEFAULT_SPEC,
) -> DataFrame:
    """Snapshot table with header names, NaN turned to NULL, and month, dates and times kept as text.

    Text is what makes a date categorical, as any other code. CSV without ``schema`` costs one extra pass for type inference.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", schema is None)
    df = nan_to_null(reader.format(fmt).load(path))
    if spec.month in df.columns and not isinstance(df.schema[spec.month].dataType, T.StringType):
        df = df.withColumn(spec.month, column(spec.month).cast("string"))
    moments = (T.DateType, T.TimestampType, T.TimestampNTZType)
    return df.withColumns({f.name: column(f.name).cast("string") for f in df.schema if isinstance(f.dataType, moments)})


def read_month(spark: SparkSession, path: str, month: str, spec: SnapshotSpec = DEFAULT_SPEC) -> DataFrame:
    """One month of a table laid out by month; only that partition is scanned."""
    df = read_snapshot(spark, path, fmt="parquet", spec=spec)
    return df.where(column(spec.month) == F.lit(month))


def month_file(folder: str, month: str, scoring: bool = False) -> str:
    """Path of a month-addressed CSV: labelled and scoring snapshots differ in the stem."""
    stem = "sample_score_data" if scoring else "sample_data"
    return f"{folder.rstrip('/')}/{stem}_{month}.csv"


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_labelled(df: DataFrame, folder: str, month: str) -> str:
    return write_csv(df, month_file(folder, month))


def write_unlabelled(df: DataFrame, folder: str, month: str, spec: SnapshotSpec = DEFAULT_SPEC) -> str:
    return write_csv(df.drop(spec.target), month_file(folder, month, scoring=True))


def write_by_month(df: DataFrame, path: str, spec: SnapshotSpec = DEFAULT_SPEC, mode: str = "overwrite") -> str:
    """Table laid out by month.

    No shuffle on the month: that would put a whole month into one task. A writing task opens
    one file per month it holds, and snapshots arrive one or few months at a time.
    """
    df.write.mode(mode).partitionBy(spec.month).parquet(path)
    return path


def write_scores(scored: DataFrame, path: str, score_type: str, spec: SnapshotSpec = DEFAULT_SPEC) -> str:
    """Scored table: keys first, then the score columns, by score type and month.

    Writing a month again replaces that month of that score type only.
    """
    rest = [n for n in scored.columns if n not in spec.keys and n != "score_type"]
    ordered = scored.select(
        *[column(n) for n in (*spec.keys, *rest)], F.lit(score_type).alias("score_type")
    )
    (
        ordered.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("score_type", spec.month)
        .parquet(path)
    )
    return path


def write_table(df: DataFrame, folder: str, kind: str, run_id: str) -> str:
    """Result table of one run, for example ``iv`` or ``psi``."""
    path = f"{folder.rstrip('/')}/{kind}/run_id={run_id}"
    df.write.mode("overwrite").parquet(path)
    return path
