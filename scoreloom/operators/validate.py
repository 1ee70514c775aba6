"""Data-quality checks on labelled and scoring snapshots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import config
from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column, is_missing


def has_columns(df: DataFrame, names: Sequence[str]) -> bool:
    """Schema check, no job."""
    return set(names) <= set(df.columns)


def null_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row with the number of missing values per listed column, from one scan."""
    return df.agg(*[F.count_if(is_missing(df, n)).alias(n) for n in names])


def has_no_nulls(df: DataFrame, names: Sequence[str]) -> bool:
    return not any(null_counts(df, names).first())


def duplicate_keys(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count; NULL equals NULL."""
    counted = df.groupBy(*[column(n) for n in names]).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.where(F.col("n_rows") > 1)


def has_duplicates(df: DataFrame, names: Sequence[str]) -> bool:
    return not duplicate_keys(df, names).isEmpty()


def _flags(
    df: DataFrame, snapshot: str, scoring: bool, spec: SnapshotSpec, id_type: str | None, month: Column | None = None
) -> DataFrame:
    """What the checks need of one snapshot that has its keys: customer ids and two null flags per row."""
    def any_missing(names: Sequence[str]) -> Column:
        return reduce(lambda a, b: a | b, [is_missing(df, n) for n in names], F.lit(False))

    check_target = not scoring and spec.target in df.columns
    customer = column(spec.customer_id)
    return df.select(
        (F.lit(snapshot) if month is None else month).alias("snapshot"),
        (customer.cast(id_type) if id_type else customer).alias("customer"),
        any_missing(spec.keys).cast("int").alias("null_key"),
        any_missing((spec.target,) if check_target else ()).cast("int").alias("null_target"),
    )


def validate_all(
    snapshots: Mapping[str, DataFrame],
    spec: SnapshotSpec = DEFAULT_SPEC,
    scoring: Sequence[str] | None = None,
) -> DataFrame:
    """First failing rule of each snapshot as ``(snapshot, ok, message)``, in one job for all.

    ``scoring`` lists the snapshots that must not carry the target; by default those whose name
    contains ``score``. Rows are combined per customer before the shuffle, so a value that fills
    a large part of a snapshot arrives as one row per task.
    """
    if scoring is None:
        scoring = [name for name in snapshots if "score" in name.lower()]
    session = next(iter(snapshots.values())).sparkSession
    facts = session.createDataFrame(
        [
            (name, has_columns(df, spec.keys), spec.target in df.columns, name in scoring)
            for name, df in snapshots.items()
        ],
        "snapshot string, has_keys boolean, has_target boolean, scoring boolean",
    )
    with_keys = {name: df for name, df in snapshots.items() if has_columns(df, spec.keys)}
    id_types = {df.schema[spec.customer_id].dataType for df in with_keys.values()}
    id_type = "string" if len(id_types) > 1 else None
    checked = [_flags(df, name, name in scoring, spec, id_type) for name, df in with_keys.items()]
    if checked:
        per_customer = (
            reduce(DataFrame.unionByName, checked)
            .groupBy("snapshot", "customer")
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.max("null_key").alias("null_key"),
                F.max("null_target").alias("null_target"),
            )
        )
        found = per_customer.groupBy("snapshot").agg(
            F.max("null_key").alias("null_key"),
            F.max((F.col("n_rows") > 1).cast("int")).alias("duplicate"),
            F.max("null_target").alias("null_target"),
        )
        facts = facts.join(found, "snapshot", "left")
    else:
        facts = facts.select("*", *[F.lit(0).alias(c) for c in ("null_key", "duplicate", "null_target")])

    failure = _failure(spec)
    return facts.select(
        "snapshot", failure.isNull().alias("ok"), F.coalesce(failure, F.lit(config.VALID)).alias("message")
    )


def validate_by_month(df: DataFrame, spec: SnapshotSpec = DEFAULT_SPEC, scoring: bool = False) -> DataFrame:
    """First failing rule of each month of one table as ``(snapshot, ok, message)``, from a single scan.

    Presence of columns is a matter of the whole table. A NULL month is a snapshot without name.
    """
    if not has_columns(df, spec.keys):
        found = df.select(*[column(n) for n in (spec.month,) if n in df.columns]).distinct()
        month = column(spec.month) if spec.month in df.columns else F.lit(None)
        return found.select(month.cast("string").alias("snapshot"), F.lit(False).alias("ok"), F.lit(config.MISSING_KEYS).alias("message"))
    flags = _flags(df.withColumn("__month", column(spec.month).cast("string")), "", scoring, spec, None, F.col("__month"))
    per_customer = flags.groupBy("snapshot", "customer").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("null_key").alias("null_key"), F.max("null_target").alias("null_target"))
    found = per_customer.groupBy("snapshot").agg(
        F.max("null_key").alias("null_key"),
        F.max((F.col("n_rows") > 1).cast("int")).alias("duplicate"),
        F.max("null_target").alias("null_target"),
    )
    facts = found.withColumns({"has_keys": F.lit(True), "has_target": F.lit(spec.target in df.columns), "scoring": F.lit(scoring)})
    failure = _failure(spec)
    return facts.select(
        "snapshot", failure.isNull().alias("ok"), F.coalesce(failure, F.lit(config.VALID)).alias("message")
    )


def _failure(spec: SnapshotSpec) -> Column:
    """Message of the first rule that fails, NULL when all hold."""
    return (
        F.when(~F.col("has_keys"), F.lit(config.MISSING_KEYS))
        .when(F.col("null_key") == 1, F.lit(config.NULL_KEYS))
        .when(F.col("duplicate") == 1, F.lit(config.DUPLICATE_ID.format(id=spec.customer_id)))
        .when(F.col("scoring") & F.col("has_target"), F.lit(config.EXTRA_TARGET.format(target=spec.target)))
        .when(~F.col("scoring") & ~F.col("has_target"), F.lit(config.NO_TARGET.format(target=spec.target)))
        .when(F.col("null_target") == 1, F.lit(config.NULL_TARGET.format(target=spec.target)))
    )


def validate_modeling_data(df: DataFrame, spec: SnapshotSpec = DEFAULT_SPEC) -> tuple[bool, str]:
    row = validate_all({"data": df}, spec, scoring=()).first()
    return row["ok"], row["message"]


def validate_score_data(df: DataFrame, spec: SnapshotSpec = DEFAULT_SPEC) -> tuple[bool, str]:
    row = validate_all({"data": df}, spec, scoring=("data",)).first()
    return row["ok"], row["message"]


def schema_match(train: DataFrame, test: DataFrame, target: str = DEFAULT_SPEC.target) -> tuple[bool, str]:
    """Both snapshots carry the target and list the same columns in the same order."""
    if target not in train.columns or target not in test.columns:
        return False, config.TARGET_CHECK
    if train.columns != test.columns:
        return False, config.SCHEMA_MISMATCH
    return True, config.VALID


def require_schema_match(train: DataFrame, test: DataFrame, target: str = DEFAULT_SPEC.target) -> None:
    ok, message = schema_match(train, test, target)
    if not ok:
        raise ValueError(message)
