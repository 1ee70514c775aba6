"""Model evaluation on one frame that holds label and probability side by side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..config import DEFAULT_SPEC
from ..functions.expressions import as_number, column, divergence, ratio
from ..functions.scaling import band
from . import ranges


def roc_auc(
    df: DataFrame,
    score: str = "probability",
    label: str = DEFAULT_SPEC.target,
    groups: Sequence[str] = (),
    rows_per_range: int = ranges.ROWS_PER_RANGE,
) -> DataFrame:
    """Exact area under the ROC curve, one row per group; tied scores count one half.

    Pairs are counted within score ranges in parallel and between ranges from their totals, so
    neither a large group nor a frequent score ends up in one task. NULL when a group has one
    class only; rows without score or label do not count.
    """
    rows = df.select(
        *[column(g) for g in groups], as_number(df, score).alias("score"), column(label).cast("int").alias("label")
    ).where(F.col("score").isNotNull() & F.col("label").isNotNull())
    n_rows = df.count()  # reads no column
    points = ranges.split_points(rows, ["score"], n_rows, ranges.range_count(n_rows, rows_per_range))
    by_group = list(groups)
    per_score = (
        ranges.with_ranges(rows, points)
        .groupBy(*by_group, "score_range", "score")
        .agg(
            F.sum(F.when(F.col("label") == 1, 1.0).otherwise(0.0)).alias("pos"),
            F.sum(F.when(F.col("label") == 1, 0.0).otherwise(1.0)).alias("neg"),
        )
    )
    inside = (
        Window.partitionBy(*by_group, "score_range").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    )
    per_range = (
        per_score.withColumn("won", F.col("pos") * (F.sum("neg").over(inside) - F.col("neg") / 2))
        .groupBy(*by_group, "score_range")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"))
    )
    earlier = Window.partitionBy(*by_group).orderBy("score_range").rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        per_range.withColumn("below", F.coalesce(F.sum("neg").over(earlier), F.lit(0.0)))
        .groupBy(*by_group)
        .agg(
            F.sum(F.col("won") + F.col("pos") * F.col("below")).alias("won"),
            (F.sum("pos") * F.sum("neg")).alias("pairs"),
        )
    )
    return summed.select(*[column(g) for g in groups], F.try_divide("won", "pairs").alias("roc_auc"))


def auc_value(df: DataFrame, score: str = "probability", label: str = DEFAULT_SPEC.target) -> float | None:
    return roc_auc(df, score, label).first()["roc_auc"]


def with_band(df: DataFrame, probability: str = "probability", name: str = "scale") -> DataFrame:
    return df.withColumn(name, band(column(probability)))


def band_summary(
    df: DataFrame, split: str = "split", target: str = DEFAULT_SPEC.target, scale: str = "scale"
) -> DataFrame:
    """Rows, responders and their shares per split and band, in one aggregation."""
    whole = Window.partitionBy(column(split))
    return (
        df.groupBy(column(split), column(scale))
        .agg(F.count(F.lit(1)).alias("sample_count"), F.sum(column(target).cast("bigint")).alias("target_count"))
        .withColumn("composition_ratio", ratio(F.col("sample_count"), F.sum("sample_count").over(whole)))
        .withColumn("target_rate", ratio(F.col("target_count"), F.col("sample_count")))
    )


def band_combined(
    summary: DataFrame, split: str = "split", scale: str = "scale", base: str = "val", compare: str = "test"
) -> DataFrame:
    """Bands of ``base`` beside those of ``compare``; bands only in ``compare`` are left out.

    A summary has one row per split and band, so the maximum over a band's rows of a split is that row's
    value; both sides come from one pass over the summary.
    """
    measures = ("sample_count", "target_count", "composition_ratio", "target_rate")
    sides = [
        F.max(F.when(column(split) == tag, F.col(m))).alias(f"{m}_{tag}") for tag in (base, compare) for m in measures
    ]
    return summary.groupBy(column(scale)).agg(*sides).where(F.col(f"sample_count_{base}").isNotNull())


def score_psi(combined: DataFrame, base: str = "val", compare: str = "test") -> DataFrame:
    """Stability of the band shares; bands missing in ``compare`` add nothing."""
    term = divergence(F.col(f"composition_ratio_{base}"), F.col(f"composition_ratio_{compare}"))
    return combined.agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"))
