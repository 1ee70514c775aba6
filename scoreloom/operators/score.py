"""Applying a model: probability, log-odds, points, grade. Narrow operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import config
from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions import scaling
from ..functions.expressions import column, prefix_columns
from .prepare import align

SCORE_COLUMNS = ("probability", "log_odds", "score", "grade")


def with_probability(df: DataFrame, model: Transformer, name: str = "probability") -> DataFrame:
    """Add the probability of class 1; the model's own output columns are dropped."""
    scored = model.transform(df)
    return scored.select(
        *[column(n) for n in df.columns], vector_to_array(F.col("probability")).getItem(1).alias(name)
    )


def with_score(
    df: DataFrame,
    probability: str = "probability",
    score_type: str = "general",
    base_score: float = config.BASE_SCORE,
    pdo: float = config.POINTS_TO_DOUBLE_ODDS,
    base_odds: float = config.BASE_ODDS,
    cutoffs=None,
) -> DataFrame:
    """Add log-odds, clamped points and grade."""
    scored = df.withColumn("log_odds", scaling.log_odds(column(probability)))
    scored = scored.withColumn(
        "score", scaling.clamp(scaling.points(F.col("log_odds"), base_score, pdo, base_odds))
    )
    return scored.withColumn("grade", scaling.grade(F.col("score"), score_type, cutoffs))


def score_snapshot(
    encoded: DataFrame,
    features: Sequence[str],
    model: Transformer | Column,
    spec: SnapshotSpec = DEFAULT_SPEC,
    **options,
) -> DataFrame:
    """Keys, probability, log-odds, points and grade of an encoded snapshot.

    ``model`` is a fitted model, or a probability expression over the feature columns.
    """
    aligned = align(encoded, features, carry=spec.keys)
    if isinstance(model, Column):
        with_p = aligned.withColumn("probability", model)
    else:
        with_p = with_probability(aligned, model)
    scored = with_score(with_p, **options)
    return scored.select(*[column(k) for k in spec.keys if k in encoded.columns], *SCORE_COLUMNS)


def grade_distribution(scored: DataFrame, score_type: str = "general") -> DataFrame:
    """Rows and percentage per grade; columns carry the score type as prefix.

    The total runs over at most nine grade rows.
    """
    counts = scored.groupBy("grade").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return prefix_columns(
        counts.withColumn("percentage", F.col("count") / total * 100), f"{score_type}_"
    )
