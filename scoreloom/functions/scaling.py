"""Probability to points, grade and band. Row expressions only, so they also run on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .. import config


def _first_match(x: Column, floors: Sequence[tuple[float, int]]) -> Column:
    """Code of the first floor (highest first) that ``x`` reaches, else 0; NULL and NaN give 0."""
    chain = F.when(x.isNull() | F.isnan(x), F.lit(0))
    for floor, code in floors:
        chain = chain.when(x >= F.lit(float(floor)), F.lit(code))
    return chain.otherwise(F.lit(0))


def log_odds(p: Column) -> Column:
    """``ln(p / (1 - p))``; infinite at 0 and 1, NULL where p is NULL or NaN."""
    return (
        F.when(p.isNull() | F.isnan(p), F.lit(None).cast("double"))
        .when(p >= 1, F.lit(float("inf")))
        .when(p <= 0, F.lit(float("-inf")))
        .otherwise(F.ln(p / (1 - p)))
    )


def points(
    odds: Column,
    base_score: float = config.BASE_SCORE,
    pdo: float = config.POINTS_TO_DOUBLE_ODDS,
    base_odds: float = config.BASE_ODDS,
) -> Column:
    """Points on the log-odds scale, rounded half-to-even; ``base_odds`` earn ``base_score``."""
    if pdo <= 0 or base_odds <= 0:
        raise ValueError("pdo and base_odds must be positive.")
    factor = F.lit(float(pdo)) / F.ln(F.lit(2.0))
    return F.bround(F.lit(float(base_score)) + factor * (odds - F.ln(F.lit(float(base_odds)))), 0)


def clamp(score: Column, low: float = config.MIN_SCORE, high: float = config.MAX_SCORE) -> Column:
    return F.when(
        score.isNotNull() & ~F.isnan(score), F.least(F.lit(high), F.greatest(F.lit(low), score))
    )


def grade(score: Column, score_type: str = "general", cutoffs=None) -> Column:
    cutoffs = cutoffs or config.GRADE_CUTOFFS
    if score_type not in cutoffs:
        raise ValueError(f"Unknown score type {score_type!r}; use one of {sorted(cutoffs)}.")
    return _first_match(score, cutoffs[score_type])


def band(p: Column) -> Column:
    """Evaluation band 1 (p >= 0.9) to 10 (p < 0.1); 0 for NULL, NaN and negative values."""
    return _first_match(p, config.BAND_FLOORS)
