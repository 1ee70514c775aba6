"""Evaluation and scoring on given probabilities, and registry look-ups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT_SPEC
from ..functions.expressions import model_stamp
from ..operators import evaluate, score
from ..operators.prepare import FeatureEncoder
from ..sources import registry, tables
from ..sources.snapshots import write_scores
from ..sources.workspace import fresh_path
from .base import LINES, SNAPSHOT, query, rounded

W = f"WITH {LINES}"

# -- evaluation -------------------------------------------------------------------------------


def _auc_sql(source: str, groups: str, score_column: str, label: str) -> str:
    by = f"PARTITION BY {groups} " if groups else ""
    listed = f"{groups}, " if groups else ""
    final = f" GROUP BY {groups}" if groups else ""
    return f"""
per_score AS (
  SELECT {listed}{score_column} AS s, count(*) FILTER (WHERE {label} = 1) AS pos, count(*) FILTER (WHERE {label} = 0) AS neg
  FROM {source} GROUP BY {listed}{score_column}
),
ranked AS (SELECT *, sum(neg) OVER ({by}ORDER BY s) AS upto FROM per_score)
SELECT {listed}round(sum(pos * (upto - neg / 2.0)) / nullif(sum(pos) * sum(neg), 0), 6) AS roc_auc FROM ranked{final}"""


@query("eval_roc_auc", f"{W},{_auc_sql('lines', 'split', 'probability', 'PERF')}")
def eval_roc_auc(spark, folder):
    return rounded(evaluate.roc_auc(tables.scored_lines(spark, folder), groups=["split"]))


PRICED = """
priced AS (SELECT l_returnflag, l_extendedprice, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS PERF FROM lineitem)
"""


@query("eval_roc_auc_by_group", f"WITH {PRICED},{_auc_sql('priced', 'l_returnflag', 'l_extendedprice', 'PERF')}")
def eval_roc_auc_by_group(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select(
        "l_returnflag", "l_extendedprice", (F.col("l_quantity") > 25).cast("int").alias("PERF")
    )
    return rounded(evaluate.roc_auc(lines, "l_extendedprice", groups=["l_returnflag"]))


BANDS = "CASE " + " ".join(
    f"WHEN probability >= {floor} THEN {code}"
    for floor, code in (
        ("0.9", 1), ("0.8", 2), ("0.7", 3), ("0.6", 4), ("0.5", 5), ("0.4", 6), ("0.3", 7), ("0.2", 8), ("0.1", 9), ("0.0", 10),
    )
) + " ELSE 0 END"


@query("eval_scale", f"{W} SELECT l_orderkey, l_linenumber, probability, {BANDS} AS scale FROM lines")
def eval_scale(spark, folder):
    lines = tables.scored_lines(spark, folder).select("l_orderkey", "l_linenumber", "probability")
    return evaluate.with_band(lines)


BAND_SUMMARY = f"""{W}, bands AS (
  SELECT split, {BANDS} AS scale, count(*) AS sample_count, CAST(sum(PERF) AS BIGINT) AS target_count
  FROM lines GROUP BY 1, 2
),
shares AS (
  SELECT *, sample_count / sum(sample_count) OVER (PARTITION BY split) AS composition_ratio,
         target_count / sample_count AS target_rate
  FROM bands
)"""
MEASURES = ("sample_count", "target_count", "composition_ratio", "target_rate")


def _band_summary(spark, folder):
    return evaluate.band_summary(evaluate.with_band(tables.scored_lines(spark, folder)))


@query(
    "eval_band_summary",
    f"{BAND_SUMMARY} SELECT split, scale, sample_count, target_count, round(composition_ratio, 6) AS composition_ratio, "
    "round(target_rate, 6) AS target_rate FROM shares",
)
def eval_band_summary(spark, folder):
    return rounded(_band_summary(spark, folder))


@query(
    "eval_band_combined",
    f"{BAND_SUMMARY} SELECT v.scale, "
    + ", ".join(
        (f"round({side}.{m}, 6)" if m.endswith(("ratio", "rate")) else f"{side}.{m}") + f" AS {m}_{name}"
        for side, name in (("v", "val"), ("t", "test")) for m in MEASURES
    )
    + " FROM (SELECT * FROM shares WHERE split = 'val') v LEFT JOIN (SELECT * FROM shares WHERE split = 'test') t "
    "ON v.scale = t.scale",
)
def eval_band_combined(spark, folder):
    return rounded(evaluate.band_combined(_band_summary(spark, folder)))


@query(
    "eval_psi",
    f"{BAND_SUMMARY} SELECT round(coalesce(sum((v.composition_ratio - t.composition_ratio) * "
    "ln(v.composition_ratio / t.composition_ratio)), 0), 6) AS psi "
    "FROM (SELECT * FROM shares WHERE split = 'val') v LEFT JOIN (SELECT * FROM shares WHERE split = 'test') t "
    "ON v.scale = t.scale",
)
def eval_psi(spark, folder):
    return rounded(evaluate.score_psi(evaluate.band_combined(_band_summary(spark, folder))))


# -- scoring ----------------------------------------------------------------------------------

GRADES = "CASE WHEN score >= 638 THEN 1 " + " ".join(
    f"WHEN score >= {low} THEN {code}" for low, code in ((582, 2), (538, 3), (498, 4), (457, 5), (418, 6), (322, 7), (1, 8))
) + " ELSE 0 END"


def _score_sql(source: str, base: float = 600, pdo: float = 40, odds: float = 1) -> str:
    return f"""
logged AS (
  SELECT *, CASE WHEN probability >= 1 THEN CAST('inf' AS DOUBLE) WHEN probability <= 0 THEN CAST('-inf' AS DOUBLE)
                 ELSE ln(probability / (1 - probability)) END AS log_odds
  FROM {source}
),
pointed AS (
  SELECT *, CASE WHEN isinf(log_odds) THEN log_odds
                 ELSE round_even(CAST({base} AS DOUBLE) + {pdo} / ln(2) * (log_odds - ln({odds})), 0) END AS points
  FROM logged
),
clamped AS (SELECT *, least(1000, greatest(1, points)) AS score FROM pointed),
graded AS (SELECT *, {GRADES} AS grade FROM clamped)"""


SCORED = f"{W},{_score_sql('lines')}"
IDS = "l_orderkey, l_linenumber, probability"
FINITE_ODDS = "CASE WHEN isinf(log_odds) THEN NULL ELSE round(log_odds, 6) END AS log_odds, isinf(log_odds) AS is_infinite"


def _scored(spark, folder, **options):
    return score.with_score(tables.scored_lines(spark, folder), **options)


@query("score_log_odds", f"{SCORED} SELECT {IDS}, {FINITE_ODDS} FROM graded")
def score_log_odds(spark, folder):
    infinite = F.abs("log_odds") == float("inf")
    return _scored(spark, folder).select(
        "l_orderkey", "l_linenumber", "probability",
        F.when(~infinite, F.round("log_odds", 6)).alias("log_odds"), infinite.alias("is_infinite"),
    )


def _points_sql(base=600, pdo=40, odds=1):
    return (
        f"{W},{_score_sql('lines', base, pdo, odds)} "
        f"SELECT {IDS}, CASE WHEN isinf(points) THEN NULL ELSE points END AS points, isinf(points) AS is_infinite FROM graded"
    )


def _points(spark, folder, **options):
    lines = tables.scored_lines(spark, folder)
    odds = score.scaling.log_odds(F.col("probability"))
    points = lines.select("l_orderkey", "l_linenumber", "probability", score.scaling.points(odds, **options).alias("points"))
    infinite = F.abs("points") == float("inf")
    return points.withColumn("is_infinite", infinite).withColumn("points", F.when(~infinite, F.col("points")))


@query("score_points", _points_sql())
def score_points(spark, folder):
    return _points(spark, folder)


@query("score_points_custom", _points_sql(500, 20, 2))
def score_points_custom(spark, folder):
    return _points(spark, folder, base_score=500, pdo=20, base_odds=2)


@query("score_clamp", f"{SCORED} SELECT {IDS}, score FROM graded")
def score_clamp(spark, folder):
    return _scored(spark, folder).select("l_orderkey", "l_linenumber", "probability", "score")


@query("score_grade", f"{SCORED} SELECT {IDS}, score, grade FROM graded")
def score_grade(spark, folder):
    return _scored(spark, folder).select("l_orderkey", "l_linenumber", "probability", "score", "grade")


@query("score_grade_single", f"{SCORED} SELECT {IDS}, score, grade FROM graded")
def score_grade_single(spark, folder):
    scored = _scored(spark, folder, score_type="single")
    return scored.select("l_orderkey", "l_linenumber", "probability", "score", "grade")


@query(
    "score_grade_distribution",
    f"{SCORED} SELECT grade AS general_grade, count(*) AS general_count, "
    "round(count(*) / sum(count(*)) OVER () * 100, 6) AS general_percentage FROM graded GROUP BY grade",
)
def score_grade_distribution(spark, folder):
    return rounded(score.grade_distribution(_scored(spark, folder)))


# A fixed probability over encoded features stands in for a trained model.
MODEL_FEATURES = ["total_price", "segment_BUILDING", "urgent_status_0", "pending_price"]


def _fixed_model():
    strength = F.col("total_price") * (1 + F.col("segment_BUILDING")) + F.col("pending_price")
    return strength / (strength + F.lit(400000.0) * (1 + F.col("urgent_status_0")))


MONTH = f"""WITH {SNAPSHOT}, strengths AS (
  SELECT base_ym, customer_id, customer_hash,
         total_price * CASE WHEN segment = 'BUILDING' THEN 2 ELSE 1 END + coalesce(pending_price, 0) AS strength,
         400000.0 * CASE WHEN urgent_status IS NULL THEN 2 ELSE 1 END AS scale
  FROM score
),
probabilities AS (
  SELECT base_ym, customer_id, customer_hash, strength / (strength + CAST(scale AS DOUBLE)) AS probability FROM strengths
),{_score_sql('probabilities')}
SELECT base_ym, customer_id, customer_hash, round(probability, 6) AS probability, round(log_odds, 6) AS log_odds,
       score, grade FROM graded"""


def _scored_month(spark, folder):
    encoder = FeatureEncoder.fit(tables.snapshot(spark, folder, "TRAIN"))
    encoded = encoder.transform(tables.snapshot(spark, folder, "SCORE"))
    return score.score_snapshot(encoded, MODEL_FEATURES, _fixed_model())


@query("score_month", MONTH)
def score_month(spark, folder):
    return rounded(_scored_month(spark, folder))


@query("sink_scores", f"SELECT *, 'general' AS score_type FROM ({MONTH})")
def sink_scores(spark, folder):
    path = write_scores(_scored_month(spark, folder), fresh_path(spark, "scores"), "general")
    written = spark.read.parquet(path)
    return rounded(
        written.withColumn("base_ym", F.col("base_ym").cast("string"))
        .select(*DEFAULT_SPEC.keys, *score.SCORE_COLUMNS, "score_type")
    )


# -- registry tables --------------------------------------------------------------------------
# Every day of events stands for a model run; event types stand for its variables.

TYPES = "CASE WHEN event_type IN ('view', 'click') THEN 'xgb' ELSE 'lgb' END"
RUNS = f"""WITH runs AS (
  SELECT {TYPES} AS model_type, concat({TYPES}, '_', strftime(date_trunc('day', ts), '%y%m%d_%H%M%S')) AS model_name,
         event_type AS variable, value
  FROM events
),
importance AS (
  SELECT model_type, model_name, variable, round(sum(value) - 50 * count(*), 2) AS importance FROM runs GROUP BY 1, 2, 3
)"""


def _importance(spark, folder):
    kind = F.when(F.col("event_type").isin("view", "click"), "xgb").otherwise("lgb")
    day = F.date_trunc("day", "ts")
    name = F.when(kind == "xgb", model_stamp("xgb", day)).otherwise(model_stamp("lgb", day))
    return (
        tables.table(spark, folder, "events")
        .groupBy(kind.alias("model_type"), name.alias("model_name"), F.col("event_type").alias("variable"))
        .agg(F.round(F.sum("value") - 50 * F.count(F.lit(1)), 2).alias("importance"))
    )


@query(
    "registry_latest",
    f"{RUNS} SELECT model_name, variable, importance FROM importance WHERE model_type = 'xgb' AND model_name = "
    "(SELECT max(model_name) FROM importance WHERE model_type = 'xgb')",
)
def registry_latest(spark, folder):
    importance = _importance(spark, folder)
    models = importance.select("model_type", "model_name").distinct()
    return registry.latest_importance(models, importance.drop("model_type"), "xgb")


@query("select_by_importance", f"{RUNS} SELECT * FROM importance WHERE importance > 0")
def select_by_importance(spark, folder):
    return registry.select_by_importance(_importance(spark, folder))


@query("registry_model_name", "SELECT event_id, strftime(ts, 'xgb_%y%m%d_%H%M%S') AS model_name FROM events")
def registry_model_name(spark, folder):
    return tables.table(spark, folder, "events").select("event_id", model_stamp("xgb", F.col("ts")).alias("model_name"))
