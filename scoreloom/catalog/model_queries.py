"""Queries that train.

A booster of one stump on features with few values can be written in SQL, split by split; larger
models cannot, so tests check their properties.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from .. import config
from ..config import DEFAULT_SPEC
from ..operators import evaluate, model as learning
from ..operators.prepare import Prepared, prepare_development
from ..operators.score import with_probability
from ..plans.development import DevelopmentRun, train_and_register
from ..plans.evaluation import EvaluationRun
from ..plans.scoring import ScoringRun
from ..sources import tables
from ..sources.registry import ModelRegistry, model_name
from ..sources.workspace import fresh_path, stored
from .base import SNAPSHOT, query, stored_both
from .score_queries import GRADES

SMALL = {"max_depth": 3, "learning_rate": 0.1, "n_estimators": 5}
# Far more rounds than the patience: the validation measure stops the fit.
STOPPED = {"max_depth": 3, "learning_rate": 0.1, "n_estimators": 40}
STUMP = {"max_depth": 1, "learning_rate": 0.1, "n_estimators": 1}
STUMP_FEATURES = (
    "is_overdrawn", "n_urgent", "region_key",
    "segment_AUTOMOBILE", "segment_BUILDING", "segment_FURNITURE", "segment_HOUSEHOLD", "segment_MACHINERY",
)
# The ranges of a preset, with fewer rounds than its 10 to 300 or 500, though more than the patience, and lower trees.
QUICK = {"n_estimators": (12, 20), "max_depth": (2, 4)}
WHOLE = {**config.SEARCH_BOUNDS["xgb"], "n_estimators": (14, 20), "max_depth": (2, 3)}
TRIALS = 3
MOMENT, LATER = datetime(2024, 1, 1, 9, 0, 0), datetime(2024, 1, 1, 10, 0, 0)


def _prepared(spark, folder) -> Prepared:
    prepared = prepare_development(*stored_both(spark, folder))
    return Prepared(stored(prepared.data, "prepared", "split"), prepared.encoder)


def _fit(prepared: Prepared, params=SMALL) -> learning.Fitted:
    return learning.fit_model(prepared.part("train"), prepared.part("val"), prepared.encoder.names, params)


def _report(prepared: Prepared, fitted: learning.Fitted) -> DataFrame:
    scored = with_probability(prepared.data, fitted.model)
    return evaluate.roc_auc(scored, groups=["split"]).withColumn("rounds", F.lit(fitted.rounds))


def _registered(spark, folder, bounds=WHOLE, trials=TRIALS) -> ModelRegistry:
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    train_and_register(_prepared(spark, folder), registry, model_name("xgb", MOMENT), "xgb", bounds, trials, parallelism=trials)
    return registry


@query("train_gbt")
def train_gbt(spark, folder):
    prepared = _prepared(spark, folder)
    return _report(prepared, _fit(prepared, STOPPED))


@query("train_gbt_lgb_preset")
def train_gbt_lgb_preset(spark, folder):
    prepared = _prepared(spark, folder)
    return _report(prepared, _fit(prepared, {**STOPPED, "min_child_samples": 20, "colsample_bytree": 0.8, "num_leaves": 31}))


STUMP_SQL = f"""WITH {SNAPSHOT}, encoded AS (
  SELECT base_ym, customer_id, customer_hash, PERF, data_type,
         md5(concat('42:', CAST(customer_id AS VARCHAR))) < '4ccccccd' AS is_val,
         CAST(is_overdrawn AS INTEGER) AS is_overdrawn, n_urgent, region_key,
         {", ".join(f"CAST(segment = '{n.split('_')[1]}' AS INTEGER) AS {n}" for n in STUMP_FEATURES[3:])}
  FROM snap
), fitted AS (
  SELECT 2.0 * PERF - 1 AS y, CAST(COLUMNS(* EXCLUDE (PERF)) AS DOUBLE)
  FROM (SELECT PERF, {", ".join(STUMP_FEATURES)} FROM encoded WHERE data_type = 'TRAIN' AND NOT is_val)
), long AS (
  SELECT y, name, value FROM fitted UNPIVOT (value FOR name IN ({", ".join(STUMP_FEATURES)}))
), per_value AS (
  SELECT name, value, count(*) AS n, sum(y) AS s FROM long GROUP BY name, value
), cuts AS (
  SELECT name, (value + lead(value) OVER (PARTITION BY name ORDER BY value)) / 2 AS cut,
         sum(n) OVER (PARTITION BY name ORDER BY value) AS n, sum(s) OVER (PARTITION BY name ORDER BY value) AS s,
         sum(n) OVER (PARTITION BY name) AS whole_n, sum(s) OVER (PARTITION BY name) AS whole_s
  FROM per_value
), best AS (
  SELECT name, cut, s / n AS below, (whole_s - s) / (whole_n - n) AS above FROM cuts WHERE cut IS NOT NULL
  ORDER BY s * s / n + (whole_s - s) * (whole_s - s) / (whole_n - n) DESC, name LIMIT 1
), applied AS (
  SELECT base_ym, customer_id, customer_hash, name, value
  FROM (SELECT base_ym, customer_id, customer_hash, CAST(COLUMNS([{", ".join(f"'{n}'" for n in STUMP_FEATURES)}]) AS DOUBLE)
        FROM encoded WHERE data_type = 'TEST')
  UNPIVOT (value FOR name IN ({", ".join(STUMP_FEATURES)}))
)
"""


def _stump(spark, folder) -> tuple[Prepared, learning.Fitted]:
    prepared = _prepared(spark, folder)
    few = Prepared(prepared.data, prepared.encoder.restricted(STUMP_FEATURES))
    return few, _fit(few, STUMP)


@query("score_probability_stump", STUMP_SQL + """
SELECT a.base_ym, a.customer_id, a.customer_hash,
       round(1 / (1 + exp(-2 * CASE WHEN a.value <= b.cut THEN b.below ELSE b.above END)), 6) AS probability
FROM applied a JOIN best b ON a.name = b.name""")
def score_probability_stump(spark, folder):
    """Probabilities of a booster of one stump, split and leaves learned from the training rows."""
    few, fitted = _stump(spark, folder)
    scored = with_probability(few.part("test"), fitted.model)
    return scored.select(*DEFAULT_SPEC.keys, F.round("probability", 6).alias("probability"))


@query("importance_stump", STUMP_SQL + f"""
SELECT v.variable, CAST(v.variable = b.name AS DOUBLE) AS importance, CAST(v.variable = b.name AS BIGINT) AS split
FROM (SELECT unnest([{", ".join(f"'{n}'" for n in STUMP_FEATURES)}]) AS variable) v, best b""")
def importance_stump(spark, folder):
    _, fitted = _stump(spark, folder)
    return learning.importance_table(fitted).select("variable", "importance", "split")


@query("monthly_scoring_stump", STUMP_SQL + f""", monthly AS (
  SELECT customer_id, CAST(is_overdrawn AS DOUBLE) AS is_overdrawn, CAST(n_urgent AS DOUBLE) AS n_urgent,
         CAST(region_key AS DOUBLE) AS region_key,
         {", ".join(f"CAST(segment = '{n.split('_')[1]}' AS DOUBLE) AS {n}" for n in STUMP_FEATURES[3:])}
  FROM score
), points AS (
  SELECT least(1000, greatest(1, round_even(600 + 40 / ln(2) * (2 * CASE WHEN m.value <= b.cut THEN b.below ELSE b.above END), 0)))
         AS score
  FROM (SELECT name, value FROM monthly UNPIVOT (value FOR name IN ({", ".join(STUMP_FEATURES)}))) m JOIN best b ON m.name = b.name
)
SELECT grade AS general_grade, count(*) AS general_count,
       round(count(*) / sum(count(*)) OVER () * 100, 6) AS general_percentage
FROM (SELECT {GRADES} AS grade FROM points) GROUP BY grade""")
def monthly_scoring_stump(spark, folder):
    """A registered model scores two months one after the other; the last month's distribution is returned."""
    few, fitted = _stump(spark, folder)
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    name = model_name("xgb", MOMENT)
    for _ in range(2):  # a run that is tried again leaves what one run leaves
        registry.save_model(name, fitted.model)
        registry.append_encoder(name, few.encoder)
        registry.append_importance(name, [(n, 0.0, 0, 0.0) for n in few.encoder.names])
        registry.append_result(name, "xgb", len(few.encoder.names), 0.5, 0.5, 0.5)
    run = ScoringRun(registry, fresh_path(spark, "scores"))
    month = tables.snapshot(spark, folder, "SCORE")
    run.run(tables.snapshot(spark, folder, "TEST").drop("PERF"))
    for _ in range(2):
        found = run.run(month)
    return found.withColumn("general_percentage", F.round("general_percentage", 6))


EVALUATED = STUMP_SQL + """, rated AS (
  SELECT e.split, e.PERF, CASE WHEN e.value <= b.cut THEN b.below ELSE b.above END AS s
  FROM (SELECT split, PERF, name, value FROM (
          SELECT CASE WHEN data_type = 'TEST' THEN 'test' ELSE 'val' END AS split, PERF, {features}
          FROM encoded WHERE data_type = 'TEST' OR is_val)
        UNPIVOT (value FOR name IN ({names}))) e JOIN best b ON e.name = b.name
), per_score AS (
  SELECT split, s, count(*) FILTER (WHERE PERF = 1) AS pos, count(*) FILTER (WHERE PERF = 0) AS neg FROM rated GROUP BY split, s
), ranked AS (SELECT *, sum(neg) OVER (PARTITION BY split ORDER BY s) AS upto FROM per_score)
SELECT r.split, round(sum(pos * (upto - neg / 2.0)) / (sum(pos) * sum(neg)), 6) AS roc_auc,
       (SELECT count(*) FROM rated x WHERE x.split = r.split) AS n_rows
FROM ranked r GROUP BY r.split""".format(
    features=", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in STUMP_FEATURES), names=", ".join(STUMP_FEATURES))


@query("evaluate_registered", EVALUATED)
def evaluate_registered(spark, folder):
    """A registered model, loaded by name with its encoder, measured on both snapshots."""
    few, fitted = _stump(spark, folder)
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    name = model_name("xgb", MOMENT)
    registry.save_model(name, fitted.model)
    registry.append_encoder(name, few.encoder)
    registry.append_importance(name, [(n, 0.0, 0, 0.0) for n in few.encoder.names])
    registry.append_result(name, "xgb", len(few.encoder.names), 0.5, 0.5, 0.5)
    result = EvaluationRun(registry, name).run(*stored_both(spark, folder))
    rows = result.scored.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    auc = spark.createDataFrame(
        [("val", result.validation_roc), ("test", result.test_roc)], "split string, roc_auc double")
    return auc.join(rows, "split").select("split", F.round("roc_auc", 6).alias("roc_auc"), "n_rows")


@query("tune_random")
def tune_random(spark, folder):
    return _tuned(spark, folder, "xgb")


@query("tune_random_lgb")
def tune_random_lgb(spark, folder):
    return _tuned(spark, folder, "lgb")


def _tuned(spark, folder, model_type: str) -> DataFrame:
    """A search over the ranges of a preset, rounds and depth narrowed: two random trials, two guided ones."""
    prepared = _prepared(spark, folder)
    bounds = {**config.SEARCH_BOUNDS[model_type], **QUICK}
    trials = learning.search(
        prepared.part("train"), prepared.part("val"), prepared.encoder.names, model_type, bounds, trials=4, random_trials=2
    )
    return spark.createDataFrame(
        [(t.number, t.rounds, t.auc, float(t.params["learning_rate"]), len(t.params)) for t in trials],
        "trial int, rounds int, auc double, learning_rate double, n_params int",
    )


@query("score_probability")
def score_probability(spark, folder):
    prepared = _prepared(spark, folder)
    scored = with_probability(prepared.part("test"), _fit(prepared).model)
    return scored.select(*DEFAULT_SPEC.keys, "probability")


@query("importance_table")
def importance_table(spark, folder):
    prepared = _prepared(spark, folder)
    return learning.importance_table(_fit(prepared))


@query("model_roundtrip", f"WITH {SNAPSHOT} SELECT count(*) AS n_rows, CAST(0 AS DOUBLE) AS gap FROM test")
def model_roundtrip(spark, folder):
    """Largest difference between the probabilities of a model and of its saved copy."""
    prepared = _prepared(spark, folder)
    fitted = _fit(prepared)
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    registry.save_model("xgb_copy", fitted.model)
    once = with_probability(prepared.part("test"), fitted.model, "first")
    twice = with_probability(once, registry.load_model("xgb_copy"), "second")
    return twice.agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.abs(F.col("first") - F.col("second"))).alias("gap"))


@query("registry_append")
def registry_append(spark, folder):
    return _registered(spark, folder).results()


@query("sink_importance")
def sink_importance(spark, folder):
    return _registered(spark, folder).importance()


FEATURE_NAMES = f"""WITH {SNAPSHOT}, names AS (
  SELECT 0 AS part, i, name FROM (
    SELECT unnest(range(1, 9)) AS i,
           unnest(['acctbal', 'is_overdrawn', 'region_key', 'n_orders', 'total_price', 'n_urgent', 'max_price', 'pending_price'])
             AS name)
  UNION ALL SELECT 1, 0, 'segment_' || level FROM (SELECT DISTINCT coalesce(segment, '0') AS level FROM train)
  UNION ALL SELECT 2, 0, 'urgent_status_' || level FROM (SELECT DISTINCT coalesce(urgent_status, '0') AS level FROM train)
)
SELECT CAST(row_number() OVER (ORDER BY part, i, name) - 1 AS INTEGER) AS position, name AS variable FROM names"""


@query("registry_features", FEATURE_NAMES)
def registry_features(spark, folder):
    registry = _registered(spark, folder, {k: (v, v) for k, v in SMALL.items()}, trials=1)  # the names do not depend on the fit
    names = registry.features(registry.latest("xgb"))
    return spark.createDataFrame(list(enumerate(names)), "position int, variable string")


@query("retrain_selected")
def retrain_selected(spark, folder):
    """Importance filter and second fit on the features that are left, both stopped by the validation loss."""
    prepared = _prepared(spark, folder)
    importance = learning.importance_table(_fit(prepared, STOPPED))
    useful = [r[0] for r in importance.where("importance > 0").orderBy("position").select("variable").collect()]
    chosen = Prepared(prepared.data, prepared.encoder.restricted(useful))
    report = _report(chosen, _fit(chosen, STOPPED))
    return report.withColumn("num_features", F.lit(len(useful)))


def _development(spark, folder):
    registry = ModelRegistry(spark, fresh_path(spark, "registry"))
    run = DevelopmentRun(
        registry, fresh_path(spark, "output"), MOMENT, LATER, bounds=WHOLE, trials=TRIALS, parallelism=TRIALS
    )
    return registry, run.run(*stored_both(spark, folder))


@query("development_run")
def development_run(spark, folder):
    _, result = _development(spark, folder)
    e = result.evaluation
    return spark.createDataFrame(
        [(result.base.name, result.final.name, len(result.final.fitted.features), result.final.fitted.rounds,
          result.final.fitted.params["n_estimators"], e.validation_roc, e.test_roc, e.psi)],
        "base_model string, final_model string, num_cols int, rounds int, most_rounds int, "
        "validation_roc double, test_roc double, psi double",
    )


@query("monthly_scoring_run")
def monthly_scoring_run(spark, folder):
    registry = _registered(spark, folder)
    run = ScoringRun(registry, fresh_path(spark, "scores"))
    return run.run(tables.snapshot(spark, folder, "SCORE"), "200107")
