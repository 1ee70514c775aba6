"""Boosted-tree training, hyperparameter search and feature importance with MLlib."""

from __future__ import annotations

import logging
import math
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import config
from ..config import DEFAULT_SPEC
from ..functions.expressions import column, quoted
from ..sources.workspace import fresh_path, shared_folder
from .evaluate import auc_value, roc_auc

log = logging.getLogger(__name__)

MODEL_TYPES = ("xgb", "lgb")
UNSUPPORTED = ("reg_alpha", "reg_lambda", "num_leaves")
MAX_INFO_GAIN = 0.05
MAX_DEPTH = 30
GAMMA_RANGE = 10.0
LABEL, FEATURES = "__label", "__features"
BEST_SHARE = 0.15  # of the trials, which a guided draw goes by
GUIDED_DRAWS = 6
STAGE_FACTOR = 4  # how much longer the next fit is where none of the rounds so far stopped
TRAIN_DEFAULTS = {"max_depth": 6, "learning_rate": 0.1, "n_estimators": 100}


def check_model_type(model_type: str) -> None:
    if model_type not in MODEL_TYPES:
        raise ValueError("Invalid model_type. Please use 'xgb' or 'lgb'.")


def as_integers(params: Mapping[str, float]) -> dict[str, float]:
    """Integer parameters are cut to whole numbers."""
    return {k: int(v) if k in config.INTEGER_PARAMETERS else v for k, v in params.items()}


def gbt_params(params: Mapping[str, float]) -> dict:
    """MLlib settings of a parameter set; parameters MLlib has no counterpart for are ignored."""
    ignored = [k for k in params if k in UNSUPPORTED]
    if ignored:
        log.warning("Parameters without an MLlib counterpart are ignored: %s", ", ".join(ignored))
    p = {**TRAIN_DEFAULTS, **as_integers(params)}
    if p["max_depth"] > MAX_DEPTH:
        raise ValueError(f"max_depth {p['max_depth']} is above MLlib's limit of {MAX_DEPTH}.")
    leaf_rows = p.get("min_child_samples", p.get("min_child_weight", 1))
    settings = {
        "maxDepth": int(p["max_depth"]),
        "stepSize": float(p["learning_rate"]),
        "maxIter": int(p["n_estimators"]),
        "subsamplingRate": float(p.get("subsample", 1.0)),
        "minInstancesPerNode": max(1, int(leaf_rows)),
        "minInfoGain": MAX_INFO_GAIN * float(p.get("gamma", 0.0)) / GAMMA_RANGE,
    }
    share = float(p.get("colsample_bytree", 1.0))
    settings["featureSubsetStrategy"] = "all" if share >= 1 else str(share)
    return settings


@dataclass(frozen=True)
class Fitted:
    model: PipelineModel
    features: tuple[str, ...]
    rounds: int
    params: Mapping[str, float]


def _booster(model: PipelineModel) -> GBTClassificationModel:
    return model.stages[-1]


def stop_of(gains: Sequence[float], patience: int = config.PATIENCE) -> tuple[int, bool]:
    """Number of rounds to keep, and whether ``patience`` rounds without a rise followed them."""
    best, at = float("-inf"), 0
    for i, value in enumerate(gains, 1):
        if value > best:
            best, at = value, i
        elif i - at >= patience:
            return max(at, 1), True
    return max(at, 1), False


def best_round(gains: Sequence[float], patience: int = config.PATIENCE) -> int:
    """Number of rounds to keep: the highest value before ``patience`` rounds without a rise."""
    return stop_of(gains, patience)[0]


def fit_lengths(most: int, patience: int = config.PATIENCE) -> list[int]:
    """Rounds to try in turn: each a fourth of the next, the last ``most``, none too short to stop in."""
    found = [most]
    while -(-found[0] // STAGE_FACTOR) >= 2 * max(1, patience):
        found.insert(0, -(-found[0] // STAGE_FACTOR))
    return found


def _tree_steps(booster: GBTClassificationModel, vectors: DataFrame, rounds: int) -> tuple[DataFrame, Column]:
    """Add the prediction of each of the first trees; the array holds their weighted steps.

    The probability grows with the summed steps, so partial sums rank rows as a shorter model would.
    """
    df = vectors
    for i, tree in enumerate(booster.trees[:rounds]):
        df = tree.setFeaturesCol(FEATURES).setPredictionCol(f"tree{i}").transform(df)
    weights = booster.treeWeights[:rounds]
    return df, F.array(*[F.col(f"tree{i}") * F.lit(float(w)) for i, w in enumerate(weights)])


def auc_per_round(booster: GBTClassificationModel, vectors: DataFrame) -> list[float]:
    """AUC after each round, all rounds in one pass."""
    df, steps = _tree_steps(booster, vectors, len(booster.treeWeights))
    margins = F.aggregate(
        steps,
        F.array().cast("array<double>"),
        lambda done, step: F.array_append(done, F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0.0)) + step),
    )
    long = df.select(LABEL, F.posexplode(margins).alias("round", "margin"))
    rows = roc_auc(long, "margin", LABEL, ["round"]).collect()
    return [r["roc_auc"] if r["roc_auc"] is not None else 0.5 for r in sorted(rows)]


def auc_at_round(booster: GBTClassificationModel, vectors: DataFrame, rounds: int) -> float | None:
    """AUC of the first ``rounds`` trees, without fitting the shorter model."""
    df, steps = _tree_steps(booster, vectors, rounds)
    margin = F.aggregate(steps, F.lit(0.0), lambda done, step: done + step)
    return auc_value(df.select(LABEL, margin.alias("margin")), "margin", LABEL)


def round_values(booster: GBTClassificationModel, vectors: DataFrame, stop_on: str) -> list[float]:
    """One value per round, higher is better."""
    if stop_on == "auc":
        return auc_per_round(booster, vectors)
    return [-loss for loss in booster.evaluateEachIteration(vectors)]


@dataclass(frozen=True)
class Learner:
    """Assembler and booster settings for one feature list and parameter set.

    ``options`` go to ``GBTClassifier`` as they are, for example ``maxMemoryInMB``.
    """

    features: tuple[str, ...]
    params: Mapping[str, float]
    target: str = DEFAULT_SPEC.target
    seed: int = config.MODEL_SEED
    options: Mapping = field(default_factory=dict)

    @property
    def max_rounds(self) -> int:
        return gbt_params(self.params)["maxIter"]

    def _columns(self, df: DataFrame) -> DataFrame:
        return df.select(column(self.target).cast("double").alias(LABEL), *[column(n) for n in self.features])

    def _assembler(self) -> VectorAssembler:
        return VectorAssembler(inputCols=[quoted(n) for n in self.features], outputCol=FEATURES)

    def vectors(self, df: DataFrame) -> DataFrame:
        return self._assembler().transform(self._columns(df)).select(LABEL, FEATURES)

    def fit(self, train: DataFrame, rounds: int) -> PipelineModel:
        shared_folder(train.sparkSession)  # the booster checkpoints there
        settings = {**gbt_params(self.params), **self.options, "maxIter": rounds}
        booster = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=self.seed, **settings)
        return Pipeline(stages=[self._assembler(), booster]).fit(self._columns(train))


def fit_model(
    train: DataFrame,
    validation: DataFrame | None,
    features: Sequence[str],
    params: Mapping[str, float] | None = None,
    target: str = DEFAULT_SPEC.target,
    patience: int = config.PATIENCE,
    seed: int = config.MODEL_SEED,
    stop_on: str = "logloss",
    options: Mapping | None = None,
) -> Fitted:
    """Boosted trees, stopped by the validation ``logloss`` or ``auc``.

    MLlib's own early stop ends at the first round without a gain. Here the validation measure of every
    fitted round is read in one pass (``fit_until_stopped``), and, if an earlier round was best, the model is
    fitted again with that many rounds.
    """
    if stop_on not in ("logloss", "auc"):
        raise ValueError("stop_on must be 'logloss' or 'auc'.")
    learner = Learner(tuple(features), dict(params or {}), target, seed, dict(options or {}))
    if validation is None or learner.max_rounds < 2:
        return Fitted(learner.fit(train, learner.max_rounds), learner.features, learner.max_rounds, learner.params)
    model, rounds = fit_until_stopped(learner, train, learner.vectors(validation), patience, stop_on)
    if rounds < len(_booster(model).treeWeights):
        model = learner.fit(train, rounds)
    return Fitted(model, learner.features, rounds, learner.params)


def fit_until_stopped(
    learner: Learner, train: DataFrame, vectors: DataFrame, patience: int = config.PATIENCE, stop_on: str = "logloss"
) -> tuple[PipelineModel, int]:
    """A fit long enough to hold the round to stop at, and that round.

    MLlib cannot go on with a fitted model, but with the same seed and rows the trees of a short fit are the first
    trees of a long one. So short fits come first, and a longer one follows only while none has stopped: a fit
    that stops early skips most of the rounds allowed, and one that never does costs a third more.
    """
    for length in fit_lengths(learner.max_rounds, patience):
        model = learner.fit(train, length)
        rounds, stopped = stop_of(round_values(_booster(model), vectors, stop_on), patience)
        if stopped:
            break
    return model, rounds


def draw_params(bounds: Mapping[str, tuple[float, float]], trials: int, seed: int) -> list[dict[str, float]]:
    """Seeded uniform draws from the ranges."""
    rng = random.Random(seed)
    return [as_integers({k: rng.uniform(*bounds[k]) for k in sorted(bounds)}) for _ in range(trials)]


def guided_params(
    bounds: Mapping[str, tuple[float, float]], done: Sequence[Trial], wanted: int, seed: int
) -> list[dict[str, float]]:
    """Draws near the best trials and away from the others, whose number ``done`` seeds them.

    For each parameter, the best share of the trials and the rest become two mixtures of normal densities over its
    range, a flat one among them. Of GUIDED_DRAWS draws from the first, the one with the greatest ratio of both
    densities is taken. Trials that were drawn together differ by their draws alone.
    """
    rng = random.Random(f"{seed}:{len(done)}")
    ranked = sorted(done, key=_rank)
    good = max(1, math.ceil(BEST_SHARE * len(ranked)))

    def density(x: float, centres: Sequence[float], width: float, span: float) -> float:
        near = sum(math.exp(-0.5 * ((x - c) / width) ** 2) for c in centres) / (width * math.sqrt(2 * math.pi))
        return (near + 1 / span) / (len(centres) + 1)

    def draw() -> dict[str, float]:
        found = {}
        for name in sorted(bounds):
            low, high = bounds[name]
            span = high - low
            if not span:
                found[name] = low
                continue
            best, rest = ([t.params[name] for t in part] for part in (ranked[:good], ranked[good:]))
            width = span / max(2.0, math.sqrt(len(ranked)))

            def sample() -> float:
                while True:
                    centre = rng.choice([None, *best])
                    x = rng.uniform(low, high) if centre is None else rng.gauss(centre, width)
                    if low <= x <= high:
                        return x

            drawn = [sample() for _ in range(GUIDED_DRAWS)]
            found[name] = max(drawn, key=lambda x: density(x, best, width, span) / density(x, rest, width, span))
        return as_integers(found)

    return [draw() for _ in range(wanted)]


@dataclass(frozen=True)
class Trial:
    number: int
    params: Mapping[str, float]
    rounds: int
    auc: float


def _rank(trial: Trial) -> tuple[float, int]:
    """Best trials first; those without an AUC last."""
    return (-trial.auc if trial.auc == trial.auc else 1.0, trial.number)


def search(
    train: DataFrame,
    validation: DataFrame,
    features: Sequence[str],
    model_type: str = "xgb",
    bounds: Mapping[str, tuple[float, float]] | None = None,
    trials: int = config.SEARCH_TRIALS,
    target: str = DEFAULT_SPEC.target,
    seed: int = config.SEARCH_SEED,
    parallelism: int = 2,
    options: Mapping | None = None,
    random_trials: int = config.RANDOM_TRIALS,
) -> list[Trial]:
    """Search for the highest validation AUC, best trial first: random trials, then guided ones.

    A trial stops on the validation loss and is judged by the AUC of the trees up to that round.
    Each trial is a set of Spark jobs; ``parallelism`` trials run side by side so that the end of
    one job does not leave executors idle. Pass stored frames: every trial reads them again.
    After ``random_trials`` trials, each batch of ``parallelism`` learns from all before it; a search is the same again
    for the same seed and parallelism.
    """
    check_model_type(model_type)
    wanted = {k: v for k, v in (bounds or config.SEARCH_BOUNDS[model_type]).items() if k not in UNSUPPORTED}

    def run(drawn: tuple[int, dict[str, float]]) -> Trial:
        number, params = drawn
        learner = Learner(tuple(features), params, target, options=dict(options or {}))
        vectors = learner.vectors(validation)
        model, rounds = fit_until_stopped(learner, train, vectors)
        auc = auc_at_round(_booster(model), vectors, rounds)
        return Trial(number, params, rounds, float("nan") if auc is None else auc)

    done: list[Trial] = []
    with ThreadPoolExecutor(parallelism) as pool:
        work = inheritable_thread_target(train.sparkSession)(run)
        batch = draw_params(wanted, min(trials, max(1, random_trials)), seed)
        while batch:
            done += pool.map(work, enumerate(batch, len(done)))
            batch = guided_params(wanted, done, min(parallelism, trials - len(done)), seed)
    return sorted(done, key=_rank)


def importance_table(fitted: Fitted, path: str | None = None) -> DataFrame:
    """Per feature: normalised importance, number of splits and summed gain.

    Splits and gains come from the node table MLlib saves with the model (one row per tree node).
    """
    spark = SparkSession.builder.getOrCreate()
    if path is None:
        path = fresh_path(spark, "model")
        fitted.model.write().overwrite().save(path)
    last = len(fitted.model.stages) - 1
    nodes = spark.read.parquet(f"{path}/stages/{last}_*/data")
    splits = (
        nodes.where(F.col("nodeData.split.featureIndex") >= 0)
        .groupBy(F.col("nodeData.split.featureIndex").alias("position"))
        .agg(F.count(F.lit(1)).alias("split"), F.sum("nodeData.gain").alias("gain"))
    )
    weights = _booster(fitted.model).featureImportances.toArray()
    names = spark.createDataFrame(
        [(i, n, float(w)) for i, (n, w) in enumerate(zip(fitted.features, weights))],
        "position int, variable string, importance double",
    )
    return names.join(splits, "position", "left").select(
        "position", "variable", "importance",
        F.coalesce("split", F.lit(0).cast("bigint")).alias("split"),
        F.coalesce("gain", F.lit(0.0)).alias("gain"),
    )
