"""Development run: validate, prepare, profile, train, select, retrain, evaluate."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.ml.base import Transformer
from pyspark.sql import DataFrame, functions as F

from .. import config
from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column
from ..operators import binning, evaluate, model as learning
from ..operators.prepare import Prepared, prepare_development
from ..operators.score import with_probability
from ..operators.validate import validate_modeling_data
from ..sources.registry import ModelRegistry, model_name
from ..sources.snapshots import write_table
from ..sources.workspace import stored


@dataclass(frozen=True)
class TrainedModel:
    name: str
    prepared: Prepared
    fitted: learning.Fitted
    validation_roc: float  # best AUC of the search
    refit_roc: float  # validation AUC of the model that is kept
    test_roc: float


@dataclass(frozen=True)
class Evaluation:
    validation_roc: float
    test_roc: float
    psi: float
    summary: DataFrame
    combined: DataFrame
    scored: DataFrame


@dataclass(frozen=True)
class DevelopmentResult:
    messages: dict[str, str]
    profile: binning.Profile
    base: TrainedModel
    final: TrainedModel
    evaluation: Evaluation


def train_and_register(
    prepared: Prepared,
    registry: ModelRegistry,
    name: str,
    model_type: str = "xgb",
    bounds: Mapping | None = None,
    trials: int = config.SEARCH_TRIALS,
    parallelism: int = 2,
) -> TrainedModel:
    """Search, fit the best parameters again stopping on AUC, and register the model with its tables."""
    learning.check_model_type(model_type)
    target = prepared.encoder.spec.target
    features = prepared.encoder.names
    train, validation, test = (prepared.part(s) for s in ("train", "val", "test"))
    best = learning.search(
        train, validation, features, model_type, bounds, trials, target, parallelism=parallelism
    )[0]
    fitted = learning.fit_model(train, validation, features, best.params, target, stop_on="auc")
    refit = evaluate.auc_value(with_probability(validation, fitted.model), label=target)
    test_roc = evaluate.auc_value(with_probability(test, fitted.model), label=target)
    registry.save_model(name, fitted.model)
    registry.append_encoder(name, prepared.encoder)
    importance = learning.importance_table(fitted, f"{registry.folder}/models/{name}").orderBy("position").collect()
    registry.append_importance(name, [(r["variable"], r["importance"], r["split"], r["gain"]) for r in importance])
    registry.append_params(name, best.params)
    registry.append_result(name, model_type, len(features), best.auc, refit, test_roc)
    return TrainedModel(name, prepared, fitted, best.auc, refit, test_roc)


def evaluate_model(prepared: Prepared, model: Transformer) -> Evaluation:
    """AUC on validation and test rows, band table and score stability, from one scoring pass."""
    spec = prepared.encoder.spec
    target = spec.target
    rows = prepared.data.where(F.col("split").isin("val", "test"))
    banded = evaluate.with_band(with_probability(rows, model))
    scored = stored(banded.select(*map(column, spec.keys), "split", target, "probability", "scale"), "scored")
    auc = {r["split"]: r["roc_auc"] for r in evaluate.roc_auc(scored, label=target, groups=["split"]).collect()}
    summary = evaluate.band_summary(scored, target=target)
    combined = evaluate.band_combined(summary)
    psi = evaluate.score_psi(combined).first()["psi"]
    return Evaluation(auc.get("val"), auc.get("test"), psi, summary, combined, scored)


@dataclass(frozen=True)
class DevelopmentRun:
    """Settings of a run; ``moment`` and the later ``retrain_moment`` name the first and last models.

    ``profile_options`` go to the profile (quantiles, special values, edges, scope, levels), and
    ``prepare_options`` to the encoding (exact split, levels). ``selections`` says how often variables
    without importance are dropped and the model is trained again; the models between the first and
    the last are named a second apart.
    """

    registry: ModelRegistry
    output: str
    moment: datetime
    retrain_moment: datetime
    spec: SnapshotSpec = DEFAULT_SPEC
    model_type: str = "xgb"
    bounds: Mapping | None = None
    trials: int = config.SEARCH_TRIALS
    parallelism: int = 2
    strict: bool = True
    min_iv: float | None = None
    max_psi: float | None = None
    profile_options: Mapping = field(default_factory=dict)
    prepare_options: Mapping = field(default_factory=dict)
    selections: int = 1

    def run(self, train: DataFrame, test: DataFrame) -> DevelopmentResult:
        messages = {}
        for tag, df in (("train", train), ("test", test)):
            ok, messages[tag] = validate_modeling_data(df, self.spec)
            if not ok and self.strict:
                raise ValueError(f"{tag}: {messages[tag]}")

        # Profile and encodings pass over the snapshots many times: a text file is parsed once.
        train, test = stored(train, "train"), stored(test, "test")
        run_id = self.moment.strftime("%y%m%d_%H%M%S")
        profiled = binning.profile(train, test, self.spec, **self.profile_options)
        write_table(binning.variable_iv(profiled.summary), self.output, "iv", run_id)
        write_table(binning.variable_psi(profiled.psi_bins), self.output, "psi", run_id)
        write_table(profiled.summary, self.output, "binning_summary", run_id)

        keep = None
        if self.min_iv is not None or self.max_psi is not None:
            chosen = binning.select_variables(profiled.table, self.min_iv, self.max_psi).select("variable")
            names = {r[0] for r in chosen.collect()}
            keep = [n for n in train.columns if n in names]

        base = self._train(train, test, keep, self.moment)
        final = base
        for number in range(self.selections):
            useful = (
                self.registry.importance()
                .where((F.col("model_name") == final.name) & (F.col("importance") > 0))
                .orderBy("position").select("variable").collect()
            )
            moment = self.retrain_moment - timedelta(seconds=self.selections - 1 - number)
            final = self._train(train, test, [r[0] for r in useful] or keep, moment)
        return DevelopmentResult(
            messages, profiled, base, final, evaluate_model(final.prepared, final.fitted.model)
        )

    def _train(self, train, test, keep, moment) -> TrainedModel:
        prepared = prepare_development(train, test, keep, self.spec, **self.prepare_options)
        prepared = Prepared(stored(prepared.data, "prepared", "split"), prepared.encoder)
        return train_and_register(
            prepared, self.registry, model_name(self.model_type, moment), self.model_type,
            self.bounds, self.trials, self.parallelism,
        )
