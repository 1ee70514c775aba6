"""Model registry: parquet tables with one partition per ``model_name``.

Registering a name again replaces its rows, so a retried run leaves what one run leaves. The results
row is written last and marks a model as complete; ``latest`` sees complete models only.

Importance and parameter tables have one row per feature or parameter, the results table one row
per model, so all of them stay small whatever the size of the snapshots.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column
from ..operators.prepare import Feature, FeatureEncoder

RESULTS_SCHEMA = (
    "model_name string, model_type string, num_cols int, "
    "validation_roc double, refit_roc double, test_roc double"
)
IMPORTANCE_SCHEMA = "model_name string, position int, variable string, importance double, split bigint, gain double"
ENCODER_SCHEMA = (
    "model_name string, position int, feature string, source string, level string, known array<string>"
)
PARAMS_SCHEMA = "model_name string, parameter string, value double"


def model_name(model_type: str, moment: datetime) -> str:
    return f"{model_type}_{moment.strftime('%y%m%d_%H%M%S')}"


class ModelRegistry:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _table(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _put(self, rows: Iterable[tuple], schema: str, name: str) -> None:
        frame = self.spark.createDataFrame(list(rows), schema).coalesce(1)
        writer = frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("model_name").parquet(self._table(name))

    # -- writing -----------------------------------------------------------------------------

    def append_result(self, name, model_type, num_cols, validation_roc, refit_roc, test_roc) -> None:
        self._put(
            [(name, model_type, num_cols, validation_roc, refit_roc, test_roc)], RESULTS_SCHEMA, "results"
        )

    def append_importance(self, name: str, rows: Iterable[tuple[str, float, int, float]]) -> None:
        self._put(
            [(name, i, v, float(imp), int(split), float(gain)) for i, (v, imp, split, gain) in enumerate(rows)],
            IMPORTANCE_SCHEMA, "importance",
        )

    def append_params(self, name: str, params: Mapping[str, float]) -> None:
        self._put([(name, k, float(v)) for k, v in params.items()], PARAMS_SCHEMA, "params")

    def append_encoder(self, name: str, encoder: FeatureEncoder) -> None:
        """The fitted encoding, so that scoring never learns levels from the month it scores."""
        known = {f.name: f for f in encoder.features}
        rows = []
        for i, n in enumerate(encoder.order):
            f = known.get(n)
            rows.append(
                (name, i, n, f and f.source, f and f.level, list(f.known) if f and f.known is not None else None)
            )
        self._put(rows, ENCODER_SCHEMA, "encoders")

    def save_model(self, name: str, model: PipelineModel) -> None:
        model.write().overwrite().save(self._table(f"models/{name}"))

    # -- reading -----------------------------------------------------------------------------

    def _read(self, schema: str, name: str) -> DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        return self.spark.read.schema(schema).parquet(self._table(name)).select(*names)

    def results(self) -> DataFrame:
        return self._read(RESULTS_SCHEMA, "results")

    def importance(self) -> DataFrame:
        return self._read(IMPORTANCE_SCHEMA, "importance")

    def params(self) -> DataFrame:
        return self._read(PARAMS_SCHEMA, "params")

    def encoder(self, name: str, spec: SnapshotSpec = DEFAULT_SPEC) -> FeatureEncoder:
        table = self._read(ENCODER_SCHEMA, "encoders")
        rows = table.where(F.col("model_name") == name).orderBy("position").collect()
        return FeatureEncoder(
            spec,
            tuple(
                Feature(r["feature"], r["source"], r["level"], None if r["known"] is None else tuple(r["known"]))
                for r in rows if r["source"] is not None
            ),
            tuple(r["feature"] for r in rows),
        )

    def load_model(self, name: str) -> PipelineModel:
        return PipelineModel.load(self._table(f"models/{name}"))

    def latest(self, model_type: str) -> str:
        name = latest_models(self.results()).where(F.col("model_type") == model_type).first()
        if name is None:
            raise ValueError(f"No model of type {model_type!r} in {self.folder}.")
        return name["model_name"]

    def features(self, name: str) -> list[str]:
        rows = self.importance().where(F.col("model_name") == name).orderBy("position").select("variable")
        return [r[0] for r in rows.collect()]


def latest_models(models: DataFrame) -> DataFrame:
    """Newest model per type: names carry the time, so the largest name is the latest."""
    return models.groupBy("model_type").agg(F.max("model_name").alias("model_name"))


def latest_importance(models: DataFrame, importance: DataFrame, model_type: str) -> DataFrame:
    """Importance rows of the newest model of one type."""
    newest = latest_models(models.where(F.col("model_type") == model_type))
    return importance.join(newest, "model_name", "left_semi")


def select_by_importance(importance: DataFrame, minimum: float = 0.0) -> DataFrame:
    return importance.where(column("importance") > F.lit(float(minimum)))
