"""Evaluation of a registered model on labelled snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..operators.prepare import Prepared, is_validation
from ..sources.registry import ModelRegistry
from .development import Evaluation, evaluate_model


@dataclass(frozen=True)
class EvaluationRun:
    """Evaluate a model by its name; by default the latest of its type."""

    registry: ModelRegistry
    model_name: str | None = None
    model_type: str = "xgb"
    spec: SnapshotSpec = DEFAULT_SPEC

    def run(self, train: DataFrame, test: DataFrame) -> Evaluation:
        """Encode both snapshots as the model learned it, and measure validation and test rows."""
        name = self.model_name or self.registry.latest(self.model_type)
        encoder = self.registry.encoder(name, self.spec).restricted(self.registry.features(name))
        carry = [*self.spec.keys, self.spec.target, "split"]
        split = F.when(is_validation(self.spec), "val").otherwise("train")
        rows = encoder.transform(train.withColumn("split", split), carry).unionByName(
            encoder.transform(test.withColumn("split", F.lit("test")), carry))
        return evaluate_model(Prepared(rows, encoder), self.registry.load_model(name))
