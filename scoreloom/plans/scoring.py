"""Monthly scoring run: validate, encode, align, score, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..operators.score import grade_distribution, score_snapshot
from ..operators.validate import validate_score_data
from ..sources.registry import ModelRegistry
from ..sources.snapshots import write_scores


@dataclass(frozen=True)
class ScoringRun:
    """Score snapshots with a registered model; by default the latest of its type."""

    registry: ModelRegistry
    output: str
    spec: SnapshotSpec = DEFAULT_SPEC
    score_type: str = "general"
    model_type: str = "xgb"
    model_name: str | None = None
    strict: bool = True

    def scored(self, snapshot: DataFrame) -> DataFrame:
        """Lazy scored table: one scan, no shuffle."""
        name = self.model_name or self.registry.latest(self.model_type)
        encoder = self.registry.encoder(name, self.spec)
        return score_snapshot(
            encoder.transform(snapshot), self.registry.features(name), self.registry.load_model(name), self.spec,
            score_type=self.score_type,
        )

    def run(self, snapshot: DataFrame, month: str | None = None) -> DataFrame:
        """Write the scored table and return the grade distribution of what was written.

        Without ``month`` these are the months of the snapshot; others that the folder holds do not count.
        """
        if month is not None:
            snapshot = snapshot.where(F.col(self.spec.month) == month)
        ok, message = validate_score_data(snapshot, self.spec)
        if not ok and self.strict:
            raise ValueError(message)
        path = write_scores(self.scored(snapshot), self.output, self.score_type, self.spec)
        written = snapshot.sparkSession.read.parquet(path).where(F.col("score_type") == self.score_type)
        months = [month] if month is not None else [
            r[0] for r in snapshot.select(F.col(self.spec.month).cast("string")).distinct().collect()
        ]
        # A list of months prunes the folders that are read; it is as long as the snapshot has months.
        named = [m for m in months if m is not None]
        own = F.col(self.spec.month).cast("string")
        mine = own.isin(*named) if named else F.lit(False)
        written = written.where(mine | own.isNull() if None in months else mine)
        return grade_distribution(written, self.score_type)
