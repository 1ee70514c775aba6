"""The scoring path on a stream of snapshot files: same row operations, no state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.base import Transformer
from pyspark.sql import Column, DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..operators.prepare import FeatureEncoder
from ..operators.score import score_snapshot


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("header", True).load(folder)


def score_stream(
    stream: DataFrame,
    encoder: FeatureEncoder,
    features: Sequence[str],
    model: Transformer | Column,
    spec: SnapshotSpec = DEFAULT_SPEC,
    **options,
) -> DataFrame:
    """Scored rows; the encoder must have been fitted before, as a stream cannot be scanned twice."""
    return score_snapshot(encoder.transform(stream), features, model, spec, **options)


def write_stream(scored: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything that has arrived, then stop."""
    return (
        scored.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
