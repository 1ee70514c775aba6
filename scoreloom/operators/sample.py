"""Building sample snapshots: key tables, feature sampling, positional joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import column
from ..functions.hashing import random_code, seeded_hash
from . import ranges

ORDERED_ROWS = 10_000


def key_table(
    spark: SparkSession, num_samples: int, month: str, seed: int = 1, spec: SnapshotSpec = DEFAULT_SPEC
) -> DataFrame:
    """Month constant, ids 1..n and a repeatable 10-character code per id."""
    ids = spark.range(1, num_samples + 1).withColumnRenamed("id", spec.customer_id)
    return ids.select(
        F.lit(month).alias(spec.month),
        column(spec.customer_id),
        random_code(seed, spec.customer_id).alias(spec.customer_hash),
    )


def key_table_of(
    customers: DataFrame, key: str, month: str, seed: int = 1, spec: SnapshotSpec = DEFAULT_SPEC
) -> DataFrame:
    """Month constant, the customers' own ids and a repeatable 10-character code per id."""
    ids = customers.select(column(key).alias(spec.customer_id))
    return ids.select(
        F.lit(month).alias(spec.month), column(spec.customer_id), random_code(seed, spec.customer_id).alias(spec.customer_hash))


def keep_positive(df: DataFrame, name: str) -> DataFrame:
    """Rows with a value above 0; NULL and NaN are not."""
    return df.where((column(name) > 0) & ~F.isnan(column(name).cast("double")))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 1) -> DataFrame:
    """``n`` rows drawn by seeded hash of a key (all rows when there are fewer); rows without key are not drawn.

    A small sample is one pass that keeps the first rows; a large one is found by counting hashes.
    """
    hashed = df.withColumn("__hash", seeded_hash(seed, key))
    if n <= ORDERED_ROWS:
        chosen = hashed.where(F.col("__hash").isNotNull()).orderBy("__hash", *map(column, df.columns)).limit(n)
    else:
        chosen, _ = ranges.first_by_hash(hashed, "__hash", n)
    return chosen.drop("__hash")


def feature_source(
    df: DataFrame,
    renames: Mapping[str, str],
    drop: Sequence[str],
    positive: str,
    n: int,
    key: str,
    seed: int = 1,
) -> DataFrame:
    """Rename the target, drop columns that give it away, filter, and draw ``n`` rows."""
    source = df.withColumnsRenamed(dict(renames)).drop(*drop)
    return sample_rows(keep_positive(source, positive), n, key, seed)


def positional_join(keys: DataFrame, features: DataFrame, key: str, feature_key: str, seed: int = 1) -> DataFrame:
    """Put the i-th feature row (in hash order) beside the i-th key; keys without a partner stay.

    NULL keys come after all others. Feature rows without a key are not used.

    Both sides are numbered per bucket, so no task sorts a whole side.
    """
    ordered = keys.withColumn("__order", column(key).cast("double"))
    rows = keys.count()
    points = ranges.split_points(ordered, ["__order"], rows, ranges.range_count(rows))
    left = ranges.positions(
        ranges.with_ranges(ordered, points),
        F.col("__order_range"), [key],
    ).drop("__order", "__order_range")
    right = ranges.positions(
        features.withColumn("__hash", seeded_hash(seed, feature_key)).where(F.col("__hash").isNotNull()),
        ranges.hash_bucket("__hash"), ["__hash", feature_key],
    ).drop("__hash")
    return left.join(right, "position", "left").drop("position")
