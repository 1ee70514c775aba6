"""Order-dependent work without a global sort: value ranges, running totals, positions, thresholds.

A window over a whole table, or over one hot group, is one task. Here rows first get a range
number that is a plain function of their value, cut at points taken from one sketch pass. Totals
per range are few, so running sums over ranges are cheap; only the rest is summed inside the
ranges, in parallel. As the range depends on the value alone, a recomputed or retried task puts a
row where it was before.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.expressions import column, double_array, quoted
from ..sources.workspace import stored

MAX_RANGES = 16_384
ROWS_PER_RANGE = 1_000_000
SKETCH_PRECISION = 10
SKETCH_ROWS = 5_000_000
HEX_DIGITS_PER_PASS = 4
HASH_DIGITS = 32
TIE = "__tie"
COPIES_PER_PART = 100_000


def range_count(rows: int, rows_per_range: int = ROWS_PER_RANGE) -> int:
    return max(1, min(MAX_RANGES, -(-rows // rows_per_range)))


def split_points(
    df: DataFrame, names: Sequence[str], rows: int, n_ranges: int, sketch_rows: int = SKETCH_ROWS
) -> dict[str, list[float]]:
    """Ascending cut points per double column, so that ranges hold about equal numbers of rows.

    One scan; about ``sketch_rows`` of the ``rows`` rows enter the sketches, every task sends one
    sketch per column, and the driver gets ``n_ranges - 1`` numbers per column. The points only
    steer balance: results do not depend on them.
    """
    if n_ranges < 2 or not names:
        return {n: [] for n in names}
    shares = double_array(i / n_ranges for i in range(1, n_ranges))
    precision = SKETCH_PRECISION * n_ranges
    if rows > sketch_rows:
        df = df.sample(sketch_rows / rows, seed=1)
    row = df.agg(
        *[F.expr(f"percentile_approx({quoted(n)}, {shares}, {precision})").alias(f"p{i}") for i, n in enumerate(names)]
    ).first()
    return {n: sorted({float(x) for x in row[i] or () if math.isfinite(x)}) for i, n in enumerate(names)}


def with_ranges(df: DataFrame, points: Mapping[str, Sequence[float]], suffix: str = "_range") -> DataFrame:
    """Add the range number of each column in ``points``; NULL stays NULL.

    Range ``i`` starts at point ``i`` (included), so a value that fills whole shares of a column
    is itself a point and begins its own range.
    """
    cut = [n for n in points if points[n]]
    if cut:
        df = Bucketizer(
            splitsArray=[[-float("inf"), *points[n], float("inf")] for n in cut],
            inputCols=cut,
            outputCols=[n + suffix for n in cut],
            handleInvalid="keep",
        ).transform(df)
    numbers = {n + suffix: column(n + suffix).cast("int") for n in cut}
    whole = {n + suffix: F.when(column(n).isNotNull(), F.lit(0)) for n in points if n not in cut}
    return df.withColumns({**numbers, **whole})


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: str,
    measures: Sequence[str],
    points: Sequence[float],
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add ``running_<measure>``: the sum over all rows of the group up to this ``order`` value.

    ``df`` has one row per group, non-null ``order`` value (a double) and ``ties``, columns that order
    rows of equal value; so equal rows were summed before and a frequent value is one row. NULL is
    a group of its own.
    """
    ranged = with_ranges(df, {order: points}, "__range")
    place = [*groups, order + "__range"]
    totals = ranged.groupBy(*place).agg(*[F.sum(m).alias(f"__sum_{m}") for m in measures])
    earlier = (
        Window.partitionBy(*groups).orderBy(order + "__range").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = totals.select(
        *[column(n).alias(f"__at_{n}") for n in place], *[F.coalesce(F.sum(f"__sum_{m}").over(earlier), F.lit(0)).alias(f"__before_{m}") for m in measures]
    )
    inside = Window.partitionBy(*place).orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(m).over(inside).alias(f"__inside_{m}") for m in measures])
    # No hint: the totals are groups x ranges rows, and adaptive execution broadcasts them when small.
    same = reduce(and_, [column(n).eqNullSafe(column(f"__at_{n}")) for n in place])
    return local.join(before, same).select(
        *[column(n) for n in df.columns],
        *[(F.col(f"__before_{m}") + F.col(f"__inside_{m}")).alias(f"running_{m}") for m in measures],
    )


def positions(
    df: DataFrame, bucket: Column, order: Sequence[str], name: str = "position", rows_per_task: int = ROWS_PER_RANGE
) -> DataFrame:
    """Number all rows 1..n by ``order``; ``bucket`` must not decrease along that order.

    Only the rows of one bucket meet in one task. Rows whose bucket is NULL come last. Rows that are equal in
    ``order`` are numbered by a hash of the row. Where a value of ``order`` has more than ``rows_per_task``
    rows, it takes part as a few counts, and its rows are numbered in as many parts.
    """
    bucketed = df.withColumn("__bucket", bucket).withColumn("__tie_break", F.xxhash64(*map(column, df.columns)))
    counts = bucketed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__rows"))
    if (counts.agg(F.max("__rows")).first()[0] or 0) > 2 * rows_per_task:
        hot = _hot_values(bucketed, order, rows_per_task)
        if not hot.isEmpty():
            return _positions_with_ties(bucketed, hot, order, name).select(*[column(n) for n in df.columns], name)
    inside = Window.partitionBy("__bucket").orderBy(*[column(n) for n in order], "__tie_break")
    return (
        bucketed.withColumn("__inside", F.row_number().over(inside))
        .join(_before(counts), F.col("__bucket").eqNullSafe(F.col("__at")))
        .select(*[column(n) for n in df.columns], (F.col("__before") + F.col("__inside")).alias(name))
    )


def _before(counts: DataFrame) -> DataFrame:
    """(__at, __before): rows in the buckets before each one."""
    earlier = Window.orderBy(F.col("__bucket").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(F.col("__bucket").alias("__at"), F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__before"))


def _hot_values(bucketed: DataFrame, order: Sequence[str], rows_per_task: int) -> DataFrame:
    """Values of ``order`` with more than ``rows_per_task`` rows, and the parts to number them in.

    There are at most as many as all rows divided by ``rows_per_task``.
    """
    found = bucketed.groupBy(*[column(n) for n in order]).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_task)
    return stored(found.select(
        *[column(n).alias(f"__hot_{i}") for i, n in enumerate(order)], F.ceil(F.col("__n") / rows_per_task).alias("__parts")
    ), "hot_values")


def _positions_with_ties(bucketed: DataFrame, hot: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``bucketed`` with positions; rows of ``hot`` values enter the sorted buckets as one count per part.

    The part of a row is drawn once and written down, so a retried task finds it unchanged.
    """
    by = [column(n) for n in order]
    same = reduce(and_, [c.eqNullSafe(F.col(f"__hot_{i}")) for i, c in enumerate(by)])
    marked = bucketed.join(F.broadcast(hot), same, "left")
    tied = stored(
        marked.where(F.col("__parts").isNotNull())
        .select(*[column(n) for n in bucketed.columns], F.floor(F.rand(1) * F.col("__parts")).alias("__part")), "tied_rows")
    weights = tied.groupBy("__bucket", *by, "__part").agg(F.count(F.lit(1)).alias("__weight"))
    single = marked.where(F.col("__parts").isNull()).drop("__parts", *hot.columns).withColumn("__weight", F.lit(1).cast("bigint"))
    line = single.unionByName(weights, allowMissingColumns=True)
    totals = line.groupBy("__bucket").agg(F.sum("__weight").alias("__rows"))
    inside = Window.partitionBy("__bucket").orderBy(*by, "__part", "__tie_break").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        line.withColumn("__inside", F.sum("__weight").over(inside))
        .join(_before(totals), F.col("__bucket").eqNullSafe(F.col("__at")))
        .withColumn(name, F.col("__before") + F.col("__inside"))
    )
    starts = ends.where(F.col("__part").isNotNull()).select(
        *[c.alias(f"__hot_{i}") for i, c in enumerate(by)], F.col("__part").alias("__at_part"),
        (column(name) - F.col("__weight")).alias("__start"))
    within = Window.partitionBy(*by, "__part").orderBy("__tie_break")
    numbered = (
        tied.withColumn("__inside", F.row_number().over(within))
        .join(starts, same & (F.col("__part") == F.col("__at_part")))
        .withColumn(name, F.col("__start") + F.col("__inside"))
    )
    wanted = [*bucketed.columns, name]
    return ends.where(F.col("__part").isNull()).select(*map(column, wanted)).unionByName(numbered.select(*map(column, wanted)))


def hash_bucket(hash_column: str, digits: int = 4) -> Column:
    """Bucket of a hex hash that follows the order of the hash: 16 ** digits buckets."""
    return F.substring(column(hash_column), 1, digits)


def first_by_hash(df: DataFrame, hash_column: str, k: int) -> tuple[DataFrame, DataFrame]:
    """The first ``k`` rows in the order of a hex hash, and the others; exact, repeated hashes included.

    Each pass counts rows by the next hex digits and keeps the one prefix that holds row k, so no
    pass sorts the table and the driver sees at most 16 ** 4 counts. Rows that share the hash of
    row k are told apart by their other columns; rows equal in all of them are counted. NULL hashes are never first.
    """
    h = column(hash_column)
    prefix, left = "", k
    while 0 < left and len(prefix) < HASH_DIGITS:
        width = len(prefix) + HEX_DIGITS_PER_PASS
        counts = (
            df.where(h.startswith(prefix)).groupBy(F.substring(h, 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("n")).collect()
        )
        for row in sorted(counts):
            if left <= row["n"]:
                prefix = row["p"]
                break
            left -= row["n"]
        else:
            return df.where(h.isNotNull()), df.where(h.isNull())
        if left == row["n"]:  # the prefix belongs to the first rows as a whole
            return df.where(F.substring(h, 1, width) <= prefix), df.where(h.isNull() | (F.substring(h, 1, width) > prefix))
    if left <= 0:
        return df.limit(0), df
    below, above = df.where(h < prefix), df.where(h.isNull() | (h > prefix))
    tied = df.where(h == prefix)
    if hash_column != TIE:
        rows = tied.withColumn(TIE, F.md5(F.to_json(F.struct(*map(column, df.columns)))))
        first, others = (part.drop(TIE) for part in first_by_hash(rows, TIE, left))
    else:  # equal in every column: any of them will do, so they are counted and written out again
        one = tied.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct(*map(column, df.columns))).alias("row"))
        first, others = copies(one, F.least(F.lit(left), F.col("n"))), copies(one, F.col("n") - left)
    return below.unionByName(first), above.unionByName(others)


def copies(one: DataFrame, n: Column, per_part: int = COPIES_PER_PART) -> DataFrame:
    """The ``row`` struct of each row of ``one``, ``n`` times, in parts of ``per_part`` copies that tasks share."""
    many = one.select("row", F.greatest(n, F.lit(0)).cast("bigint").alias("n")).where(F.col("n") > 0)
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / per_part).cast("bigint")))
    # A given number of tasks: adaptive execution would join the parts again, which are tiny before they are written out.
    tasks = int(one.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = many.select("row", "n", part.alias("part")).repartition(tasks, "part")
    here = F.least(F.lit(per_part).cast("bigint"), F.col("n") - F.col("part") * per_part)
    return parts.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), here)).alias("copy")).select("row.*")
