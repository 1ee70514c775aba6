"""Variable profiles: bins, counts, shares, information value and population stability.

Everything that touches rows is one scan each: statistics, edges, counts. All variables of a
snapshot share these scans, and only per-bin counts come out of the last one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import config
from ..config import DEFAULT_SPEC, SnapshotSpec
from ..functions.expressions import as_number, column, divergence, double_array, ratio
from ..sources.workspace import stored
from . import ranges
from .prepare import OTHER_LEVEL, count_levels, discover_levels

TRAIN, TEST = "TRAIN", "TEST"
TYPE = "data_type"
LEAF_ROWS = 2_000_000
EDGE_RANGES = 256
INF = float("inf")


def variable_types(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """``(categorical, numerical)``: text columns, and number or boolean columns."""
    categorical, numerical = [], []
    for f in df.schema:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numerical.append(f.name)
        else:
            raise TypeError(f"Column {f.name!r} has unsupported type {f.dataType.simpleString()}.")
    return categorical, numerical


def tag_and_union(train: DataFrame, test: DataFrame, spec: SnapshotSpec = DEFAULT_SPEC) -> DataFrame:
    """Both snapshots by column name, tagged TRAIN / TEST, without keys."""
    def tagged(df: DataFrame, tag: str) -> DataFrame:
        rest = [column(n) for n in df.columns if n not in spec.keys and n != TYPE]
        return df.select(*rest, F.lit(tag).alias(TYPE))

    return tagged(train, TRAIN).unionByName(tagged(test, TEST), allowMissingColumns=True)


# -- edges ------------------------------------------------------------------------------------


def _pool(df: DataFrame, variables: Sequence[str], special_values: Sequence[float]) -> DataFrame:
    """Numeric variables as doubles under the names v0, v1, ...; special values leave the pool."""
    def pooled(name: str) -> Column:
        x = as_number(df, name)
        return F.when(~x.isin(*special_values), x) if special_values else x

    return df.select(*[pooled(n).alias(f"v{i}") for i, n in enumerate(variables)])


def _stack(columns: Mapping[str, Column], df: DataFrame, ids: Sequence[str], value: str) -> DataFrame:
    """``(ids, variable, value)``: one row per source row and variable, NULL values left out."""
    wide = df.select(*[column(n) for n in ids], *[c.alias(n) for n, c in columns.items()])
    long = wide.unpivot([column(n) for n in ids], [column(n) for n in columns], "variable", value)
    return long.where(F.col(value).isNotNull())


def value_frequencies(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Rows per value of each numeric variable; ``ratio`` is the share of all rows, nulls included."""
    total = df.count()
    long = _stack({n: as_number(df, n) for n in variables}, df, [], "value")
    return (
        long.groupBy("variable", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("ratio", ratio(F.col("count"), F.lit(total)))
    )


@dataclass(frozen=True)
class _Target:
    """One wanted edge: the largest value with at most ``limit`` rows up to it."""

    variable: str
    limit: int
    range: int | None = 0  # the range the limit falls into; None when no row is beyond it
    before: int = 0  # rows in earlier ranges
    rows: int = 0  # rows of that range, without those at its first value
    low: float | None = None  # largest value of earlier ranges


def _locate(pool: DataFrame, points: Mapping[str, list[float]], limits: Mapping[str, list[int]]) -> list[_Target]:
    """Find the range of every limit from per-range counts (variables x ranges rows)."""
    ranged = ranges.with_ranges(pool, points)

    def entry(name: str) -> Column:
        number = column(name + "_range")
        starts = F.expr(double_array(points[name]))
        return F.struct(
            number.alias("range"),
            column(name).alias("value"),
            ((number == 0) | (column(name) != F.get(starts, number - 1))).alias("inner"),
        )

    counts = (
        _stack({n: F.when(column(n).isNotNull(), entry(n)) for n in points}, ranged, [], "e")
        .groupBy("variable", F.col("e.range").alias("range"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("e.inner")).alias("inner_rows"),
            F.max("e.value").alias("largest"),
        )
    )
    by_variable: dict[str, list] = {n: [] for n in points}
    for row in counts.collect():
        by_variable[row["variable"]].append((row["range"], row["rows"], row["inner_rows"], row["largest"]))

    targets = []
    for name, rows in by_variable.items():
        rows.sort()
        for limit in limits[name]:
            before, low, hit = 0, None, None
            for number, count, inner, largest in rows:
                if before + count > limit:
                    hit = _Target(name, limit, number, before, inner, low)
                    break
                before, low = before + count, largest
            targets.append(hit or _Target(name, limit, None, before, 0, low))
    return targets


def _refined(pool: DataFrame, points: dict[str, list[float]], wide: Sequence[_Target], n: int) -> dict[str, list[float]]:
    """Cut the given ranges further, at points strictly inside them."""
    def inside(t: _Target) -> Column:
        starts = [-INF, *points[t.variable], INF]
        x = column(t.variable)
        return F.when((x > starts[t.range]) & (x < starts[t.range + 1]), x)

    chosen = list({(t.variable, t.range): t for t in wide}.values())
    sliced = pool.select(*[inside(t).alias(f"c{i}") for i, t in enumerate(chosen)])
    cuts = ranges.split_points(sliced, sliced.columns, max(t.rows for t in chosen), n)
    if not all(cuts.values()):  # the sketch sample missed a range
        cuts = ranges.split_points(sliced, sliced.columns, 0, n)
    refined = {v: set(p) for v, p in points.items()}
    for i, t in enumerate(chosen):
        refined[t.variable] |= set(cuts[f"c{i}"])
    return {v: sorted(p) for v, p in refined.items()}


def _edges_in_ranges(pool: DataFrame, points: Mapping[str, list[float]], targets: Sequence[_Target]) -> DataFrame:
    """Per target the largest value of its range that still fits, from the rows of these ranges only."""
    ranged = ranges.with_ranges(pool, points)
    wanted: dict[str, set[int]] = {}
    for t in targets:
        wanted.setdefault(t.variable, set()).add(t.range)
    entries = {
        n: F.when(
            column(n + "_range").isin(*numbers),
            F.struct(column(n + "_range").alias("range"), column(n).alias("value")),
        )
        for n, numbers in wanted.items()
    }
    counted = (
        _stack(entries, ranged, [], "e")
        .groupBy("variable", F.col("e.range").alias("range"), F.col("e.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    upward = Window.partitionBy("variable", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("upto", F.sum("rows").over(upward))
    # variables x quantiles rows, fixed by the schema and the arguments
    asked = pool.sparkSession.createDataFrame(
        [(t.variable, t.range, t.limit, t.limit - t.before) for t in targets],
        "variable string, range int, limit bigint, room bigint",
    )
    return (
        running.join(F.broadcast(asked), ["variable", "range"])
        .where(F.col("upto") <= F.col("room"))
        .groupBy("variable", "limit")
        .agg(F.max("value").alias("edge"))
    )


def quantile_edges(
    df: DataFrame,
    variables: Sequence[str],
    quantiles: Sequence[float] = config.QUANTILES,
    special_values: Sequence[float] = (),
    pool_rows: Mapping[str, int] | None = None,
    leaf_rows: int = LEAF_ROWS,
    n_ranges: int = EDGE_RANGES,
) -> dict[str, list[float]]:
    """Inner edges per variable: for each q the largest value whose cumulative share is <= q.

    Shares refer to all rows that hold no special value, NULLs included. Exact: when a variable
    has more than ``leaf_rows`` rows, per-range counts locate the ranges in question (and refine
    them while they are too long), and only their rows are counted value by value.
    """
    if not variables:
        return {}
    if pool_rows is None:
        pool_rows, _ = _row_counts(df, variables, special_values)
    pool = _pool(df, variables, special_values)
    names = dict(zip(pool.columns, variables))
    limits = {v: sorted({int(Decimal(str(q)) * pool_rows[n]) for q in quantiles}) for v, n in names.items()}
    points: dict[str, list[float]] = {v: [] for v in names}
    if max(pool_rows.values()) > leaf_rows:
        points = ranges.split_points(pool, pool.columns, max(pool_rows.values()), n_ranges)
        targets = _locate(pool, points, limits)
        while wide := [t for t in targets if t.rows > leaf_rows]:
            refined = _refined(pool, points, wide, n_ranges)
            if refined == points:  # nothing finite left to cut at
                break
            points = refined
            targets = _locate(pool, points, limits)
    else:
        targets = [_Target(v, limit) for v in names for limit in limits[v]]

    found = {(t.variable, t.limit): t.low for t in targets}
    open_targets = [t for t in targets if t.range is not None]
    if open_targets:
        for row in _edges_in_ranges(pool, points, open_targets).collect():
            found[row["variable"], row["limit"]] = row["edge"]
    return {n: sorted({found[v, k] for k in limits[v]} - {None, -INF, INF}) for v, n in names.items()}


def approximate_edges(
    df: DataFrame,
    variables: Sequence[str],
    quantiles: Sequence[float] = config.QUANTILES,
    special_values: Sequence[float] = (),
    accuracy: int = 10_000,
) -> dict[str, list[float]]:
    """Edges from one sketch pass; approximate, and NULLs do not count."""
    if not variables:
        return {}
    pool = _pool(df, variables, special_values)
    row = pool.agg(
        *[F.percentile_approx(column(v), list(quantiles), accuracy) for v in pool.columns]
    ).first()
    return {n: sorted({float(x) for x in row[i] or ()}) for i, n in enumerate(variables)}


def _row_counts(df, variables, special_values) -> tuple[dict[str, int], dict[str, list[float]]]:
    """Per variable: rows without a special value, and the special values that occur."""
    hits = [
        F.count_if(as_number(df, n) == F.lit(float(v))).alias(f"h{i}_{j}")
        for i, n in enumerate(variables) for j, v in enumerate(special_values)
    ]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *hits).first()
    pool_rows, present = {}, {}
    for i, n in enumerate(variables):
        counts = [row[f"h{i}_{j}"] for j in range(len(special_values))]
        pool_rows[n] = row["rows"] - sum(counts)
        present[n] = [float(v) for v, c in zip(special_values, counts) if c]
    return pool_rows, present


# -- bins -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Bins:
    """Fitted bins: inner edges and occurring special values per numeric variable, names of the text variables.

    ``kept`` lists the levels of those text variables whose rarer levels are gathered under one.
    """

    edges: dict[str, list[float]] = field(default_factory=dict)
    specials: dict[str, list[float]] = field(default_factory=dict)
    categorical: tuple[str, ...] = ()
    kept: dict[str, list[str]] = field(default_factory=dict)

    @property
    def numerical(self) -> list[str]:
        return list(self.edges)

    def intervals(self, name: str) -> list[tuple[int, float, float]]:
        """``(bin, low, high)``, special values first."""
        framed = [-INF, *self.edges[name], INF]
        special = [(-i, v, v) for i, v in enumerate(self.specials.get(name, ()), 1)]
        return sorted(special) + [(i, lo, hi) for i, (lo, hi) in enumerate(zip(framed, framed[1:]))]


def assign_bin(x: Column, edges: Sequence[float], specials: Sequence[float] = (), kind: type = int) -> Column:
    """Bin of a double: right-closed intervals 0..k, special values -1, -2, ...; NULL stays NULL.

    ``kind`` is int or str, the type of the bin numbers.
    """
    chain = F.when(x.isNull(), F.lit(None))
    for i, v in enumerate(specials, 1):
        chain = chain.when(x == F.lit(float(v)), F.lit(kind(-i)))
    for i, edge in enumerate(edges):
        chain = chain.when(x <= F.lit(float(edge)), F.lit(kind(i)))
    return chain.otherwise(F.lit(kind(len(edges))))


def fit_bins(
    df: DataFrame,
    exclude: Sequence[str] = (DEFAULT_SPEC.target, TYPE),
    quantiles: Sequence[float] = config.QUANTILES,
    special_values: Sequence[float] = config.SPECIAL_VALUES,
    approximate: bool = False,
    max_levels: int | None = None,
    overflow: str = "error",
    levels_from: DataFrame | None = None,
    **options,
) -> Bins:
    """Learn the bins of all variables of ``df``.

    Text variables may have any number of levels. With ``max_levels`` one that has more in the rows that
    will be counted (``levels_from``, default ``df``) is refused, or cut with ``overflow="other"``.
    """
    categorical, numerical = variable_types(df, exclude)
    specials: dict[str, list[float]] = {}
    edges: dict[str, list[float]] = {}
    if numerical:
        pool_rows, specials = _row_counts(df, numerical, special_values)
        if approximate:
            edges = approximate_edges(df, numerical, quantiles, special_values)
        else:
            edges = quantile_edges(df, numerical, quantiles, special_values, pool_rows, **options)
    rows = df if levels_from is None else levels_from
    counted = count_levels(rows, categorical) if max_levels is not None else {}
    wide = [n for n, levels in counted.items() if levels > max_levels]
    if wide and overflow == "error":
        raise ValueError(f"More than {max_levels} levels in column(s) {', '.join(wide)}.")
    kept = discover_levels(rows, wide, max_levels, overflow)[0] if wide else {}
    return Bins(edges, specials, tuple(categorical), kept)


def bin_counts(df: DataFrame, bins: Bins, target: str = DEFAULT_SPEC.target) -> DataFrame:
    """Rows and bad rows per ``(data_type, variable, bin)`` for all variables in one aggregation.

    NULLs have no bin. Bins are combined before the shuffle, so each task sends at most one row
    per bin however the values are distributed.
    """
    numeric = {
        n: assign_bin(as_number(df, n), bins.edges[n], bins.specials.get(n, ()), str)
        for n in bins.numerical
    }

    def level(n: str) -> Column:
        c = column(n)
        if n in bins.kept:
            return F.when(c.isNull() | c.isin(*bins.kept[n]), c).otherwise(F.lit(OTHER_LEVEL))
        return c

    columns = {**numeric, **{n: level(n) for n in bins.categorical}}
    return (
        _stack(columns, df, [TYPE, target], "bin")
        .groupBy(TYPE, "variable", "bin")
        .agg(F.count(F.lit(1)).alias("count"), F.sum(column(target).cast("bigint")).alias("bad"))
    )


def pooled(counts: DataFrame, scope: str = "pooled") -> DataFrame:
    """Counts of all rows (``pooled``) or of one data type (``train`` / ``test``)."""
    if scope.lower() != "pooled":
        counts = counts.where(F.col(TYPE) == F.lit(scope.upper()))
    return counts.groupBy("variable", "bin").agg(F.sum("count").alias("count"), F.sum("bad").alias("bad"))


def _grid(counts: DataFrame, bins: Bins) -> DataFrame:
    """All intervals of the numeric variables, empty ones included."""
    return counts.sparkSession.createDataFrame(
        [
            (n, str(i), i, f"[{lo!r}, {hi!r}]", lo, hi)
            for n in bins.numerical for i, lo, hi in bins.intervals(n)
        ],
        "variable string, bin string, bin_order int, bin_class string, bin_low double, bin_high double",
    )


def with_measures(binned: DataFrame) -> DataFrame:
    """Shares, running sums, IV per bin and IV per variable.

    Input: ``variable, bin_order, count, bad``, one row per interval. The windows see the intervals of
    one variable, never source rows.
    """
    whole = Window.partitionBy("variable")
    upward = whole.orderBy("bin_order").rowsBetween(Window.unboundedPreceding, 0)
    summed = binned.withColumn("good", F.col("count") - F.col("bad"))
    summed = summed.withColumns({f"cumulative_{n}": F.sum(n).over(upward) for n in ("bad", "good")})
    summed = summed.withColumns({f"whole_{n}": F.sum(n).over(whole) for n in ("count", "bad", "good")})
    return _shares(summed).withColumn("iv", F.sum("iv_1").over(whole))


def _shares(summed: DataFrame) -> DataFrame:
    """Shares and IV terms from counts, running sums and totals."""
    share = lambda part, n: ratio(F.col(part), F.col(f"whole_{n}"))
    return summed.withColumns(
        {
            "total_ratio": share("count", "count"),
            "bad_rate": ratio(F.col("bad"), F.col("count")),
            "bad_ratio": share("bad", "bad"),
            "good_ratio": share("good", "good"),
            "cumulative_bad_ratio": share("cumulative_bad", "bad"),
            "cumulative_good_ratio": share("cumulative_good", "good"),
        }
    ).withColumn("iv_1", divergence(F.col("good_ratio"), F.col("bad_ratio")))


def _level_place(levels: DataFrame, rows_per_range: int | None = None) -> tuple[DataFrame, list[float]]:
    """Number levels in their order: ``place`` is the range of (variable, level) a level lies in.

    Spark cuts the ranges at sampled levels, so what levels begin with does not matter, and the number is stored with the
    level, so that it stays the same however often the table is read. Few levels are one range.
    """
    n_ranges = ranges.range_count(levels.count(), rows_per_range or ranges.ROWS_PER_RANGE)
    if n_ranges == 1:
        return levels.withColumn("place", F.lit(0.0)), []
    cut = levels.repartitionByRange(n_ranges, "variable", "bin").withColumn("place", F.spark_partition_id().cast("double"))
    return stored(cut, "levels"), [float(i) for i in range(1, n_ranges)]


SUMMARY_COLUMNS = (
    "variable", "bin", "bin_order", "bin_class", "count", "bad", "good", "cumulative_bad", "cumulative_good",
    "total_ratio", "bad_rate", "bad_ratio", "good_ratio", "cumulative_bad_ratio", "cumulative_good_ratio",
    "iv_1", "iv",
)


def numerical_summary(counts: DataFrame, bins: Bins, scope: str = "pooled", bounds: bool = False) -> DataFrame:
    """One row per interval; empty intervals count 0. ``bounds`` adds ``bin_low`` and ``bin_high``."""
    joined = _grid(counts, bins).join(pooled(counts, scope), ["variable", "bin"], "left")
    filled = joined.withColumns({n: F.coalesce(n, F.lit(0).cast("bigint")) for n in ("count", "bad")})
    extra = ("bin_low", "bin_high") if bounds else ()
    return with_measures(filled).select(*SUMMARY_COLUMNS, *extra)


def categorical_summary(counts: DataFrame, bins: Bins, scope: str = "pooled", rows_per_range: int | None = None) -> DataFrame:
    """One row per level, in level order.

    A variable may have as many levels as rows, so running sums go over ranges of levels. Totals and IV
    are one row per text column of the schema, so they are broadcast: a join that deals the levels by
    variable would put all levels of a variable into one task.
    """
    levels = pooled(counts, scope).where(F.col("variable").isin(*bins.categorical)).withColumns(
        {"good": F.col("count") - F.col("bad"), "one": F.lit(1)}
    )
    placed, points = _level_place(levels, rows_per_range)
    running = ranges.running_totals(placed, ["variable"], "place", ["one", "bad", "good"], points, ties=["bin"])
    totals = placed.groupBy("variable").agg(*[F.sum(n).alias(f"whole_{n}") for n in ("count", "bad", "good")])
    summed = running.join(F.broadcast(totals), "variable").withColumns({
        "bin_order": (F.col("running_one") - 1).cast("int"), "bin_class": F.col("bin"),
        "cumulative_bad": F.col("running_bad"), "cumulative_good": F.col("running_good"),
    })
    shares = _shares(summed)
    iv = shares.groupBy("variable").agg(F.sum("iv_1").alias("iv"))
    return shares.join(F.broadcast(iv), "variable").select(*SUMMARY_COLUMNS)


def binning_summary(counts: DataFrame, bins: Bins, scope: str = "pooled") -> DataFrame:
    """Numerical bins, then categorical ones; either group may be empty."""
    parts = []
    if bins.numerical:
        parts.append(numerical_summary(counts, bins, scope))
    if bins.categorical or not parts:
        parts.append(categorical_summary(counts, bins, scope))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


# -- information value and stability ----------------------------------------------------------


def variable_iv(summary: DataFrame, label: str = TRAIN) -> DataFrame:
    return summary.groupBy("variable").agg(F.max("iv").alias(f"iv_{label.lower()}"))


def psi_bins(counts: DataFrame, base: str = TRAIN, compare: str = TEST) -> DataFrame:
    """Share of each base bin in both data types and its PSI term; 0 where a bin is missing in one."""
    whole = Window.partitionBy("variable")
    per_type = counts.groupBy("variable", "bin").pivot(TYPE, [base, compare]).agg(F.sum("count"))

    def share(tag: str) -> Column:
        return ratio(column(tag), F.sum(column(tag)).over(whole))

    left, right = f"total_ratio_{base.lower()}", f"total_ratio_{compare.lower()}"
    shares = per_type.select("variable", "bin", column(base), share(base).alias(left), share(compare).alias(right))
    return shares.where(column(base).isNotNull()).select(
        "variable", "bin", left, F.coalesce(column(right), F.lit(0.0)).alias(right),
        F.coalesce(divergence(column(left), column(right)), F.lit(0.0)).alias("psi"),
    )


def variable_psi(per_bin: DataFrame) -> DataFrame:
    return per_bin.groupBy("variable").agg(F.sum("psi").alias("psi"))


def iv_psi_table(summary: DataFrame, per_bin: DataFrame) -> DataFrame:
    iv = summary.groupBy("variable").agg(F.max("iv").alias("iv"))
    return iv.join(variable_psi(per_bin), "variable", "left").select(
        "variable", "iv", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def select_variables(table: DataFrame, min_iv: float | None = None, max_psi: float | None = None) -> DataFrame:
    """Screen variables by IV and PSI; without thresholds all stay."""
    if min_iv is not None:
        table = table.where(F.col("iv") >= F.lit(float(min_iv)))
    if max_psi is not None:
        table = table.where(F.col("psi") <= F.lit(float(max_psi)))
    return table


@dataclass(frozen=True)
class Profile:
    """Profile of two snapshots: fitted bins and per-bin counts.

    All tables derive from the counts, which hold one row per data type, variable and bin.
    """

    bins: Bins
    counts: DataFrame
    scope: str = "pooled"

    @property
    def summary(self) -> DataFrame:
        return binning_summary(self.counts, self.bins, self.scope)

    @property
    def psi_bins(self) -> DataFrame:
        return psi_bins(self.counts)

    @property
    def table(self) -> DataFrame:
        return iv_psi_table(self.summary, self.psi_bins)


def profile(
    train: DataFrame,
    test: DataFrame,
    spec: SnapshotSpec = DEFAULT_SPEC,
    edges_from: str = "pooled",
    scope: str = "pooled",
    **options,
) -> Profile:
    """Profile all variables; bins come from both snapshots (``pooled``) or from ``train`` alone.

    The counts are stored, so that the summary and the stability tables do not scan the snapshots
    once each.
    """
    for argument in (edges_from, scope):
        if argument not in ("pooled", "train"):
            raise ValueError("edges_from and scope must be 'pooled' or 'train'.")
    both = tag_and_union(train, test, spec)
    source = both if edges_from == "pooled" else both.where(F.col(TYPE) == TRAIN)
    bins = fit_bins(source, exclude=(spec.target, TYPE), levels_from=both, **options)
    return Profile(bins, stored(bin_counts(both, bins, spec.target), "bin_counts"), scope)
