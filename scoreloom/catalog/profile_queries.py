"""Binning, information value and stability of variables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.expressions import as_number, insert_column
from ..operators import binning, ranges
from ..sources import snapshots as io, tables
from ..sources.snapshots import write_table
from ..sources.workspace import fresh_path, stored
from .base import (
    BINNED, NUMBER_BINS, NUMBERS, NUMERIC, SNAPSHOT, SUMMARY_SELECT, TEXT, TEXT_BINS, both, edges_sql,
    measures_sql, profile_sql, query, rounded, stored_both,
)

PROFILE = profile_sql()


def _profile(spark, folder, **options) -> binning.Profile:
    return binning.profile(*stored_both(spark, folder), **options)


def _edge_rows(spark, edges: dict[str, list[float]]) -> DataFrame:
    rows = [(n, i, e) for n, values in edges.items() for i, e in enumerate(values, 1)]
    return spark.createDataFrame(rows, "variable string, position int, edge double")


# -- inputs -----------------------------------------------------------------------------------


@query("profile_union", f"WITH {SNAPSHOT} SELECT 1 AS one, * EXCLUDE (base_ym, customer_id, customer_hash) FROM snap")
def profile_union(spark, folder):
    return insert_column(binning.tag_and_union(*both(spark, folder)), 0, "one", F.lit(1))


@query(
    "profile_variable_types",
    f"WITH {SNAPSHOT} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS variable, '{kind}' AS kind, count({n}) AS n_values FROM snap"
        for kind, names in (("categorical", TEXT), ("numerical", NUMERIC)) for n in names
    ),
)
def profile_variable_types(spark, folder):
    rows = binning.tag_and_union(*both(spark, folder))
    kinds = dict(zip(("categorical", "numerical"), binning.variable_types(rows, exclude=("PERF", binning.TYPE))))
    named = [(kind, n) for kind, names in kinds.items() for n in names]
    counts = rows.agg(*[F.count(n).alias(n) for _, n in named])
    return counts.select(
        F.inline(F.array(*[
            F.struct(F.lit(n).alias("variable"), F.lit(kind).alias("kind"), F.col(n).alias("n_values"))
            for kind, n in named
        ]))
    )


LINE_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query(
    "bin_value_freq",
    f"""SELECT variable, value, count(*) AS count, round(count(*) / (SELECT count(*) FROM lineitem), 6) AS ratio
FROM (SELECT {', '.join(LINE_NUMBERS)} FROM lineitem) UNPIVOT (value FOR variable IN ({', '.join(LINE_NUMBERS)}))
GROUP BY variable, value""",
)
def bin_value_freq(spark, folder):
    return rounded_ratio(binning.value_frequencies(tables.table(spark, folder, "lineitem"), LINE_NUMBERS))


def rounded_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn("ratio", F.round("ratio", 6))


@query(
    "dist_prefix_sum",
    f"""SELECT variable, value, count(*) AS rows,
       CAST(sum(count(*)) OVER (PARTITION BY variable ORDER BY value) AS BIGINT) AS running_rows
FROM (SELECT {', '.join(LINE_NUMBERS)} FROM lineitem) UNPIVOT (value FOR variable IN ({', '.join(LINE_NUMBERS)}))
GROUP BY variable, value""",
)
def dist_prefix_sum(spark, folder):
    lines = tables.table(spark, folder, "lineitem").select(*LINE_NUMBERS)
    cuts = ranges.split_points(lines, LINE_NUMBERS, lines.count(), 256)
    points = sorted({p for values in cuts.values() for p in values})
    counts = (
        lines.unpivot([], list(LINE_NUMBERS), "variable", "value")
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value").agg(F.count(F.lit(1)).alias("rows"))
    )
    return ranges.running_totals(counts, ["variable"], "value", ["rows"], points)


def _levels_sql(level: str) -> str:
    return f"""WITH levels AS (
  SELECT {level} AS bin, count(*) AS count, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS BIGINT) AS bad FROM orders GROUP BY 1
), summed AS (
  SELECT *, count - bad AS good, sum(bad) OVER (ORDER BY bin) AS cumulative_bad, sum(count - bad) OVER (ORDER BY bin) AS cumulative_good,
         sum(bad) OVER () AS all_bad, sum(count - bad) OVER () AS all_good FROM levels
), terms AS (
  SELECT *, CASE WHEN bad = 0 OR good = 0 THEN 0.0
                 ELSE (good / all_good - bad / all_bad) * ln((good / all_good) / (bad / all_bad)) END AS term FROM summed
)
SELECT bin, CAST(row_number() OVER (ORDER BY bin) - 1 AS INTEGER) AS bin_order, count, bad,
       CAST(cumulative_bad AS BIGINT) AS cumulative_bad, CAST(cumulative_good AS BIGINT) AS cumulative_good,
       round(term, 6) AS iv_1, round(sum(term) OVER (), 6) AS iv FROM terms"""


def _levels(rows: DataFrame, exclude=("PERF", binning.TYPE)) -> DataFrame:
    tagged = rows.withColumn(binning.TYPE, F.lit(binning.TRAIN))
    bins = binning.fit_bins(tagged, exclude=exclude)
    counts = stored(binning.bin_counts(tagged, bins), "bin_counts")
    summary = binning.categorical_summary(counts, bins)
    return rounded(summary.select("bin", "bin_order", "count", "bad", "cumulative_bad", "cumulative_good", "iv_1", "iv"))


@query("iv_wide_levels", _levels_sql("'order-' || CAST(o_orderkey AS VARCHAR)"))
def iv_wide_levels(spark, folder):
    """A text variable with about as many levels as there are orders."""
    return _levels(tables.table(spark, folder, "orders").select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("code"),
        (F.col("o_orderstatus") == "F").cast("int").alias("PERF"),
    ))


@query("iv_date_levels", _levels_sql("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"))
def iv_date_levels(spark, folder):
    """Order dates that went through a CSV file, its types inferred: dates are text, and so categorical."""
    orders = tables.table(spark, folder, "orders").select("o_orderdate", (F.col("o_orderstatus") == "F").cast("int").alias("PERF"))
    path = io.write_csv(orders, f"{fresh_path(spark, 'dates')}.csv")
    return _levels(io.read_snapshot(spark, path))


# -- edges and bins ---------------------------------------------------------------------------

EDGES = f"""WITH {SNAPSHOT},{NUMBERS},{edges_sql()}
SELECT variable, CAST(row_number() OVER (PARTITION BY variable ORDER BY edge) AS INTEGER) AS position, edge FROM edges"""


@query("bin_quantile_edges", EDGES)
def bin_quantile_edges(spark, folder):
    return _edge_rows(spark, binning.quantile_edges(binning.tag_and_union(*stored_both(spark, folder)), NUMERIC))


@query("bin_quantile_edges_refined", EDGES)
def bin_quantile_edges_refined(spark, folder):
    """The way large snapshots take: locate value ranges, refine them, count only inside them."""
    rows = binning.tag_and_union(*stored_both(spark, folder))
    return _edge_rows(spark, binning.quantile_edges(rows, NUMERIC, leaf_rows=100, n_ranges=8))


@query("bin_quantile_edges_approx")
def bin_quantile_edges_approx(spark, folder):
    return _edge_rows(spark, binning.approximate_edges(binning.tag_and_union(*both(spark, folder)), NUMERIC))


@query(
    "bin_special_values",
    f"""WITH {SNAPSHOT},{NUMBERS},{edges_sql(special='0')},{BINNED},
present AS (SELECT DISTINCT variable FROM numbers WHERE value = 0),
grid AS (
  SELECT variable, bin_order, low, high FROM intervals
  UNION ALL SELECT variable, -1, 0, 0 FROM present
),
placed AS (
  SELECT variable, CASE WHEN value = 0 THEN -1 ELSE bin_order END AS bin_order, PERF FROM binned
)
SELECT g.variable, CAST(g.bin_order AS INTEGER) AS bin_order, count(p.PERF) AS count,
       CAST(coalesce(sum(p.PERF), 0) AS BIGINT) AS bad
FROM grid g LEFT JOIN placed p ON p.variable = g.variable AND p.bin_order = g.bin_order
GROUP BY g.variable, g.bin_order""",
)
def bin_special_values(spark, folder):
    profiled = _profile(spark, folder, special_values=(0.0,))
    return binning.numerical_summary(profiled.counts, profiled.bins).select("variable", "bin_order", "count", "bad")


BIN_ASSIGN = (
    f"WITH {SNAPSHOT},{NUMBERS},{edges_sql()} SELECT base_ym, customer_id, "
    + ", ".join(
        f"CASE WHEN {n} IS NOT NULL THEN CAST((SELECT count(*) FROM edges WHERE variable = '{n}' "
        f"AND edge < CAST({'CAST(is_overdrawn AS INTEGER)' if n == 'is_overdrawn' else n} AS DOUBLE)) AS INTEGER) "
        f"END AS {n}_bin"
        for n in NUMERIC
    )
    + " FROM snap"
)


@query("bin_assign", BIN_ASSIGN)
def bin_assign(spark, folder):
    rows = stored(tables.snapshots(spark, folder), "snapshots")
    edges = binning.quantile_edges(rows, NUMERIC)
    return rows.select(
        "base_ym", "customer_id",
        *[binning.assign_bin(as_number(rows, n), edges[n]).alias(f"{n}_bin") for n in NUMERIC],
    )


# -- summaries --------------------------------------------------------------------------------


@query(
    "iv_categorical",
    f"WITH {SNAPSHOT},{NUMBERS},{edges_sql()},{BINNED},{TEXT_BINS.format(scope='TRUE')},{measures_sql('text_bins')}"
    "SELECT variable, bin, CAST(bin_order AS INTEGER) AS bin_order, count, bad, good, round(iv, 6) AS iv FROM summary",
)
def iv_categorical(spark, folder):
    p = _profile(spark, folder)
    summary = binning.categorical_summary(p.counts, p.bins)
    return rounded(summary.select("variable", "bin", "bin_order", "count", "bad", "good", "iv"))


@query(
    "iv_numerical",
    f"WITH {SNAPSHOT},{NUMBERS},{edges_sql()},{BINNED},{NUMBER_BINS.format(scope='TRUE')},{measures_sql('number_bins')}"
    "SELECT variable, CAST(bin_order AS INTEGER) AS bin_order, bin_class, count, bad, good, round(iv, 6) AS iv FROM summary",
)
def iv_numerical(spark, folder):
    p = _profile(spark, folder)
    summary = binning.numerical_summary(p.counts, p.bins)
    return rounded(summary.select("variable", "bin_order", "bin_class", "count", "bad", "good", "iv"))


def _summary_part(name: str, columns: tuple[str, ...]) -> None:
    picked = ", ".join(
        f"round({c}, 6) AS {c}" if c.endswith(("ratio", "rate")) or c.startswith("iv") else c for c in columns
    )

    @query(name, f"{PROFILE} SELECT variable, bin, {picked} FROM summary")
    def run(spark, folder):
        return rounded(_profile(spark, folder).summary.select("variable", "bin", *columns))


_summary_part("bin_ratios", ("total_ratio", "bad_rate", "bad_ratio", "good_ratio"))
_summary_part(
    "bin_cumulative", ("cumulative_bad", "cumulative_good", "cumulative_bad_ratio", "cumulative_good_ratio")
)
_summary_part("iv_bins", ("iv_1", "iv"))


@query("binning_summary", f"{PROFILE}{SUMMARY_SELECT}")
def binning_summary(spark, folder):
    return rounded(_profile(spark, folder).summary)


@query("binning_summary_train", profile_sql("data_type = 'TRAIN'", "data_type = 'TRAIN'") + SUMMARY_SELECT)
def binning_summary_train(spark, folder):
    return rounded(_profile(spark, folder, edges_from="train", scope="train").summary)


@query("sink_binning_summary", f"{PROFILE}{SUMMARY_SELECT}")
def sink_binning_summary(spark, folder):
    path = write_table(_profile(spark, folder).summary, fresh_path(spark, "profile"), "binning_summary", "run1")
    return rounded(spark.read.parquet(path))


# -- information value and stability ----------------------------------------------------------


@query("iv_by_variable", f"{PROFILE} SELECT variable, round(max(iv), 6) AS iv_train FROM summary GROUP BY variable")
def iv_by_variable(spark, folder):
    return rounded(binning.variable_iv(_profile(spark, folder).summary))


@query(
    "psi_bins",
    f"{PROFILE} SELECT variable, bin, round(total_ratio_train, 6) AS total_ratio_train, "
    "round(total_ratio_test, 6) AS total_ratio_test, round(psi, 6) AS psi FROM psi_bins",
)
def psi_bins(spark, folder):
    return rounded(_profile(spark, folder).psi_bins)


@query("psi_by_variable", f"{PROFILE} SELECT variable, round(sum(psi), 6) AS psi FROM psi_bins GROUP BY variable")
def psi_by_variable(spark, folder):
    return rounded(binning.variable_psi(_profile(spark, folder).psi_bins))


TABLE = f"""{PROFILE}, result AS (
  SELECT s.variable, s.iv, coalesce(p.psi, 0) AS psi
  FROM (SELECT variable, max(iv) AS iv FROM summary GROUP BY variable) s
  LEFT JOIN (SELECT variable, sum(psi) AS psi FROM psi_bins GROUP BY variable) p USING (variable)
)
SELECT variable, round(iv, 6) AS iv, round(psi, 6) AS psi FROM result"""


@query("iv_psi_table", TABLE)
def iv_psi_table(spark, folder):
    return rounded(_profile(spark, folder).table)


@query("sink_iv_psi", TABLE)
def sink_iv_psi(spark, folder):
    p = _profile(spark, folder)
    target = fresh_path(spark, "ivpsi")
    iv = spark.read.parquet(write_table(binning.variable_iv(p.summary), target, "iv", "run1"))
    psi = spark.read.parquet(write_table(binning.variable_psi(p.psi_bins), target, "psi", "run1"))
    joined = iv.withColumnRenamed("iv_train", "iv").join(psi, "variable", "left")
    return rounded(joined.select("variable", "iv", "psi"))


@query("select_by_iv_psi", TABLE + " WHERE iv >= 0.02 AND psi <= 0.01")
def select_by_iv_psi(spark, folder):
    return rounded(binning.select_variables(_profile(spark, folder).table, min_iv=0.02, max_psi=0.01))


# -- a second labelled table ------------------------------------------------------------------

DOCUMENTS = """
docs AS (
  SELECT toxic AS PERF, n_chars, lang, source,
         CASE WHEN md5(concat('docs:', CAST(doc_id AS VARCHAR))) < '80000000' THEN 'TRAIN' ELSE 'TEST' END AS data_type
  FROM labels JOIN documents USING (doc_id)
),
"""


def _documents_sql() -> str:
    text = profile_sql().removeprefix("WITH ")
    shared = text[text.index("cumulated AS"):].replace("segment, urgent_status", "lang, source").replace("FROM snap", "FROM docs")
    numbers = """
numbers AS (SELECT data_type, PERF, 'n_chars' AS variable, CAST(n_chars AS DOUBLE) AS value FROM docs WHERE n_chars IS NOT NULL),
quantiles AS (SELECT unnest([0.2, 0.4, 0.6, 0.8]) AS q),
variables AS (SELECT DISTINCT variable FROM numbers),
"""
    return f"WITH {DOCUMENTS}{numbers}{shared}" + TABLE[len(PROFILE):]


@query("iv_psi_documents", _documents_sql())
def iv_psi_documents(spark, folder):
    documents = tables.table(spark, folder, "documents").select("doc_id", "n_chars", "lang", "source")
    first = F.md5(F.concat(F.lit("docs:"), F.col("doc_id").cast("string"))) < "80000000"
    rows = (
        tables.table(spark, folder, "labels").join(documents, "doc_id")
        .select(F.col("toxic").alias("PERF"), "n_chars", "lang", "source",
                F.when(first, binning.TRAIN).otherwise(binning.TEST).alias(binning.TYPE))
    )
    bins = binning.fit_bins(rows)
    return rounded(binning.Profile(bins, binning.bin_counts(rows, bins)).table)
