"""Registration of queries with their independent SQL, and the SQL parts they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.expressions import column
from ..sources import tables
from ..sources.workspace import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

DIGITS = 6

NUMERIC = (
    "acctbal", "is_overdrawn", "region_key", "n_orders", "total_price", "n_urgent", "max_price", "pending_price",
)
TEXT = ("segment", "urgent_status")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
STATUSES = ("0", "F", "O", "P")


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same rows on the same tables."""
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double columns, so that engines adding in another order agree."""
    return df.select(
        *[
            F.round(column(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else column(f.name)
            for f in df.schema
        ]
    )


def both(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tables.snapshot(spark, folder, "TRAIN"), tables.snapshot(spark, folder, "TEST")


def stored_both(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Both labelled snapshots built in one scan and written once, for queries that pass over them often."""
    table = stored(tables.snapshots(spark, folder), "snapshots", "data_type")
    return tuple(table.where(F.col("data_type") == t).drop("data_type") for t in ("TRAIN", "TEST"))


# -- shared SQL -------------------------------------------------------------------------------

SNAPSHOT = """
per_customer AS (
  SELECT CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'TRAIN'
              WHEN o_orderdate < TIMESTAMP '2001-01-01' THEN 'TEST' ELSE 'SCORE' END AS data_type,
         o_custkey AS customer_id,
         count(*) AS n_orders,
         round(sum(o_totalprice), 2) AS total_price,
         CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS BIGINT) AS n_urgent,
         max(o_totalprice) AS max_price,
         max(o_totalprice) FILTER (WHERE o_orderstatus = 'P') AS pending_price,
         max(o_orderstatus) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent_status
  FROM orders
  WHERE o_orderdate >= TIMESTAMP '1999-01-01' AND o_orderdate < TIMESTAMP '2001-08-01'
  GROUP BY 1, 2
),
all_snapshots AS (
  SELECT data_type,
         CASE data_type WHEN 'TRAIN' THEN '199912' WHEN 'TEST' THEN '200012' ELSE '200107' END AS base_ym,
         customer_id, md5(CAST(c_custkey AS VARCHAR)) AS customer_hash,
         c_acctbal AS acctbal, c_acctbal < 0 AS is_overdrawn, c_mktsegment AS segment, n_regionkey AS region_key,
         n_orders, total_price, n_urgent, max_price, pending_price, urgent_status,
         CASE WHEN md5(concat('s:', data_type, ':', CAST(customer_id AS VARCHAR))) <
                   CASE WHEN total_price > 502365 THEN 'a0000000'
                        WHEN c_mktsegment = 'BUILDING' THEN '60000000' ELSE '30000000' END
              THEN 1 ELSE 0 END AS PERF
  FROM per_customer JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
snap AS (SELECT * FROM all_snapshots WHERE data_type <> 'SCORE'),
train AS (SELECT * EXCLUDE (data_type) FROM all_snapshots WHERE data_type = 'TRAIN'),
test AS (SELECT * EXCLUDE (data_type) FROM all_snapshots WHERE data_type = 'TEST'),
score AS (SELECT * EXCLUDE (data_type, PERF) FROM all_snapshots WHERE data_type = 'SCORE')
"""

LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_returnflag,
         CAST((l_orderkey * 7 + l_linenumber * 13) % 1001 AS DOUBLE) / 1000 AS probability,
         CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS PERF,
         CASE WHEN l_linestatus = 'O' THEN 'val' ELSE 'test' END AS split
  FROM lineitem
)
"""


def one_hot_sql(columns: str, source: str, numeric: bool = True) -> str:
    """Null-filled one-hot select of a snapshot relation."""
    fills = {
        "acctbal": "coalesce(acctbal, 0)", "is_overdrawn": "coalesce(is_overdrawn, FALSE)",
        "region_key": "coalesce(region_key, 0)", "n_orders": "coalesce(n_orders, 0)",
        "total_price": "coalesce(total_price, 0)", "n_urgent": "coalesce(n_urgent, 0)",
        "max_price": "coalesce(max_price, 0)", "pending_price": "coalesce(pending_price, 0)",
    }
    parts = [columns] if columns else []
    if numeric:
        parts += [f"{sql} AS {name}" for name, sql in fills.items()]
    parts += [f"CASE WHEN segment = '{v}' THEN 1 ELSE 0 END AS segment_{v}" for v in SEGMENTS]
    parts += [
        f"CASE WHEN coalesce(urgent_status, '0') = '{v}' THEN 1 ELSE 0 END AS urgent_status_{v}" for v in STATUSES
    ]
    return f"SELECT {', '.join(parts)} FROM {source}"


NUMBERS = """
numbers AS (
  SELECT data_type, PERF, variable, value FROM (
    SELECT data_type, PERF, acctbal, CAST(CAST(is_overdrawn AS INTEGER) AS DOUBLE) AS is_overdrawn,
           CAST(region_key AS DOUBLE) AS region_key, CAST(n_orders AS DOUBLE) AS n_orders, total_price,
           CAST(n_urgent AS DOUBLE) AS n_urgent, max_price, pending_price
    FROM snap
  ) UNPIVOT (value FOR variable IN (
    acctbal, is_overdrawn, region_key, n_orders, total_price, n_urgent, max_price, pending_price))
),
quantiles AS (SELECT unnest([0.2, 0.4, 0.6, 0.8]) AS q),
variables AS (SELECT DISTINCT variable FROM numbers)
"""


def edges_sql(scope: str = "TRUE", special: str = "") -> str:
    """Edges per variable: largest value whose cumulative count is within q of the rows in scope."""
    pool = f"({scope})" + (f" AND value NOT IN ({special})" if special else "")
    held = f"(SELECT count(*) FROM numbers s WHERE s.variable = c.variable AND value IN ({special}))" if special else "0"
    return f"""
cumulated AS (
  SELECT variable, value, sum(count(*)) OVER (PARTITION BY variable ORDER BY value) AS upto
  FROM numbers WHERE {pool} GROUP BY variable, value
),
edges AS (
  SELECT DISTINCT variable, edge FROM (
    SELECT c.variable, q, max(value) AS edge FROM cumulated c, quantiles
    WHERE upto <= q * ((SELECT count(*) FROM snap WHERE {scope}) - {held}) GROUP BY c.variable, q)
),
intervals AS (
  SELECT variable, row_number() OVER (PARTITION BY variable ORDER BY low NULLS FIRST) - 1 AS bin_order, low,
         lead(low) OVER (PARTITION BY variable ORDER BY low NULLS FIRST) AS high
  FROM (SELECT variable, edge AS low FROM edges UNION ALL SELECT variable, NULL FROM variables)
)
"""


BINNED = """
binned AS (
  SELECT n.data_type, n.PERF, n.variable, n.value, i.bin_order
  FROM numbers n JOIN intervals i ON n.variable = i.variable
   AND (i.low IS NULL OR n.value > i.low) AND (i.high IS NULL OR n.value <= i.high)
),
levels AS (
  SELECT data_type, PERF, variable, bin FROM (SELECT data_type, PERF, segment, urgent_status FROM snap)
  UNPIVOT (bin FOR variable IN (segment, urgent_status))
)
"""

TEXT_BINS = """
text_bins AS (
  SELECT variable, bin, row_number() OVER (PARTITION BY variable ORDER BY bin) - 1 AS bin_order, bin AS bin_class,
         count(*) AS count, CAST(sum(PERF) AS BIGINT) AS bad
  FROM levels WHERE {scope} GROUP BY variable, bin
)
"""

NUMBER_BINS = """
number_bins AS (
  SELECT i.variable, CAST(i.bin_order AS VARCHAR) AS bin, i.bin_order,
         concat('[', coalesce(CAST(i.low AS VARCHAR), '-inf'), ', ', coalesce(CAST(i.high AS VARCHAR), 'inf'), ']')
           AS bin_class,
         count(b.value) AS count, CAST(coalesce(sum(b.PERF), 0) AS BIGINT) AS bad
  FROM intervals i LEFT JOIN (SELECT * FROM binned WHERE {scope}) b
    ON b.variable = i.variable AND b.bin_order = i.bin_order
  GROUP BY i.variable, i.bin_order, i.low, i.high
)
"""


def measures_sql(source: str) -> str:
    """Shares, running sums and information value from per-bin counts."""
    return f"""
shares AS (
  SELECT *, count - bad AS good,
         count / nullif(sum(count) OVER v, 0) AS total_ratio, bad / nullif(count, 0) AS bad_rate,
         bad / nullif(sum(bad) OVER v, 0) AS bad_ratio,
         (count - bad) / nullif(sum(count - bad) OVER v, 0) AS good_ratio,
         CAST(sum(bad) OVER u AS BIGINT) AS cumulative_bad,
         CAST(sum(count - bad) OVER u AS BIGINT) AS cumulative_good,
         sum(bad) OVER u / nullif(sum(bad) OVER v, 0) AS cumulative_bad_ratio,
         sum(count - bad) OVER u / nullif(sum(count - bad) OVER v, 0) AS cumulative_good_ratio
  FROM {source}
  WINDOW v AS (PARTITION BY variable), u AS (PARTITION BY variable ORDER BY bin_order)
),
terms AS (
  SELECT *, CASE WHEN good > 0 AND bad > 0 THEN (good_ratio - bad_ratio) * ln(good_ratio / bad_ratio) ELSE 0 END AS iv_1
  FROM shares
),
summary AS (SELECT *, sum(iv_1) OVER (PARTITION BY variable) AS iv FROM terms)
"""


SUMMARY_SELECT = """
SELECT variable, bin, CAST(bin_order AS INTEGER) AS bin_order, bin_class, count, bad, good,
       cumulative_bad, cumulative_good, round(total_ratio, 6) AS total_ratio, round(bad_rate, 6) AS bad_rate,
       round(bad_ratio, 6) AS bad_ratio, round(good_ratio, 6) AS good_ratio,
       round(cumulative_bad_ratio, 6) AS cumulative_bad_ratio,
       round(cumulative_good_ratio, 6) AS cumulative_good_ratio, round(iv_1, 6) AS iv_1, round(iv, 6) AS iv
FROM summary
"""

PSI_BINS = """
bin_totals AS (
  SELECT data_type, variable, CAST(bin_order AS VARCHAR) AS bin, count(*) AS n FROM binned GROUP BY 1, 2, 3
  UNION ALL SELECT data_type, variable, bin, count(*) FROM levels GROUP BY 1, 2, 3
),
bin_shares AS (
  SELECT data_type, variable, bin, n / sum(n) OVER (PARTITION BY data_type, variable) AS share FROM bin_totals
),
psi_bins AS (
  SELECT a.variable, a.bin, a.share AS total_ratio_train, coalesce(b.share, 0) AS total_ratio_test,
         coalesce((a.share - b.share) * ln(a.share / b.share), 0) AS psi
  FROM (SELECT * FROM bin_shares WHERE data_type = 'TRAIN') a
  LEFT JOIN (SELECT * FROM bin_shares WHERE data_type = 'TEST') b ON a.variable = b.variable AND a.bin = b.bin
)
"""


def profile_sql(scope: str = "TRUE", edges_from: str = "TRUE") -> str:
    """All profile relations: numbers, edges, bins, summary and PSI."""
    parts = [
        SNAPSHOT, NUMBERS, edges_sql(edges_from), BINNED, TEXT_BINS.format(scope=scope),
        NUMBER_BINS.format(scope=scope),
        "all_bins AS (SELECT * FROM number_bins UNION ALL BY NAME SELECT * FROM text_bins)",
        measures_sql("all_bins"), PSI_BINS,
    ]
    return "WITH " + ",".join(parts)
