"""Sources, sinks, validation, preparation and sample building."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import DEFAULT_SPEC
from ..functions import expressions as fx
from ..functions.names import with_ascii_names
from ..operators import prepare, sample, validate
from ..operators.prepare import FeatureEncoder
from ..sources import snapshots as io, tables
from ..sources.workspace import fresh_path
from .base import SNAPSHOT, both, one_hot_sql, query, stored_both

W = f"WITH {SNAPSHOT}"
KEYS = "base_ym, customer_id, customer_hash"


# -- sources and sinks ------------------------------------------------------------------------


@query("snapshot", f"{W} SELECT * FROM snap")
def snapshot(spark, folder):
    return tables.snapshots(spark, folder)


@query("src_csv_roundtrip", f"{W} SELECT * FROM train")
def src_csv_roundtrip(spark, folder):
    train = tables.snapshot(spark, folder, "TRAIN")
    path = io.write_labelled(train, fresh_path(spark, "csv"), "199912")
    return io.read_snapshot(spark, path, train.schema)


@query("src_score_snapshot", f"{W} SELECT * EXCLUDE (PERF) FROM test")
def src_score_snapshot(spark, folder):
    test = tables.snapshot(spark, folder, "TEST")
    path = io.write_unlabelled(test, fresh_path(spark, "csv"), "200012")
    return io.read_snapshot(spark, path, test.drop("PERF").schema)


@query("src_month_partition", f"{W} SELECT * EXCLUDE (data_type) FROM snap WHERE base_ym = '200012'")
def src_month_partition(spark, folder):
    path = io.write_by_month(tables.snapshots(spark, folder).drop("data_type"), fresh_path(spark, "months"))
    return io.read_month(spark, path, "200012")


# -- validation -------------------------------------------------------------------------------

VALIDATE_COLUMNS = f"""{W}
SELECT 'train' AS snapshot, count(*) AS n_rows, TRUE AS has_keys, TRUE AS has_target FROM train
UNION ALL SELECT 'test', count(*), TRUE, TRUE FROM test
UNION ALL SELECT 'score', count(*), TRUE, FALSE FROM score
UNION ALL SELECT 'customer', count(*), FALSE, FALSE FROM customer
"""


@query("validate_columns", VALIDATE_COLUMNS)
def validate_columns(spark, folder):
    frames = {
        **{t.lower(): tables.snapshot(spark, folder, t) for t in ("TRAIN", "TEST", "SCORE")},
        "customer": tables.table(spark, folder, "customer"),
    }
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("snapshot"), "n_rows",
                F.lit(validate.has_columns(df, DEFAULT_SPEC.keys)).alias("has_keys"),
                F.lit(validate.has_columns(df, [DEFAULT_SPEC.target])).alias("has_target"),
            )
            for name, df in frames.items()
        ]
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    result = frames[0]
    for df in frames[1:]:
        result = result.unionByName(df)
    return result


CHECKED = ("base_ym", "customer_id", "customer_hash", "PERF", "segment", "pending_price", "urgent_status")


@query(
    "validate_nulls",
    f"{W} SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in CHECKED) + " FROM snap",
)
def validate_nulls(spark, folder):
    return validate.null_counts(tables.snapshots(spark, folder), CHECKED)


@query(
    "validate_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def validate_duplicates(spark, folder):
    return validate.duplicate_keys(tables.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def _broken_snapshots(spark, folder) -> dict[str, DataFrame]:
    """The training snapshot, and one table per rule it can break."""
    train = tables.snapshot(spark, folder, "TRAIN")
    orders = tables.table(spark, folder, "orders").select(
        F.lit("199912").alias("base_ym"), F.col("o_custkey").alias("customer_id"),
        F.md5(F.col("o_custkey").cast("string")).alias("customer_hash"),
        (F.col("o_orderstatus") == "F").cast("int").alias("PERF"),
    )
    return {
        "complete": train,
        "no_hash": train.drop("customer_hash"),
        "null_hash": train.withColumn("customer_hash", F.col("urgent_status")),
        "repeated": orders,
        "unlabelled": train.drop("PERF"),
        "null_target": train.withColumn("PERF", F.when(F.col("pending_price").isNotNull(), F.col("PERF"))),
    }


def _validation_sql(scoring: bool) -> str:
    flags = "customer_id, customer_hash IS NULL AS null_key, PERF IS NULL AS null_target"
    frames = f"""
frames AS (
  SELECT 'complete' AS snapshot, TRUE AS has_keys, TRUE AS has_target, {flags} FROM train
  UNION ALL SELECT 'no_hash', FALSE, TRUE, {flags} FROM train
  UNION ALL SELECT 'null_hash', TRUE, TRUE, customer_id, urgent_status IS NULL, FALSE FROM train
  UNION ALL SELECT 'repeated', TRUE, TRUE, o_custkey, FALSE, FALSE FROM orders
  UNION ALL SELECT 'unlabelled', TRUE, FALSE, customer_id, FALSE, FALSE FROM train
  UNION ALL SELECT 'null_target', TRUE, TRUE, customer_id, FALSE, pending_price IS NULL FROM train
),
facts AS (
  SELECT snapshot, bool_and(has_keys) AS has_keys, bool_and(has_target) AS has_target, bool_or(null_key) AS null_key,
         count(*) > count(DISTINCT customer_id) AS repeated, bool_or(null_target) AS null_target
  FROM frames GROUP BY snapshot
)"""
    last = (
        "WHEN has_target THEN 'Target data (''PERF'') should be removed.'" if scoring else
        "WHEN NOT has_target THEN 'No target data (''PERF'') found.' "
        "WHEN null_target THEN 'Target data (''PERF'') contains NULL.'"
    )
    return f"""{W}, {frames},
told AS (
  SELECT snapshot, CASE WHEN NOT has_keys THEN 'Missing key values.' WHEN null_key THEN 'Key values contain NULL.'
         WHEN repeated THEN 'Duplicate values found in ''customer_id''.' {last} ELSE 'Data is valid.' END AS message
  FROM facts
)
SELECT snapshot, message = 'Data is valid.' AS ok, message FROM told"""


@query("validate_modeling", _validation_sql(scoring=False))
def validate_modeling(spark, folder):
    return validate.validate_all(_broken_snapshots(spark, folder), scoring=())


@query("validate_score", _validation_sql(scoring=True))
def validate_score(spark, folder):
    frames = _broken_snapshots(spark, folder)
    return validate.validate_all(frames, scoring=list(frames))


VALIDATE_SCHEMA = f"""{W}
SELECT 'same' AS pair, count(*) AS n_rows, TRUE AS ok, 'Data is valid.' AS message FROM train
UNION ALL SELECT 'reordered', count(*), FALSE, 'Dataset mismatch.' FROM train
UNION ALL SELECT 'without_target', count(*), FALSE, 'Check target column.' FROM train
"""


@query("validate_schema_match", VALIDATE_SCHEMA)
def validate_schema_match(spark, folder):
    train, test = both(spark, folder)
    pairs = {
        "same": test,
        "reordered": test.select(*reversed(test.columns)),
        "without_target": tables.snapshot(spark, folder, "SCORE"),
    }
    parts = []
    for name, other in pairs.items():
        ok, message = validate.schema_match(train, other)
        parts.append(
            train.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(name).alias("pair"), "n_rows", F.lit(ok).alias("ok"), F.lit(message).alias("message")
            )
        )
    return _union(parts)


VALIDATE_MONTHS = f"""{W},
facts AS (
  SELECT data_type, base_ym, count(*) > count(DISTINCT customer_id) AS repeated,
         bool_or(customer_id IS NULL OR customer_hash IS NULL) AS null_key, bool_or(PERF IS NULL) AS null_target
  FROM all_snapshots GROUP BY 1, 2
)
SELECT CASE WHEN data_type = 'SCORE' THEN 'sample_score_data_' ELSE 'sample_data_' END || base_ym AS snapshot,
       NOT (null_key OR repeated OR null_target) AS ok,
       CASE WHEN null_key THEN 'Key values contain NULL.'
            WHEN repeated THEN 'Duplicate values found in ''customer_id''.'
            WHEN null_target THEN 'Target data (''PERF'') contains NULL.' ELSE 'Data is valid.' END AS message
FROM facts
"""


@query("validate_all_months", VALIDATE_MONTHS)
def validate_all_months(spark, folder):
    names = {"TRAIN": "sample_data_199912", "TEST": "sample_data_200012", "SCORE": "sample_score_data_200107"}
    return validate.validate_all({names[t]: tables.snapshot(spark, folder, t) for t in names})


@query(
    "validate_every_month",
    """
WITH rows AS (
  SELECT strftime(o_orderdate, '%Y%m') AS snapshot, o_custkey AS customer,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 1 END AS target FROM orders
), per_customer AS (
  SELECT snapshot, customer, count(*) AS n, max(CASE WHEN target IS NULL THEN 1 ELSE 0 END) AS missing FROM rows GROUP BY 1, 2
), per_month AS (SELECT snapshot, max(n) AS n, max(missing) AS missing FROM per_customer GROUP BY 1)
SELECT snapshot, n = 1 AND missing = 0 AS ok,
       CASE WHEN n > 1 THEN 'Duplicate values found in ''customer_id''.'
            WHEN missing = 1 THEN 'Target data (''PERF'') contains NULL.' ELSE 'Data is valid.' END AS message
FROM per_month""",
)
def validate_every_month(spark, folder):
    """Every month of all orders as a snapshot, checked in one scan; most months have customers with two orders."""
    rows = tables.table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("base_ym"), F.col("o_custkey").alias("customer_id"),
        F.md5(F.col("o_custkey").cast("string")).alias("customer_hash"),
        F.when(F.col("o_orderstatus") != "P", 1).alias("PERF"),
    )
    return validate.validate_by_month(rows)


# -- preparation ------------------------------------------------------------------------------


@query("prep_project", f"{W} SELECT total_price, segment, n_orders FROM train")
def prep_project(spark, folder):
    train = tables.snapshot(spark, folder, "TRAIN").drop(*DEFAULT_SPEC.keys).drop("PERF")
    return prepare.align(train, ["total_price", "segment", "n_orders"])


@query(
    "prep_fillna",
    f"{W} SELECT * REPLACE (coalesce(pending_price, 0) AS pending_price, "
    "coalesce(urgent_status, '0') AS urgent_status) FROM train",
)
def prep_fillna(spark, folder):
    return prepare.fill_missing(tables.snapshot(spark, folder, "TRAIN"), exclude=DEFAULT_SPEC.keys)


@query("prep_one_hot", f"{W} {one_hot_sql(KEYS + ', PERF', 'train')}")
def prep_one_hot(spark, folder):
    return prepare.one_hot(tables.snapshot(spark, folder, "TRAIN"))


@query(
    "prep_ascii_names",
    f"{W} SELECT base_ym AS magamnyeonweol, customer_id AS \"gyeyagjagogaegID\", segment AS segment_cafe, "
    "total_price FROM train",
)
def prep_ascii_names(spark, folder):
    named = tables.snapshot(spark, folder, "TRAIN").select(
        F.col("base_ym").alias("마감년월"), F.col("customer_id").alias("계약자고객ID"),
        F.col("segment").alias("segment_café"), "total_price",
    )
    return with_ascii_names(named)


@query(
    "prep_keep_raw",
    f"{W} SELECT {KEYS}, PERF, total_price, "
    + ", ".join(
        f"CASE WHEN segment = '{v}' THEN 1 ELSE 0 END AS segment_{v}"
        for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
    )
    + " FROM train",
)
def prep_keep_raw(spark, folder):
    return prepare.one_hot(tables.snapshot(spark, folder, "TRAIN"), keep=["segment", "total_price"])


@query(
    "prep_keep_encoded",
    f"{W} SELECT {KEYS}, PERF, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS \"segment_BUILDING\", total_price, "
    "CASE WHEN urgent_status IS NULL THEN 1 ELSE 0 END AS urgent_status_0, 0 AS \"segment_UNSEEN\" FROM train",
)
def prep_keep_encoded(spark, folder):
    keep = ["segment_BUILDING", "total_price", "urgent_status_0", "segment_UNSEEN"]
    return prepare.one_hot(tables.snapshot(spark, folder, "TRAIN"), keep=keep)


@query(
    "prep_split",
    f"{W} SELECT {KEYS}, CASE WHEN md5(concat('42:', CAST(customer_id AS VARCHAR))) < '4ccccccd' "
    "THEN 'val' ELSE 'train' END AS split FROM train",
)
def prep_split(spark, folder):
    return tables.snapshot(spark, folder, "TRAIN").select(
        *DEFAULT_SPEC.keys, F.when(prepare.is_validation(), "val").otherwise("train").alias("split")
    )


@query(
    "prep_split_exact",
    f"{W} SELECT {KEYS}, CASE WHEN row_number() OVER (ORDER BY md5(concat('42:', CAST(customer_id AS VARCHAR))), "
    "customer_id) <= ceil(0.3 * (SELECT count(*) FROM train)) THEN 'val' ELSE 'train' END AS split FROM train",
)
def prep_split_exact(spark, folder):
    return prepare.split_exact(tables.snapshot(spark, folder, "TRAIN")).select(*DEFAULT_SPEC.keys, "split")


@query(
    "prep_common_features",
    f"{W}, pair AS (SELECT 'train' AS part, * FROM train UNION ALL SELECT 'test', * FROM "
    "(SELECT * REPLACE (nullif(segment, 'MACHINERY') AS segment) FROM test)) SELECT * EXCLUDE (\"segment_MACHINERY\") FROM ("
    + one_hot_sql("part, customer_id", "pair") + ")",
)
def prep_common_features(spark, folder):
    train, test = stored_both(spark, folder)
    test = test.withColumn("segment", F.nullif("segment", F.lit("MACHINERY")))
    left, right = prepare.one_hot(train), prepare.one_hot(test)
    carried = (*DEFAULT_SPEC.keys, "PERF")
    names = prepare.common_features(
        [n for n in left.columns if n not in carried], [n for n in right.columns if n not in carried]
    )
    return _union(
        [
            prepare.align(df.withColumn("part", F.lit(part)), names, carry=["part", "customer_id"])
            for part, df in (("train", left), ("test", right))
        ]
    )


PREP_DEV = f"""{W}, tagged AS (
  SELECT *, CASE WHEN data_type = 'TEST' THEN 'test'
                 WHEN md5(concat('42:', CAST(customer_id AS VARCHAR))) < '4ccccccd' THEN 'val' ELSE 'train' END AS split
  FROM snap)
{one_hot_sql(KEYS + ', PERF, split', 'tagged')}"""


@query("prep_dev", PREP_DEV)
def prep_dev(spark, folder):
    return prepare.prepare(*stored_both(spark, folder)).data


@query("prep_scoring", f"{W} {one_hot_sql(KEYS, 'score')}")
def prep_scoring(spark, folder):
    encoder = FeatureEncoder.fit(tables.snapshot(spark, folder, "TRAIN"))
    return encoder.transform(tables.snapshot(spark, folder, "SCORE"))


@query(
    "score_align",
    f"{W} SELECT {KEYS}, CASE WHEN segment = 'BUILDING' THEN 1 ELSE 0 END AS \"segment_BUILDING\", "
    "0 AS \"segment_UNSEEN\", total_price, 0 AS never_seen FROM score",
)
def score_align(spark, folder):
    encoded = prepare.one_hot(tables.snapshot(spark, folder, "SCORE"))
    return prepare.align(
        encoded, ["segment_BUILDING", "segment_UNSEEN", "total_price", "never_seen"], carry=DEFAULT_SPEC.keys
    )


@query("prep_rename_prefix", f"{W} SELECT customer_id AS general_id, total_price AS general_price, PERF AS general_bad FROM train")
def prep_rename_prefix(spark, folder):
    chosen = tables.snapshot(spark, folder, "TRAIN").select("customer_id", "total_price", "PERF")
    renamed = fx.rename_columns(chosen, ["id", "price", "PERF"]).withColumnRenamed("PERF", "bad")
    return fx.prefix_columns(renamed, "general_")


@query("filter_positive", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def filter_positive(spark, folder):
    return sample.keep_positive(tables.table(spark, folder, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


# -- sample building --------------------------------------------------------------------------


@query(
    "gen_snapshot_keys",
    "SELECT '200107' AS base_ym, c_custkey AS customer_id, "
    "substr(md5(concat('1:', CAST(c_custkey AS VARCHAR))), 1, 10) AS customer_hash FROM customer",
)
def gen_snapshot_keys(spark, folder):
    return sample.key_table_of(tables.table(spark, folder, "customer"), "c_custkey", "200107")


SAMPLE_SIZE = 500
ORDER_FEATURES = "o_orderkey, o_custkey, o_totalprice AS amount, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS PERF"


def _order_features(spark, folder, n):
    orders = tables.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
        (F.col("o_orderstatus") == "F").cast("int").alias("finished"),
    )
    renames = {"finished": "PERF", "o_totalprice": "amount"}
    return sample.feature_source(orders, renames, ["o_orderstatus"], "amount", n, "o_orderkey")


@query(
    "gen_sample_n",
    f"SELECT {ORDER_FEATURES} FROM orders WHERE o_totalprice > 0 "
    f"ORDER BY md5(concat('1:', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT {SAMPLE_SIZE}",
)
def gen_sample_n(spark, folder):
    return _order_features(spark, folder, SAMPLE_SIZE)


@query(
    "gen_positional_join",
    f"""WITH keys AS (SELECT unnest(range(1, (SELECT count(*) FROM customer) + 1)) AS customer_id),
features AS (SELECT {ORDER_FEATURES} FROM orders WHERE o_totalprice > 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY md5(concat('1:', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS i
             FROM features)
SELECT '199912' AS base_ym, customer_id, substr(md5(concat('1:', CAST(customer_id AS VARCHAR))), 1, 10) AS customer_hash,
       o_orderkey, o_custkey, amount, PERF
FROM keys LEFT JOIN numbered ON customer_id = i""",
)
def gen_positional_join(spark, folder):
    n = tables.table(spark, folder, "customer").count()
    keys = sample.key_table(spark, n, "199912")
    features = sample.keep_positive(
        tables.table(spark, folder, "orders").select(
            "o_orderkey", "o_custkey", F.col("o_totalprice").alias("amount"),
            (F.col("o_orderstatus") == "F").cast("int").alias("PERF"),
        ),
        "amount",
    )
    return sample.positional_join(keys, features, "customer_id", "o_orderkey")
