"""Snapshots and scored rows derived from the order, customer and line-item tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The periods and months of the three snapshots.
PERIODS = {
    "TRAIN": ("1999-01-01", "2000-01-01", "199912"),
    "TEST": ("2000-01-01", "2001-01-01", "200012"),
    "SCORE": ("2001-01-01", "2001-08-01", "200107"),
}
HIGH_PRICE = 502365
FEATURES = (
    "acctbal", "is_overdrawn", "segment", "region_key", "n_orders", "total_price",
    "n_urgent", "max_price", "pending_price", "urgent_status",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def snapshots(spark: SparkSession, folder: str, data_types=("TRAIN", "TEST")) -> DataFrame:
    """One row per customer with an order in the period, for each data type, from one scan."""
    day = F.col("o_orderdate")
    bounds = [PERIODS[t] for t in data_types]
    inside = None
    data_type = F.lit(None).cast("string")
    month = F.lit(None).cast("string")
    for tag, (start, end, ym) in zip(data_types, bounds):
        period = (day >= F.lit(start).cast("timestamp_ntz")) & (day < F.lit(end).cast("timestamp_ntz"))
        inside = period if inside is None else inside | period
        data_type = F.when(period, F.lit(tag)).otherwise(data_type)
        month = F.when(F.col("data_type") == tag, F.lit(ym)).otherwise(month)

    urgent = F.col("o_orderpriority") == "1-URGENT"
    price = F.col("o_totalprice")
    per_customer = (
        table(spark, folder, "orders")
        .where(inside)
        .groupBy(data_type.alias("data_type"), F.col("o_custkey").alias("customer_id"))
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.round(F.sum(price), 2).alias("total_price"),
            F.count_if(urgent).alias("n_urgent"),
            F.max(price).alias("max_price"),
            F.max(F.when(F.col("o_orderstatus") == "P", price)).alias("pending_price"),
            F.max(F.when(urgent, F.col("o_orderstatus"))).alias("urgent_status"),
        )
    )
    customers = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    joined = per_customer.join(customers, F.col("customer_id") == F.col("c_custkey")).withColumn("base_ym", month)
    return joined.select(
        "data_type", "base_ym", "customer_id",
        F.md5(F.col("c_custkey").cast("string")).alias("customer_hash"),
        F.col("c_acctbal").alias("acctbal"),
        (F.col("c_acctbal") < 0).alias("is_overdrawn"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_regionkey").alias("region_key"),
        "n_orders", "total_price", "n_urgent", "max_price", "pending_price", "urgent_status",
        _response().alias("PERF"),
    )


def _response() -> Column:
    """0/1 target: hash noise around a dependence on price and segment."""
    noise = F.md5(F.concat(F.lit("s:"), F.col("data_type"), F.lit(":"), F.col("customer_id").cast("string")))
    limit = (
        F.when(F.col("total_price") > HIGH_PRICE, "a0000000")
        .when(F.col("c_mktsegment") == "BUILDING", "60000000")
        .otherwise("30000000")
    )
    return (noise < limit).cast("int")


def snapshot(spark: SparkSession, folder: str, data_type: str) -> DataFrame:
    """One snapshot as a model user sees it: without ``data_type``, and unlabelled for SCORE."""
    df = snapshots(spark, folder, (data_type,)).drop("data_type")
    return df.drop("PERF") if data_type == "SCORE" else df


def scored_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a deterministic probability that reaches 0, 1 and every band edge."""
    p = ((F.col("l_orderkey") * 7 + F.col("l_linenumber") * 13) % 1001).cast("double") / 1000
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        p.alias("probability"),
        (F.col("l_returnflag") == "R").cast("int").alias("PERF"),
        F.when(F.col("l_linestatus") == "O", "val").otherwise("test").alias("split"),
        "l_returnflag",
    )
