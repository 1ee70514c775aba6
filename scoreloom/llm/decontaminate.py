"""Benchmark decontamination: documents that share an item's rarer shingles, exact similarity of all windows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.workspace import stored
from .graph import sized
from .text import SHINGLE, packed, shingle_hashes, unpacked, word_hashes

THRESHOLD = 0.8
ANCHOR_ROWS = 1_000_000  # most item shingles that a pass broadcasts; more items take more passes


def item_shingles(benchmark: DataFrame) -> DataFrame:
    """item_id, part (tells apart texts of equal item_id), shingles and their number n; items are taken whole.

    Items of fewer than five words have no shingle and are left out; a null text is empty.
    """
    return (
        benchmark.select("item_id", shingle_hashes(word_hashes(F.col("text"))).alias("shingles"))
        .select("item_id", F.xxhash64("shingles").alias("part"), "shingles", F.size("shingles").alias("n"))
        .where("n > 0").dropDuplicates(["item_id", "part"])
    )


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Passages of benchmark items in documents: doc_id, item_id, similarity, start, n_words.

    A document leaks an item if a window of the item's length has, counting five-word shingles, a
    weighted Jaccard similarity of ``threshold`` or more with it; a document shorter than the item is one
    window. At similarity t a window shares at least nt of the item's n shingles, so it holds one of any
    n - nt + 1 of them: documents that hold one of an item's rarest are candidates, and all windows of a
    candidate are compared exactly. The best window of a document and an item, the first of equals, is
    returned.

    Null texts are empty; items of under five words match nothing; repeated items count once each by
    item_id, rows with equal doc_id are taken together; empty tables give no rows; further columns are
    ignored. Texts are processed whole.
    """
    items = stored(item_shingles(benchmark), "leak_items")
    wanted = stored(_wanted(items, threshold), "leak_shingles")
    shared = wanted.count()
    passes = max(1, -(-shared // ANCHOR_ROWS))
    found = []
    for k in range(passes):
        mine = wanted.where(F.pmod(F.xxhash64("item_id", "part"), F.lit(passes)) == k)
        candidates = stored(_candidates(docs, mine.where("rare")), "leak_candidates")
        found.append(_best(_positions(docs, candidates, mine), threshold))
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), "n_words")).alias("best")
    return reduce(DataFrame.unionAll, found).groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", F.col("best.similarity").alias("similarity"),
        (-F.col("best.before")).cast("bigint").alias("start"), F.col("best.n_words").cast("bigint").alias("n_words"),
    )


def _row() -> Column:
    """Tells apart the texts of equal doc_id."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def _wanted(items: DataFrame, threshold: float) -> DataFrame:
    """item_id, part, n, each shingle with its count ``times``, and whether it is one of the item's rarest.

    The rarest are n - nt + 1 places of the item, so that no window of the similarity holds none of them.
    """
    each = items.select("item_id", "part", "n", F.explode("shingles").alias("shingle")).groupBy(
        "item_id", "part", "n", "shingle").agg(F.count(F.lit(1)).cast("int").alias("times"))
    used = stored(each, "leak_each")
    items_of = used.groupBy("shingle").agg(F.count(F.lit(1)).alias("n_items"))
    order = Window.partitionBy("item_id", "part").orderBy("n_items", "shingle")
    before = F.sum("times").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("times")
    places = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    return used.join(items_of, "shingle").withColumn("rare", before < places).drop("n_items")


def _candidates(docs: DataFrame, rare: DataFrame) -> DataFrame:
    """doc_id, row, item_id, part of the documents that hold a rare shingle of an item."""
    # The outer form keeps Spark from filtering on the array first, which would compute it twice.
    return (
        docs.select("doc_id", _row().alias("row"),
                    F.explode_outer(F.array_distinct(shingle_hashes(word_hashes(F.col("text"))))).alias("shingle"))
        .join(F.broadcast(rare.select("shingle", "item_id", "part")), "shingle")
        .select("doc_id", "row", "item_id", "part").distinct()
    )


def _positions(docs: DataFrame, candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingles that a candidate shares with its item: where they stand (ats, in order) and their count in the item.

    Only candidates' texts are read beyond the join.
    """
    named = candidates.groupBy("doc_id", "row").agg(F.collect_list(F.struct("item_id", "part")).alias("of"))
    named = sized(stored(named.select(F.col("doc_id").alias("id"), F.col("row").alias("named"), "of"), "leak_named"))
    holders = wanted.groupBy("shingle").agg(F.collect_list(F.struct("item_id", "part", "n", "times")).alias("items"))
    own = F.filter("items", lambda i: F.array_contains("of", F.struct(i["item_id"], i["part"])))
    whole = ["doc_id", "row", "item_id", "part", "n", "count"]
    return (
        docs.select("doc_id", "text", _row().alias("row"))
        .join(named, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("named")))
        .select("doc_id", "row", "of", shingle_hashes(word_hashes(F.col("text"))).alias("shingles"))
        .select("doc_id", "row", "of", F.size("shingles").alias("count"), F.posexplode_outer("shingles").alias("at", "shingle"))
        .join(F.broadcast(holders), "shingle")
        .select("doc_id", "row", "count", "shingle", "at", F.explode(own).alias("i"))
        .select("doc_id", "row", "i.item_id", "i.part", "i.n", "count", "shingle", "i.times", "at")
        .groupBy(*whole, "shingle", "times").agg(F.array_sort(F.collect_set("at")).alias("ats"))
    )


def _best(positions: DataFrame, threshold: float) -> DataFrame:
    """The best window of each document, item and part, if it reaches the threshold.

    With a shingle of count c in the item, a place of it adds one to the windows that hold it and fewer
    than c of its places before; these begin in one range. Adding up the ranges' ends gives the common
    shingles of all windows, and the most begin where a range does.
    """
    last = F.greatest(F.lit(0), F.col("count") - F.col("n"))
    ends = F.transform("ats", lambda at, i: F.struct(
        F.greatest(F.lit(0), at - F.col("n") + 1, F.when(i >= F.col("times"), F.get("ats", i - F.col("times")) + 1)).alias("low"),
        (F.least(at, last) + 1).alias("beyond")))
    whole = ["doc_id", "row", "item_id", "part", "n", "count"]
    ranges = positions.select(*whole, F.explode(F.filter(ends, lambda e: e["low"] < e["beyond"])).alias("e"))
    steps = ranges.select(*whole, F.explode(F.array(
        F.struct(F.col("e.low").alias("start"), F.lit(1).alias("step")),
        F.struct(F.col("e.beyond").alias("start"), F.lit(-1).alias("step")))).alias("s")).groupBy(
        *whole, F.col("s.start").alias("start")).agg(F.sum("s.step").alias("step"))
    order = Window.partitionBy("doc_id", "row", "item_id", "part").orderBy("start").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    length = F.least("n", "count")
    return (
        steps.withColumn("common", F.sum("step").over(order))
        .withColumn("similarity", F.col("common") / (F.col("n") + length - F.col("common")))
        .where(F.col("similarity") >= threshold)
        .select("doc_id", "item_id", "similarity", "start", (length + SHINGLE - 1).alias("n_words"))
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that leak no benchmark item, with all their columns."""
    found = stored(leaks(docs, benchmark, threshold).select(F.col("doc_id").alias("leaked")).distinct(), "leaked")
    left = packed(docs, "doc_id").join(sized(found), F.col("doc_id").eqNullSafe(F.col("leaked")), "left_anti")
    return unpacked(left, docs)
