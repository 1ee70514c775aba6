"""Mix sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.workspace import stored

# A word is a run of characters other than these; weights repeat in source order.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3

ROWS_PER_BUCKET = 4096
KEY_DIGITS = 13  # hexadecimal digits of a key that place it in a bucket: 52 bits, exact in a double


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Target words of each source.

    ``sizes`` has one row per source: ``source``, ``source_size``. Sources by code point, null last,
    take the weights in turn and share the sum of all sizes; no target is above ``most_epochs``
    times its source, and what that leaves over goes to the others by weight. With sources ordered
    by the level at which they are full, the sources below the common level are full and the others
    get weight times level, so the level follows from two running sums over the sources.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    most = (F.col("source_size") * most_epochs).cast("double")
    ranked = (
        sizes.withColumn("rank", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1)))
        .withColumn("most", most)
        .withColumn("full_at", F.col("most") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every).cast("double"))
    )
    levels = (
        ranked.withColumn(
            "full_before",
            F.coalesce(F.sum("most").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        )
        .withColumn("weight_left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("full_before")) / F.col("weight_left"))
        .withColumn("level", F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(every))
    )
    target = F.least(F.col("weight") * F.col("level"), F.col("most"))
    return levels.select("source", "source_size", "weight", target.alias("target"))


def _key(seed: str) -> Column:
    """Hash-random order: MD5 of seed and doc_id, or text where there is no doc_id."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    return F.md5(F.concat(F.lit(f"{seed}:"), own))


def mix(docs: DataFrame, weights=WEIGHTS, seed: str = "mix", most_epochs: int = MOST_EPOCHS, carry: bool = False) -> DataFrame:
    """Words that the mix takes of every document.

    Returns doc_id, source, size, source_size, target, taken. A source's budget is its target,
    rounded; whole epochs of the source come first, and what is left is cut from the documents in
    the order of their keys, the last of them in part, so the words taken add up to the budget.
    Keys are MD5 of seed and doc_id, equal for each run. Sources are split into ranges of keys of
    about ``ROWS_PER_BUCKET`` rows; sums of ranges tell the range each source is cut in, and only the
    sizes of its rows are put in order. What a row is taken follows from the document its source is
    cut at, so texts and further columns are not shuffled.

    A null text is empty (size 0, taken 0); rows with a null doc_id are ordered by their text;
    repeated rows count each; a null source is a source; an empty table gives no rows; further
    columns of ``docs`` are ignored, or come along as the struct ``row`` with ``carry``.
    """
    narrow = ["doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")]
    sized = stored(docs.select(*narrow), "mix_sizes")
    cuts = _cuts(sized, weights, most_epochs)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # No hint: the cuts are one stored row per source, so Spark knows their size and broadcasts few.
    joined = (docs.select(*narrow, row) if carry else sized).join(cuts, F.col("source").eqNullSafe(F.col("cut_source")))

    mine, cut = F.struct("key", "doc_id", "size"), F.struct("cut_key", "cut_id", "cut_size")
    tied = mine.eqNullSafe(cut) & (F.col("copies") > 1)
    whole = F.when(mine < cut, F.col("size")).when(mine.eqNullSafe(cut), F.col("room")).otherwise(F.lit(0))
    if cuts.where(F.col("copies") > 1).isEmpty():
        parts = joined.withColumn("part", whole)
    else:
        content = F.md5(F.to_json("row")) if carry else F.col("key")
        nth = F.row_number().over(Window.partitionBy("cut_source").orderBy(content)) - 1
        left = F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - nth * F.col("size")))
        tied = F.coalesce(tied, F.lit(False))
        parts = joined.where(~tied).withColumn("part", whole).unionByName(joined.where(tied).withColumn("part", left))
    return parts.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("bigint").alias("taken"), *(["row"] if carry else []),
    )


def _cuts(sized: DataFrame, weights, most_epochs: int) -> DataFrame:
    """Per source its size, target and whole epochs, and the document that the rest of its budget ends in.

    Documents before that one, by key, doc_id and size, are in the rest as a whole, those after it not at all, and
    ``room`` words are left for it and the rows equal to it (``copies`` in all). A source without words has none.
    """
    buckets = max(1, -(-sized.count() // ROWS_PER_BUCKET))
    place = F.conv(F.substring("key", 1, KEY_DIGITS), 16, 10).cast("double") / float(16**KEY_DIGITS)
    placed = sized.withColumn("bucket", F.floor(place * buckets))

    totals = stored(placed.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix_totals")
    targets = source_targets(
        totals.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, most_epochs
    ).withColumn("budget", F.floor(F.col("target") + 0.5))
    size = F.col("source_size")
    targets = targets.withColumn(
        "epochs", F.when(size > 0, F.expr("budget div source_size")).otherwise(F.lit(0)).cast("bigint")
    ).withColumn("rest", F.col("budget") - F.col("epochs") * size)
    running = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("bucket_start", F.coalesce(F.sum("bucket_size").over(running), F.lit(0)))
    room = F.col("rest") - F.col("bucket_start")
    ends = (
        starts.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .where((room >= 0) & (room < F.col("bucket_size")))
        .select(F.col("s.source").alias("end_source"), F.col("bucket").alias("end_bucket"), room.alias("end_room"))
    )

    # Equal rows are one row here, so that copies of a document make no group large.
    ordered = (
        placed.join(ends, F.col("source").eqNullSafe(F.col("end_source")) & (F.col("bucket") == F.col("end_bucket")))
        .groupBy("end_source", "end_room", "key", "doc_id", "size").agg(F.count(F.lit(1)).alias("copies"))
    )
    inside = Window.partitionBy("end_source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    words = F.col("copies") * F.col("size")
    room = F.col("end_room") - F.coalesce(F.sum(words).over(inside), F.lit(0))
    last = ordered.withColumn("words", words).withColumn("room", room).where((F.col("room") >= 0) & (F.col("room") < F.col("words")))
    found = targets.join(last, F.col("source").eqNullSafe(F.col("end_source")), "left")
    return stored(found.select(
        F.col("source").alias("cut_source"), "source_size", "target", "epochs",
        F.col("key").alias("cut_key"), F.col("doc_id").alias("cut_id"), F.col("size").alias("cut_size"), "copies", "room",
    ), "mix_cuts")


def mixed(docs: DataFrame, weights=WEIGHTS, seed: str = "mix") -> DataFrame:
    """The documents that the mix takes words of, with all their columns, and words, target and taken.

    ``words`` is a document's size, ``taken`` the words the mix takes of it, up to three times its size.
    Columns that have these names already are replaced.
    """
    found = mix(docs, weights, seed, carry=True).where(F.col("taken") > 0)
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in ("words", "target", "taken")]
    return found.select(*kept, F.col("size").alias("words"), "target", "taken")
