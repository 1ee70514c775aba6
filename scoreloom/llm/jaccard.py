"""Jaccard join on word shingles: a MinHash LSH forest and exact verification."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.workspace import stored
from .graph import components, sized
from .text import SHINGLE, packed, unpacked, words

THRESHOLD = 0.8
TARGET_RECALL = 0.9999
TREES, DEPTH = 32, 7  # tries, and the values of a label; a value has 16 bits
SEED = 7
CHUNK = 1_000_000  # shingles of a block of comparisons: what a task holds at a time, twice
TILE = 2_000_000  # cells of the matrix of common shingles that a task holds at a time

SIGNED = "doc_id bigint, key binary, n bigint, label binary"
CHECKED = "key binary, linked bigint, head binary"

_RANDOM = np.random.default_rng(SEED)
_FACTORS = (_RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_OFFSETS = _RANDOM.integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint64).astype(np.uint32)
_MIX = [int(x) | 1 for x in _RANDOM.integers(1 << 62, 1 << 63, SHINGLE + 1, dtype=np.uint64)]


def prefix_depth(threshold: float, target: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """The longest prefix at which pairs of the threshold's similarity meet with the target probability.

    Prefixes are shortened from the whole label on. A pair of similarity s shares the first d values of a
    label with probability s^d, so it meets in one of the tries with probability 1 - (1 - s^d)^trees.
    """
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < target:
        depth -= 1
    return depth


def shingles_of(hashes: np.ndarray) -> np.ndarray:
    """Distinct 64-bit shingles of a document's word hashes, sorted; a text below five words is one shingle."""
    w = hashes.view(np.uint64)
    if len(w) < SHINGLE:
        return np.frombuffer(hashlib.blake2b(w.tobytes(), digest_size=8).digest(), np.uint64) if len(w) else w
    total = np.zeros(len(w) - SHINGLE + 1, np.uint64)
    for k in range(SHINGLE):
        total += w[k: len(w) - SHINGLE + 1 + k] * np.uint64(_MIX[k])
        total ^= total >> np.uint64(29)
    total *= np.uint64(_MIX[SHINGLE])
    total ^= total >> np.uint64(32)
    return np.unique(total)


def _lists(batch: pa.RecordBatch, name: str) -> list[np.ndarray]:
    column = batch.column(name)
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash values of every set, 16 bits each."""
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(sets), TREES * DEPTH), np.uint16)
    for i in range(TREES * DEPTH):
        out[:, i] = np.minimum.reduceat(x * _FACTORS[i] + _OFFSETS[i], starts) >> np.uint32(16)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SIGNED.split(", ")]
    for batch in batches:
        lists = _lists(batch, "hashes")
        counts, labels = [], []
        group: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            nonlocal group, held
            if group:
                labels.extend(row.astype(">u2").tobytes() for row in _signatures(group))
            group, held = [], 0

        for w in lists:
            if not len(w):
                flush()
                counts.append(0), labels.append(None)
                continue
            s = shingles_of(w)
            counts.append(len(s))
            group.append(s)
            held += len(s)
            if held > 200_000:
                flush()
        flush()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("key"), pa.array(counts, pa.int64()), pa.array(labels, pa.binary())], names)


def keyed(docs: DataFrame) -> DataFrame:
    """Add _key, the digest of a text's words (null without words), and _hashes of the words."""
    listed = docs.withColumn("_words", words(F.col("text")))
    key = F.when(F.size("_words") > 0, F.unhex(F.md5(F.array_join("_words", " "))))
    return listed.withColumn("_key", key).withColumn(
        "_hashes", F.transform("_words", lambda w: F.xxhash64(w))).drop("_words")


def _signed(docs: DataFrame) -> DataFrame:
    """doc_id, key of the words, number of shingles and label of every document."""
    rows = keyed(docs.select(F.col("doc_id").cast("bigint"), "text"))
    return rows.select("doc_id", F.col("_key").alias("key"), F.col("_hashes").alias("hashes")).mapInArrow(_sign, SIGNED)


def candidate_groups(classes: DataFrame, depth: int) -> DataFrame:
    """(node, label): classes that share a prefix in some trie are in one group, others are left out.

    In a sorted trie the classes with a common prefix stand together; each is linked to one of them, never
    to all, so a prefix that very many share gives as many rows as classes.
    """
    prefixes = F.transform(
        F.sequence(F.lit(0), F.lit(TREES - 1)),
        lambda t: F.xxhash64(t, F.substring(F.col("label"), t * (2 * DEPTH) + 1, F.lit(2 * depth))),
    )
    spread = classes.select("node", F.explode(prefixes).alias("prefix"))
    heads = spread.groupBy("prefix").agg(F.min("node").alias("head"), F.max("node").alias("last")).where("head < last")
    edges = spread.join(heads.select("prefix", "head"), "prefix").select(F.col("node").alias("a"), F.col("head").alias("b"))
    return components(edges)


def _blocks(members: DataFrame) -> DataFrame:
    """The comparisons each member takes part in: block, side and whether the block has one side.

    A group of up to CHUNK shingles is one block. A larger one is cut by size class and hash: similar sets
    have sizes within the threshold, so only chunks of the same and of neighbouring classes meet, each pair
    of chunks in one block. No block depends on the size of its group.
    """
    size_class = F.floor(F.log(F.col("n").cast("double")) / math.log(1 / THRESHOLD)).cast("int")
    members = members.withColumn("size_class", size_class)
    per_class = members.groupBy("group", "size_class").agg(F.sum("n").alias("total"))
    totals = per_class.groupBy("group").agg(F.sum("total").alias("whole"))
    large = totals.where(F.col("whole") > CHUNK).select("group")
    cut = stored(
        per_class.join(large, "group").select("group", "size_class", F.ceil(F.col("total") / CHUNK).alias("m")), "cuts")
    around = (
        cut
        .join(cut.select("group", (F.col("size_class") - 1).alias("size_class"), F.col("m").alias("above")),
              ["group", "size_class"], "left")
        .join(cut.select("group", (F.col("size_class") + 1).alias("size_class"), F.col("m").alias("below")),
              ["group", "size_class"], "left")
        .na.fill(0)
    )
    c, i = F.col("size_class"), F.pmod(F.xxhash64("key"), F.col("m"))

    def to(count):
        return F.when(count > 0, F.sequence(F.lit(0).cast("bigint"), count - 1)).otherwise(F.array().cast("array<bigint>"))

    def part(c1, i1, c2, i2, side):
        return F.struct(F.xxhash64("group", c1, i1, c2, i2).alias("block"), F.lit(side).alias("side") if isinstance(side, int)
                        else side.alias("side"))

    same = F.transform(to(F.col("m")), lambda j: part(
        c, F.least(i, j), c, F.greatest(i, j), F.when(j == i, F.lit(2)).when(i < j, F.lit(0)).otherwise(F.lit(1))))
    above = F.transform(to(F.col("above")), lambda j: part(c, i, c + 1, j, 0))
    below = F.transform(to(F.col("below")), lambda j: part(c - 1, j, c, i, 1))
    alone = F.array(F.struct(F.xxhash64("group").alias("block"), F.lit(2).alias("side")))
    placed = members.join(around, ["group", "size_class"], "left")
    return placed.select(
        "doc_id", "key", "copies", "group",
        F.explode(F.when(F.col("m").isNull(), alone).otherwise(F.concat(same, above, below))).alias("part"),
    ).select("doc_id", "key", "copies", "group", "part.block", "part.side")


def _common(rows: list[np.ndarray], columns: list[np.ndarray]):
    """Yield (first row, matrix of common shingles) for tiles of rows against all columns."""
    both = rows if rows is columns else rows + columns
    flat = np.concatenate(both)
    _, ids, counts = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(both)), [len(s) for s in both])
    keep = counts[ids] > 1
    ids, owner = ids[keep], owner[keep]
    dense = np.flatnonzero(counts > max(8, len(both) // 32))
    place = np.full(len(counts), -1)
    place[dense] = np.arange(len(dense))
    shift = 0 if rows is columns else len(rows)
    is_row, is_column = owner < len(rows), owner >= shift
    tail = place[ids] < 0
    # Postings of the shingles that few documents hold; the others are columns of a dense product.
    select = tail & is_column
    order = np.argsort(ids[select], kind="stable")
    listed, holders = ids[select][order], owner[select][order] - shift
    first = np.searchsorted(listed, np.arange(len(counts) + 1))
    row_tail = tail & is_row
    tail_ids, tail_rows = ids[row_tail], owner[row_tail]
    dense_rows, dense_columns = ~tail & is_row, ~tail & is_column
    width, step = len(columns), max(1, TILE // max(1, len(columns)))
    for a in range(0, len(rows), step):
        b = min(len(rows), a + step)
        total = np.zeros((b - a, width), np.float32)
        own = dense_rows & (owner >= a) & (owner < b)
        for d in range(0, len(dense), 2048):
            left, right = np.zeros((b - a, 2048), np.float32), np.zeros((width, 2048), np.float32)
            for target, mask, base in ((left, own, a), (right, dense_columns, shift)):
                at = mask & (place[ids] >= d) & (place[ids] < d + 2048)
                target[owner[at] - base, place[ids[at]] - d] = 1
            total += left @ right.T
        mine = (tail_rows >= a) & (tail_rows < b)
        begins, lengths = first[tail_ids[mine]], first[tail_ids[mine] + 1] - first[tail_ids[mine]]
        if lengths.sum():
            inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            cells = np.repeat(tail_rows[mine] - a, lengths) * width + holders[np.repeat(begins, lengths) + inside]
            total += np.bincount(cells, minlength=(b - a) * width).reshape(b - a, width).astype(np.float32)
        yield a, total


def compare(keys: list[bytes], copies: np.ndarray, sets: list[np.ndarray], sides: np.ndarray, threshold: float = THRESHOLD):
    """Exact links of a block: for each document the copies linked to it, and its group's smallest key."""
    one = bool((sides == 2).all())
    left = np.arange(len(sets)) if one else np.flatnonzero(sides == 0)
    right = left if one else np.flatnonzero(sides == 1)
    linked = np.zeros(len(sets), np.int64)
    group = np.arange(len(sets))
    if len(left) and len(right):
        size = np.array([len(s) for s in sets])
        rows = [sets[k] for k in left]
        for a, common in _common(rows, rows if one else [sets[k] for k in right]):
            n = len(common)
            union = size[left[a:a + n], None] + size[None, right] - common
            hit = common >= threshold * union - 1e-6
            if one:
                hit[np.arange(n), a + np.arange(n)] = False
            linked[left[a:a + n]] += hit @ copies[right]
            if not one:
                linked[right] += copies[left[a:a + n]] @ hit
            for r in np.flatnonzero(hit.any(axis=1)):
                met = np.unique(np.append(group[right[hit[r]]], group[left[a + r]]))
                if len(met) > 1:
                    group[np.isin(group, met)] = met[0]
    heads: dict[int, bytes] = {}
    for g, key in zip(group, keys):
        heads[g] = min(heads.get(g, key), key)
    return [(key, int(n), heads[g]) for key, n, g in zip(keys, linked, group) if n]


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, keys, copies, sets, sides, seen = None, [], [], [], [], set()

    def done():
        found = compare(keys, np.array(copies, np.int64), sets, np.array(sides)) if len(keys) > 1 else []
        return pa.RecordBatch.from_arrays(
            [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))],
            ["key", "linked", "head"])

    for batch in batches:
        lists = _lists(batch, "hashes")
        names = ("group", "block", "key", "copies", "side")
        for g, b, key, n, side, w in zip(*(batch.column(c).to_pylist() for c in names), lists):
            if (g, b) != block:
                if keys:
                    yield done()
                block, keys, copies, sets, sides, seen = (g, b), [], [], [], [], set()
            if key not in seen:  # rows of equal doc_id and text
                seen.add(key)
                keys.append(key), copies.append(n), sides.append(side), sets.append(shingles_of(w))
    if keys:
        yield done()


def join(docs: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """Near-duplicate classes: doc_id, key, copy_of, class_id, n_links, kept of every document.

    Two documents are linked if the Jaccard similarity of their sets of five-word shingles is 0.8 or more.
    ``n_links`` counts the other documents linked directly, copies too; ``class_id`` is the smallest doc_id
    reachable by links, ``copy_of`` that of the documents with the same words. Documents of the same words
    are one class from the start, so copies are counted and not compared. Groups that the tries propose are
    compared exactly, in blocks of bounded size; only counts and a spanning forest leave a task.

    A text of one to four words is one shingle; a text without words (null, empty) links with nothing, not
    even its like. Rows of equal doc_id are documents of their own; a null doc_id is never the smallest of
    a class with others; an empty table gives no rows; further columns are ignored. Texts are whole.
    """
    depth = prefix_depth(THRESHOLD, target)
    signed = stored(_signed(docs), "signed")
    classes = stored(
        signed.where(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"), F.first("label").alias("label"),
        ).withColumn("node", F.conv(F.substring(F.hex("key"), 1, 15), 16, 10).cast("bigint")),
        "classes",
    )
    groups = candidate_groups(classes, depth)
    members = classes.select("node", "key", "rep", "copies", "n").join(groups, "node").select(
        F.col("rep").alias("doc_id"), "key", "copies", "n", F.col("label").alias("group"))
    wanted = stored(_blocks(stored(members, "members")), "blocks")
    # One row of each class is wanted: that of the smallest doc_id and, where that repeats, the same words.
    texts = keyed(docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text")).select("_id", "_key", "_hashes")
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = texts.join(
        sized(wanted), F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_key") == F.col("key"))
    ).select("group", "block", "key", "copies", "side", F.col("_hashes").alias("hashes"))
    checked = stored(
        placed.repartition(parallel, "group", "block").sortWithinPartitions("group", "block").mapInArrow(_check, CHECKED), "checked")
    links = checked.groupBy("key").agg(F.sum("linked").alias("linked"))
    forest = components(checked.select(F.col("key").alias("a"), F.col("head").alias("b")))
    whole = stored(
        classes.select("key", "rep", "copies")
        .join(links, "key", "left")
        .join(forest.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "rep", "copies", F.coalesce("linked", F.lit(0)).alias("linked"),
                F.coalesce("label", "key").alias("label")),
        "linked",
    )
    first = F.min(F.struct(F.col("rep").isNull().alias("last"), "rep", "key")).alias("first")
    smallest = whole.groupBy("label").agg(first).select(
        "label", F.col("first.rep").alias("class_id"), F.col("first.key").alias("keep"))
    named = whole.join(smallest, "label").select(F.col("key").alias("_key"), "rep", "copies", "linked", "class_id", "keep")
    kept = F.col("key").isNull() | ((F.col("key") == F.col("keep")) & F.col("doc_id").eqNullSafe(F.col("class_id")))
    return signed.select("doc_id", "key").join(named, F.col("key") == F.col("_key"), "left").select(
        "doc_id", "key", F.coalesce("rep", "doc_id").alias("copy_of"), F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).alias("n_links"), kept.alias("kept"),
    )


def deduplicated(docs: DataFrame, target: float = TARGET_RECALL) -> DataFrame:
    """One document of each class, that of the smallest doc_id, with all its columns.

    Documents without words all stay. Of rows with equal doc_id and words one stays.
    """
    found = stored(join(docs, target), "near_duplicates")
    dropped = stored(found.where(~F.col("kept")).select("doc_id", "key").distinct(), "dropped")
    repeated = stored(found.where(F.col("kept") & F.col("key").isNotNull()).groupBy("doc_id", "key").count()
                      .where(F.col("count") > 1).select("doc_id", "key"), "repeated")
    rows = keyed(packed(docs, "doc_id", "text")).drop("_hashes", "text")

    def among(table: DataFrame):
        table = sized(table.select(F.col("doc_id").alias("_id"), F.col("key").alias("_of")))
        return table, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_of"))

    left = rows.join(*among(dropped), "left_anti")
    if not repeated.isEmpty():
        once = left.join(*among(repeated), "left_semi").dropDuplicates(["doc_id", "_key"])
        left = left.join(*among(repeated), "left_anti").unionByName(once)
    return unpacked(left, docs)
