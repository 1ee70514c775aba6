"""Phrase collocations from stripes: a prefix keys the counter of the words that follow it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.workspace import stored
from . import tokens

LEAST = 100  # occurrences of a phrase
LONGEST = 5  # words of a phrase
TOP = 2000

# What separates words and what ends a piece, and the letters that are lowered.
SPACES, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"
_KINDS = tokens.kinds(SPACES, BREAKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNTED = "length int, shelf int, hashes array<int>, counts array<int>"
STRIPES = "shelf int, lang array<string>, prefix array<string>, next array<string>, count array<bigint>"
ENTRIES = "lang string, prefix string, next string, count bigint"
HELD = 500_000  # entries that a task holds before it adds up equal ones
CHUNK_BITS = 1 << 16
FEWEST_BITS, MOST_BITS = 1 << 20, 1 << 29
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Filter:
    """A bit per hash of the frequent phrases of a length: of fixed size, and never without a frequent phrase.

    It only keeps rare phrases from being counted. Those that it lets through are dropped by their exact counts, so a
    fuller filter costs time and changes no result.
    """

    def __init__(self, bits: int, chunks: dict[int, bytes]):
        self.mask = np.uint64(bits - 1)
        self.table = np.zeros(bits // 8, np.uint8)
        for chunk, body in chunks.items():
            self.table[chunk * CHUNK_BITS // 8: (chunk + 1) * CHUNK_BITS // 8] = np.frombuffer(body, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> np.uint64(20)) & self.mask
        return (self.table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _word_hashes(words: list[str]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def _then(head: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase with one more word."""
    mixed = (head ^ (head >> np.uint64(29))) * _FACTOR
    mixed = (mixed ^ (mixed >> np.uint64(32))) + word
    return (mixed ^ (mixed >> np.uint64(31))) * _FACTOR


class Pieces:
    """The words of some texts with the hashes of the phrases that begin at them."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        self.found = tokens.tokenise(texts, _KINDS, _LOWER)
        coded = langs.dictionary_encode()
        self.langs = coded.dictionary
        self.lang = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[self.found.doc]
        self.ids = _word_hashes(self.found.distinct.to_pylist())[self.found.codes]
        self.length = 1
        self.head = _then(_word_hashes(self.langs.to_pylist())[self.lang], self.ids)
        self.whole = np.ones(len(self.ids), bool)  # whether a phrase of ``length`` words begins here

    def lengthen(self) -> None:
        k = self.length
        self.whole[:-k] &= self.found.joined[k - 1:-1]
        self.whole[-k:] = False
        self.head[:-k] = _then(self.head[:-k], self.ids[k:])
        self.length += 1

    def grown(self, known: Filter) -> np.ndarray:
        """Where a phrase of one word more begins whose first and last ``length`` words pass the filter."""
        frequent = self.whole & known.has(self.head)
        here = frequent.copy()
        here[:-1] &= frequent[1:] & self.found.joined[:-1]
        here[-1:] = False
        return here


def _shelved(pieces: Pieces, where: np.ndarray) -> pa.RecordBatch:
    """How often each hash of a phrase at the given words occurs: 44 bits, of which 12 are the shelf."""
    ids, counts = np.unique(pieces.head[where] >> np.uint64(20), return_counts=True)
    shelf = (ids >> np.uint64(32)).astype(np.int32)
    begins = np.flatnonzero(np.append(True, shelf[1:] != shelf[:-1])) if len(ids) else np.empty(0, np.int64)
    bounds = pa.array(np.append(begins, len(ids)), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(begins), pieces.length, np.int32)), pa.array(shelf[begins]),
        pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.uint32).view(np.int32))),
        pa.ListArray.from_arrays(bounds, pa.array(counts.astype(np.int32))),
    ], [c.split()[0] for c in COUNTED.split(", ")])


def _stripes_here(pieces: Pieces, where: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """Shelf, and lang, prefix, next word and count, of the entries of the stripes at the given words."""
    found, n = pieces.found, pieces.length
    at, width = np.flatnonzero(where), len(pieces.found.distinct) + 1
    # The prefix as one number, then the prefix with the next word, each numbered anew to stay within 64 bits.
    key = pieces.lang[at]
    for k in range(n - 1):
        _, key = np.unique(key * width + found.codes[at + k], return_inverse=True)
    _, first, counts = np.unique(key * width + found.codes[at + n - 1], return_index=True, return_counts=True)
    first = at[first]

    def words(k: int) -> pa.Array:
        return found.distinct.take(pa.array(found.codes[first + k])).cast(pa.string())

    heads = [words(k) for k in range(n - 1)]
    return (pieces.head[first] >> np.uint64(52)).astype(np.int64), [
        pieces.langs.take(pa.array(pieces.lang[first])),
        pc.binary_join_element_wise(*heads, " ") if heads else pa.array([""] * len(first), pa.string()),
        words(n - 1), pa.array(counts, pa.int64()),
    ]


def _stripes_of(pieces: Pieces, known: dict[int, Filter]) -> pa.RecordBatch:
    """A row for each shelf with the entries of all stripes that lie on it; one without prefix holds a language's words."""
    per_lang = np.bincount(pieces.lang, minlength=len(pieces.langs))
    none = pa.nulls(len(per_lang), pa.string())
    parts = [(np.zeros(len(per_lang), np.int64), [pieces.langs, none, none, pa.array(per_lang, pa.int64())])]
    for length in sorted(known):
        if length > 1:
            pieces.lengthen()
        parts.append(_stripes_here(pieces, pieces.whole & known[length].has(pieces.head)))
    shelf = np.concatenate([part[0] for part in parts])
    order = np.argsort(shelf, kind="stable")
    shelf, place = shelf[order], pa.array(order)
    begins = np.flatnonzero(np.append(True, shelf[1:] != shelf[:-1]))
    bounds = pa.array(np.append(begins, len(shelf)), pa.int32())
    columns = [pa.concat_arrays([part[1][k] for part in parts]).take(place) for k in range(4)]
    return pa.RecordBatch.from_arrays(
        [pa.array(shelf[begins].astype(np.int32)), *[pa.ListArray.from_arrays(bounds, c) for c in columns]],
        [c.split()[0] for c in STRIPES.split(", ")])


def _merge(least: int):
    """Adds up the entries of each shelf as its rows come by, and yields those that are frequent."""
    names = [c.split()[0] for c in ENTRIES.split(", ")]

    def added(parts: list[pa.Table]) -> pa.Table:
        summed = pa.concat_tables(parts).group_by(names[:3]).aggregate([("count", "sum")])
        return summed.select([*names[:3], "count_sum"]).rename_columns(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelf, held, many = None, [], 0

        def done() -> Iterator[pa.RecordBatch]:
            table = added(held)
            kept = pc.or_(pc.is_null(table["prefix"]), pc.greater_equal(table["count"], least))
            yield from table.filter(kept).combine_chunks().to_batches()

        for batch in batches:
            shelves = batch.column("shelf").to_numpy()
            begins = np.flatnonzero(np.append(True, shelves[1:] != shelves[:-1])) if len(shelves) else []
            for begin, end in zip(begins, [*begins[1:], len(shelves)]):
                if shelf is not None and shelves[begin] != shelf:
                    yield from done()
                    held, many = [], 0
                shelf = shelves[begin]
                rows = batch.slice(begin, end - begin)
                held.append(pa.table([rows.column(c).flatten() for c in names], names))
                many += len(held[-1])
                if many > HELD and many > 2 * len(held[0]):
                    held = [added(held)]
                    many = len(held[0])
        if held:
            yield from done()

    return run


def _by_slice(use):
    """A function of Arrow batches that yields what ``use`` makes of the words of each slice of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in tokens.slices(batch.column("text")):
                for found in use(Pieces(batch.column("lang").slice(begin, len(texts)), texts)):
                    if found.num_rows:
                        yield found

    return run


def _frequent(docs: DataFrame, length: int, known, least: int) -> DataFrame:
    """(length, shelf, hash) of the phrases of ``length`` words, without a filter of the words too, that may be frequent.

    Tasks deal their counts by shelves, a row of many hashes each, so a common phrase is one entry and a common word's
    phrases lie on all shelves. Entries are added up after the shuffle, where Spark's aggregation may spill.
    """
    def count(pieces: Pieces) -> Iterator[pa.RecordBatch]:
        if known is None:
            yield _shelved(pieces, pieces.whole)
            pieces.lengthen()
            yield _shelved(pieces, pieces.whole)
            return
        while pieces.length < length - 1:
            pieces.lengthen()
        here = pieces.grown(known.value)
        pieces.lengthen()
        yield _shelved(pieces, here)

    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    entries = docs.mapInArrow(_by_slice(count), COUNTED).repartition(parallel, "length", "shelf").select(
        "length", "shelf", F.explode(F.arrays_zip("hashes", "counts")).alias("e"))
    summed = entries.groupBy("length", "shelf", F.col("e.hashes").alias("hash")).agg(F.sum("e.counts").alias("count"))
    return stored(summed.where(F.col("count") >= least).drop("count"), "hashes")


def _filters(hashes: DataFrame) -> dict[int, Filter]:
    """A filter for each length of which there are phrases, with 64 bits a phrase as far as the most bits go."""
    bits = {
        row.length: min(MOST_BITS, max(FEWEST_BITS, 1 << (64 * row["count"] - 1).bit_length()))
        for row in hashes.groupBy("length").count().collect()
    }
    if not bits:
        return {}
    mask = F.lit(0)
    for length, many in bits.items():
        mask = F.when(F.col("length") == length, F.lit(many - 1)).otherwise(mask)
    place = hashes.select("length", F.col("hash").cast("bigint").bitwiseAND(mask.cast("bigint")).alias("place"))
    # Bits are or-ed by 64-bit words, then words put side by side: a chunk is 8 KB whatever the number of phrases.
    bit = place.select("length", F.shiftright("place", 6).alias("cell"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"))
    cells = bit.groupBy("length", "cell").agg(F.bit_or("bit").alias("bits"))
    chunks = cells.groupBy("length", F.shiftright("cell", 10).alias("chunk")).applyInArrow(_chunk, "length int, chunk bigint, body binary")
    bodies: dict[int, dict[int, bytes]] = {length: {} for length in bits}
    for row in chunks.collect():
        bodies[row.length][row.chunk] = row.body
    return {length: Filter(bits[length], bodies[length]) for length in bits}


def _chunk(cells: pa.Table) -> pa.Table:
    body = np.zeros(CHUNK_BITS // 64, np.int64)
    cell = cells["cell"].to_numpy()
    body[cell % len(body)] = cells["bits"].to_numpy()
    return pa.table({
        "length": cells["length"].slice(0, 1).combine_chunks(), "chunk": cell[:1] // len(body), "body": pa.array([body.tobytes()], pa.binary())})


def _phrase(prefix: Column, word: Column) -> Column:
    return F.when(prefix == "", word).otherwise(F.concat_ws(" ", prefix, word))


def stripes(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """The merged stripes, (lang, prefix, next, count) of every phrase that occurs ``least`` times, and (lang, n), the
    number of words.

    Hashes are counted first, with no word in the shuffle: of words and pairs in one scan, then of each further length only
    where the phrases of one word less, at its begin and at its end, may be frequent, for no phrase is more frequent
    than its parts. Counts of hashes only choose: in the last scan tasks build the stripes of the chosen phrases. A merged
    stripe has no bound (any word may follow a common one), so its entries are dealt by the hash of the whole phrase
    to shelves, where tasks add them up elementwise and exactly; one holds no more than the chosen phrases of a shelf.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    known = _filters(_frequent(rows, 2, None, least))
    for length in range(3, longest + 1):
        if length - 1 not in known:
            break
        known |= _filters(_frequent(rows, length, context.broadcast(known[length - 1]), least))
    chosen = context.broadcast({k: f for k, f in known.items() if k <= longest})

    def build(pieces: Pieces) -> Iterator[pa.RecordBatch]:
        yield _stripes_of(pieces, chosen.value)

    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    built = rows.mapInArrow(_by_slice(build), STRIPES).repartition(parallel, "shelf").sortWithinPartitions("shelf")
    merged = stored(built.mapInArrow(_merge(least), ENTRIES), "stripes")
    totals = merged.where(F.col("prefix").isNull()).select("lang", F.col("count").alias("n"))
    return merged.where(F.col("prefix").isNotNull()), totals


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """Collocations: lang, phrase, a, l, r, n, score of every candidate that no longer one subsumes.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks and tabs. A candidate
    is a phrase of two to ``longest`` words with ``a`` >= ``least`` occurrences in a language, overlaps included.
    Cut after some words, its parts occur ``l`` and ``r`` times and score floor(1000 a n / (l r)), with ``n`` the
    words of the language; the cut of the lowest score counts, of equal ones the first. A candidate goes if a longer one
    holds it and occurs as often: then one of those with a word more does, before or after it, so the greatest
    count of a stripe (words after a prefix) and of the stripes' entries with the same end (words before it) tell.

    A null lang is ``und``; a null or empty text has no words; repeated rows count each; an empty table gives no rows;
    further columns are ignored. Texts are whole. Counts and scores are exact beyond 64 bits.
    """
    entries, totals = stripes(docs, least, longest)
    phrase = stored(entries.select("lang", "prefix", _phrase(F.col("prefix"), F.col("next")).alias("phrase"), "count"), "phrases")
    counts = phrase.select("lang", "phrase", "count")
    candidates = phrase.where(F.col("prefix") != "")
    after = candidates.groupBy("lang", F.col("prefix").alias("phrase")).agg(F.max("count").alias("most"))
    before = candidates.groupBy("lang", F.regexp_replace("phrase", "^[^ ]+ ", "").alias("phrase")).agg(F.max("count").alias("most"))
    longer = after.unionAll(before).groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("most") < F.col("count"), F.lit(True))).select("lang", "phrase", F.col("count").alias("a"))
    words = F.split("phrase", " ")
    cuts = left.withColumn("k", F.explode(F.sequence(F.lit(1), F.size(words) - 1))).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ").alias("tail"))
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("count").alias("l")), ["lang", "head"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("tail"), F.col("count").alias("r")), ["lang", "tail"])
    wide = "decimal(20,0)"
    scored = cuts.join(totals, "lang").withColumn("score", F.expr(
        f"(cast(1000 * cast(a AS {wide}) AS decimal(38,0)) * n) div (cast(l AS {wide}) * r)"))
    best = scored.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    return best.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def top(docs: DataFrame, most: int = TOP, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """The first ``most`` collocations of each language with their rank, by score, occurrences, and text."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = mine(docs, least, longest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
