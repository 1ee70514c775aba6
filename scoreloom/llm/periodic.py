"""Runs of periodic text by an enhanced suffix array and the branching tandem test."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import tokens

SHORTEST = 12  # words of a run; a run also holds its period twice

# Fixed value: what separates words.
SPACES = b" \t\n\x0b\x0c\r"
_KINDS = tokens.kinds(SPACES)
SLICE_BYTES = 1 << 20
TILE = 1 << 20  # suffixes tested at a time

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
FOUND = f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes in order, their places, common prefix of each suffix and the one before it).

    The last symbol of every text must be unique, so that texts need not be told apart. Prefixes of 1, 2, 4, ... symbols are
    ranked; only suffixes that still share their rank are sorted again. The ranks of each step, kept for these
    alone, then give the common prefixes by halving steps.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.append(True, symbols[order[1:]] != symbols[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    step_of = np.where(new, 0, -1)  # the step that told a suffix from the one before it
    slots = np.flatnonzero(~(new & np.append(new[1:], True)))
    steps = []
    while len(slots):
        at = order[slots]
        steps.append((at, rank[at]))
        key = rank[at] * n + rank[at + (1 << (len(steps) - 1))]
        sort = np.argsort(key, kind="stable")
        at, key = at[sort], key[sort]
        order[slots] = at
        fresh = np.append(True, key[1:] != key[:-1])
        step_of[slots[fresh & (step_of[slots] < 0)]] = len(steps)
        rank[at] = np.maximum.accumulate(np.where(fresh, slots, 0))
        slots = slots[~(fresh & np.append(fresh[1:], True))]
    common = np.where(step_of > 0, 1 << np.maximum(step_of - 1, 0), 0)
    scratch = np.full(n, -1)
    for step in range(len(steps) - 2, -1, -1):
        at, ranks = steps[step]
        scratch[at] = ranks
        open_ = np.flatnonzero(step_of >= step + 2)
        a, b = order[open_ - 1] + common[open_], order[open_] + common[open_]
        same = (scratch[a] >= 0) & (scratch[a] == scratch[b])
        common[open_[same]] += 1 << step
        scratch[at] = -1
    return order, rank, common


def _sides(common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(boundary, first place, end place): where neighbouring suffixes share words, the suffixes around that share as many.

    Left of a boundary those up to the nearest smaller common prefix, right of it those up to the nearest that is not
    greater: the two children that meet there. Intervals of equal depth come apart into one boundary per child.
    """
    where = np.flatnonzero(common > 0)
    below, above = [0] * len(where), [0] * len(where)
    stack: list[int] = []
    values, places = common[where].tolist(), where.tolist()
    last = -1
    for k, (place, value) in enumerate(zip(places, values)):
        if place != last + 1:
            for x in stack:
                above[x] = last + 1
            stack = []
        while stack and values[stack[-1]] >= value:
            above[stack.pop()] = place
        # Without a smaller one the left child begins at the suffix before the first boundary of the stretch.
        below[k] = places[stack[-1]] if stack else -1
        stack.append(k)
        last = place
    for x in stack:
        above[x] = last + 1
    below_, above_ = np.array(below, np.int64), np.array(above, np.int64)
    stretch = np.append(True, where[1:] != where[:-1] + 1) if len(where) else np.empty(0, bool)
    begin = np.maximum.accumulate(np.where(stretch, where - 1, 0)) if len(where) else where
    return where, np.where(below_ < 0, begin, below_), above_


def squares(order: np.ndarray, rank: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, period) of all branching squares: two equal stretches that the word after them does not go on.

    The stretches begin at i and i + d, whose suffixes share exactly d words, so the two lie in different children of an
    interval of depth d. Every suffix i of the smaller child is tested: whether i + d or i - d ranks in the other.
    """
    where, first, end = _sides(common)
    left = where - first <= end - where
    start, size = np.where(left, first, where), np.where(left, where - first, end - where)
    other, other_end = np.where(left, where, first), np.where(left, end, where)
    depth = common[where]
    bounds = np.cumsum(size)
    begins, periods = [], []
    at = 0
    while at < len(where):
        done = bounds[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(bounds, done + TILE, side="right")))
        part = slice(at, stop)
        many = size[part]
        place = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(start[part], many)
        i, d = order[place], np.repeat(depth[part], many)
        low, high = np.repeat(other[part], many), np.repeat(other_end[part], many)
        for shift in (d, -d):
            to = i + shift
            inside = (to >= 0) & (to < len(rank))
            r = rank[np.where(inside, to, 0)]
            hit = inside & (r >= low) & (r < high)
            begins.append(np.minimum(i, to)[hit])
            periods.append(d[hit])
        at = stop
    if not begins:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(begins), np.concatenate(periods)


def _rotated(symbols: np.ndarray, begin: int, period: int) -> int:
    """How far left a square can be rotated: the first position from which the period holds."""
    step = 16
    while begin > 0:
        low = max(0, begin - step)
        differ = np.flatnonzero(symbols[low:begin] != symbols[low + period: begin + period])
        if len(differ):
            return low + int(differ[-1]) + 1
        begin, step = low, step * 2
    return begin


def runs_of(symbols: np.ndarray, shortest: int = SHORTEST) -> np.ndarray:
    """Rows (start, end, period) of all runs of at least ``shortest`` symbols, by start, then period.

    A run holds its smallest period twice, and no neighbour goes on with it. Its last square of the smallest
    period branches; rotating it left finds the start. Squares come by period, so one that lies in a run already found
    with the same end has a multiple of its period and is passed over.
    """
    begins, periods = squares(*suffix_array(symbols))
    order = np.lexsort((begins, periods))
    ending: dict[int, list[int]] = {}
    found = []
    for begin, period in zip(begins[order].tolist(), periods[order].tolist()):
        end = begin + 2 * period
        starts = ending.setdefault(end, [])
        if any(s <= begin for s in starts):
            continue
        start = _rotated(symbols, begin, period)
        starts.append(start)
        if end - start >= shortest:
            found.append((start, end, period))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def _find(ids: pa.Array, texts: pa.Array, shortest: int) -> pa.RecordBatch:
    found = tokens.tokenise(texts, _KINDS)
    n, rows = len(found.codes), len(texts)
    per_row = np.bincount(found.doc, minlength=rows)
    # One symbol per word and row, and behind each row's words one that occurs nowhere else.
    _, own = np.unique(found.doc * (len(found.distinct) + 1) + found.codes, return_inverse=True)
    symbols = np.empty(n + rows, np.int64)
    place = np.arange(n) + found.doc
    symbols[place] = own
    lasts = np.cumsum(per_row) + np.arange(rows)
    symbols[lasts] = n + np.arange(rows)
    runs = runs_of(symbols, shortest)
    row = np.searchsorted(lasts, runs[:, 0])
    before = np.append(0, lasts[:-1] + 1)  # place of each row's first word
    drop = np.zeros(n + rows + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 1], -1)
    kept = np.cumsum(drop)[place] == 0
    bounds = np.append(0, np.cumsum(np.bincount(found.doc[kept], minlength=rows)))
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), found.words.filter(pa.array(kept)).cast(pa.string()))
    collapsed = pc.binary_join(lists, " ")
    structs = pa.StructArray.from_arrays(
        [pa.array(runs[:, 0] - before[row]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(row, minlength=rows))), pa.int32()), structs)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(per_row, pa.int64()), listed, collapsed], ["doc_id", "n_words", "runs", "collapsed"])


def find(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, n_words, runs and collapsed of every document.

    ``runs`` holds (start, length, period) in words of all runs, by start, then period: the longest stretches whose words
    repeat after their smallest period, of at least ``shortest`` words and two periods. ``collapsed`` is the
    text's words joined by single spaces, without those that stand in a run behind its first period.

    A null or empty text has no words, no runs and an empty ``collapsed``; repeated rows and null ids give a row each; an empty
    table gives none; further columns are ignored. A text is handled whole, in one task, by work that grows with
    n log n; memory grows with the longest text, as texts are taken in slices of a megabyte.
    """
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in tokens.slices(batch.column("text"), SLICE_BYTES):
                yield _find(batch.column("doc_id").slice(begin, len(texts)), texts, shortest)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(each, FOUND)


def collapsed(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """The documents, their texts without the words that ``find`` takes out; a text without runs stays as it is."""
    schema = docs.schema
    at = docs.columns.index("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, texts in tokens.slices(batch.column(at), SLICE_BYTES):
                found = _find(pa.nulls(len(texts), pa.int64()), texts, shortest)
                shorter = pc.greater(pc.list_value_length(found.column("runs")), 0)
                rows = batch.slice(begin, len(texts))
                columns = list(rows.columns)
                columns[at] = pc.if_else(shorter, found.column("collapsed"), texts)
                yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(each, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text of one document in ten with its tail made periodic, by a checksum of the number; others as they are."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("bigint")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")

    def tail(w: Column) -> Column:
        n = F.size(w).cast("bigint")
        a = F.pmod(g, F.nullif(n, F.lit(0)))
        p = F.floor((n - a) / (F.pmod(g, F.lit(8)) + 3)).cast("bigint") + 1
        copied = F.transform(F.sequence(a, n - 1), lambda i: F.get(w, (a + F.pmod(i - a, p)).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), copied), " "))

    changed = F.get(F.transform(F.array(words), tail), F.lit(0))
    return F.when(F.pmod(h, F.lit(10)) == 0, F.coalesce(changed, text)).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """Per document the longest run and checksums of all runs and of the collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    one = found.withColumn("_one", longest)
    length = -F.col("_one.minus")
    return one.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("_one.start").alias("start"), length.alias("length"),
        F.col("_one.period").alias("period"), F.expr("(1000 * -_one.minus) div _one.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
