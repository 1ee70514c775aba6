"""Near-duplicate vectors: a robust-pruned graph over overlapping shards and range-expanding search."""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.workspace import stored
from .graph import components

LEAST_COSINE = 0.95
SHARD = 2000  # vectors a shard is meant to hold
CHUNK = 3000  # vectors of one side of a block; larger shards are cut
MOST_CENTROIDS, PER_CENTROID = 16_384, 8  # of which a sample of at most 131,072 vectors is the base
OVERLAPS = (3, 6, 12)  # nearest centroids whose shards a vector joins; more if the audit asks for it
NEAR, FAR, CANDIDATES, ALPHA = 16, 8, 48, 1.2  # close and random neighbours of a node, and pruning
MEDOIDS, BEAM, HOPS, QUERIES = 8, 8, 5, 128
AUDITED, LEAST_RECALL = 500, 0.9
SEED = 5

UNITS = "vec_id bigint, key binary, unit array<double>"
LISTS = "key binary, near array<binary>"
CHECKED = "key binary, linked bigint, head binary"


def _matrix(column, width: int | None = None) -> np.ndarray:
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return values[offsets[0]: offsets[-1]].reshape(len(column), -1)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, units = [], []
        for vector in batch.column("embedding").to_pylist():
            unit = None
            if vector and None not in vector:
                v = np.asarray(vector, np.float64)
                top = np.abs(v).max()
                if np.isfinite(top) and top > 0:
                    v = v / top  # neither overflow nor underflow in the norm
                    unit = v / np.sqrt((v * v).sum()) + 0.0
            keys.append(None if unit is None else hashlib.blake2b(unit.tobytes(), digest_size=16).digest())
            units.append(unit)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(units, pa.list_(pa.float64()))],
            ["vec_id", "key", "unit"])


def centroids(sample: np.ndarray, count: int, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """Directions that the sample gathers around."""
    rng = np.random.default_rng(seed)
    found = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(part @ found.T).argmax(1) for part in np.array_split(sample, max(1, len(sample) // 4096))])
        total = np.zeros_like(found)
        np.add.at(total, nearest, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        found = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), found)
    return found


def _shards(classes: DataFrame, total: int, overlap: int) -> DataFrame:
    """(key, width, shard) of each vector's nearest centroids; vectors of another width have other shards."""
    count = min(MOST_CENTROIDS, max(1, total * overlap // SHARD))
    share = min(1.0, PER_CENTROID * count * 1.2 / max(1, total))
    drawn = F.conv(F.substring(F.hex("key"), 1, 12), 16, 10).cast("double") / float(16**12)
    rows = classes.where(drawn < share).select("unit", "key").orderBy("key").limit(PER_CENTROID * count).collect()
    by_width: dict[int, list] = {}
    for r in rows:
        by_width.setdefault(len(r.unit), []).append(r.unit)
    bases = {w: centroids(np.array(v), -(-count * len(v) // len(rows))) for w, v in by_width.items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("unit")
            widths = np.diff(lists.offsets.to_numpy())
            shards: list = [None] * len(widths)
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                base = bases.get(int(w))
                near = np.zeros((len(at), 1), int)  # a width that the sample lacks is rare: one shard, cut if large
                if base is not None:
                    values = lists.values.to_numpy(zero_copy_only=False)
                    x = values[lists.offsets.to_numpy()[at][:, None] + np.arange(w)]
                    k = min(overlap, len(base))
                    near = np.argpartition(-(x @ base.T), k - 1, axis=1)[:, :k]
                for i, row in zip(at, near):
                    shards[i] = row.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(widths, pa.int32()), pa.array(shards, pa.list_(pa.int64()))],
                ["key", "width", "shards"])

    found = classes.select("key", "unit").mapInArrow(assign, "key binary, width int, shards array<bigint>")
    return found.select("key", "width", F.explode("shards").alias("shard"))


def _blocks(shards: DataFrame) -> DataFrame:
    """(key, block, blocks): a shard is a block; one above CHUNK vectors is cut, each two chunks being one.

    So a block is bounded whatever gathers in a shard, and all pairs of a shard still meet in a block.
    """
    sizes = shards.groupBy("width", "shard").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("m"))
    i = F.pmod(F.xxhash64("key"), F.col("m"))
    parts = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1), lambda j: F.xxhash64(
        "width", "shard", F.least(i, j), F.greatest(i, j)))
    placed = shards.join(sizes, ["width", "shard"]).groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(parts)))).alias("blocks"))
    return placed.select("key", F.explode("blocks").alias("block"), "blocks")


def pruned_graph(x: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Neighbours of each vector, padded with -1: close ones that prune each other robustly, and random far ones.

    A candidate is dropped when a closer neighbour that was chosen is so much nearer to it (by ALPHA) that a
    search gets there through the neighbour.
    """
    n, rng = len(x), np.random.default_rng(seed)
    out = np.full((n, NEAR + FAR), -1, np.int64)
    c = min(CANDIDATES, n - 1)
    if c < 1:
        return out
    for a in range(0, n, 256):
        rows = np.arange(a, min(n, a + 256))
        cosine = x[rows] @ x.T
        cosine[np.arange(len(rows)), rows] = -9
        near = np.argpartition(-cosine, c - 1, axis=1)[:, :c]
        own = np.take_along_axis(cosine, near, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
        far = np.sqrt(np.maximum(0, 2 - 2 * own))
        open_, points, line = np.ones(near.shape, bool), x[near], np.arange(len(rows))
        for r in range(min(NEAR, c)):
            first = open_.argmax(1)
            any_ = open_[line, first]
            if not any_.any():
                break
            out[rows[any_], r] = near[line, first][any_]
            gap = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("ncd,nd->nc", points, points[line, first])))
            open_ &= ALPHA * gap > far
            open_[line, first] = False
    spread = rng.integers(0, n, (n, FAR))
    out[:, NEAR:] = np.where(spread == np.arange(n)[:, None], -1, spread)
    return out


def medoids(x: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """Vectors nearest to the block's mean and to a few centroids of it."""
    mean = x.mean(0, keepdims=True)
    heads = np.concatenate([mean, centroids(x, count - 1, rounds=3)])
    return np.unique((heads @ x.T).argmax(1))


def range_search(x: np.ndarray, graph: np.ndarray, least: float) -> np.ndarray:
    """Codes row * n + column of the pairs with cosine of at least ``least`` that the search meets.

    Each vector is a query. From the medoids and its own node the BEAM nearest nodes are expanded, HOPS
    times; after that every node within range is, until none is left, however many there are.
    """
    n, start, found = len(x), medoids(x), []
    for a in range(0, n, QUERIES):
        rows = np.arange(a, min(n, a + QUERIES))
        q, line = x[rows], np.arange(len(rows))
        cosine = np.full((len(rows), n), -3.0)
        cosine[:, start] = q @ x[start].T
        cosine[line, rows] = 1.0
        left = cosine.copy()  # of nodes met and not yet expanded
        step, k = 0, min(BEAM, n)
        while True:
            pick = np.argpartition(-left, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(left, pick, 1)
            go = (value >= least) | ((step < HOPS) & (value > -2))
            who, which = np.nonzero(go)
            if not len(who):
                break
            nodes = pick[who, which]
            left[who, nodes] = -3.0
            next_ = graph[nodes]
            owner = np.repeat(who, next_.shape[1])
            next_ = next_.reshape(-1)
            fresh = next_ >= 0
            code = np.unique(owner[fresh] * n + next_[fresh])
            owner, next_ = code // n, code % n
            fresh = cosine[owner, next_] < -2
            owner, next_ = owner[fresh], next_[fresh]
            value = np.einsum("ij,ij->i", q[owner], x[next_])
            cosine[owner, next_] = value
            left[owner, next_] = value
            step += 1
        cosine[line, rows] = -3.0
        r, c = np.nonzero(cosine >= least)
        found.append(np.minimum(rows[r], c) * n + np.maximum(rows[r], c))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


class _Rows:
    """Rows of the same block, one after the other, from batches sorted by block."""

    def __init__(self, batches: Iterator[pa.RecordBatch], columns: list[str]):
        self.batches, self.columns = batches, columns

    def __iter__(self):
        block, rows = None, []
        for batch in self.batches:
            data = [batch.column(c).to_pylist() for c in self.columns]
            for b, *row in zip(batch.column("block").to_pylist(), *data):
                if b != block and rows:
                    yield rows
                    rows = []
                block = b
                rows.append(row)
        if rows:
            yield rows


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _Rows(batches, ["key", "unit"]):
        keys, graph = [r[0] for r in rows], pruned_graph(np.array([r[1] for r in rows]))
        near = [[keys[j] for j in line if j >= 0] for line in graph.tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(near, pa.list_(pa.binary()))], ["key", "near"])


def _search(least: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _Rows(batches, ["block", "blocks", "key", "copies", "unit", "near"]):
            keys = [r[2] for r in rows]
            place = {k: i for i, k in enumerate(keys)}
            lists = [[place[k] for k in r[5] or () if k in place] for r in rows]
            graph = np.full((len(rows), max(1, max(map(len, lists)))), -1, np.int64)
            for i, line in enumerate(lists):
                graph[i, : len(line)] = line
            n = len(rows)
            codes = range_search(np.array([r[4] for r in rows]), graph, least)
            left, right = codes // n, codes % n
            if len(codes):  # a pair that several blocks hold counts in the first of them
                width = max(len(r[1]) for r in rows)
                held = np.array([r[1] + [r[1][-1]] * (width - len(r[1])) for r in rows])
                mine = np.zeros(len(codes), bool)
                for a in range(0, len(codes), 65536):
                    part = slice(a, a + 65536)
                    both = (held[left[part]][:, :, None] == held[right[part]][:, None, :]).any(2)
                    mine[part] = held[left[part], both.argmax(1)] == rows[0][0]
                left, right = left[mine], right[mine]
            copies, linked = np.array([r[3] for r in rows], np.int64), np.zeros(n, np.int64)
            np.add.at(linked, left, copies[right])
            np.add.at(linked, right, copies[left])
            group = list(range(n))

            def root(i: int) -> int:
                while group[i] != i:
                    group[i] = group[group[i]]
                    i = group[i]
                return i

            for i, j in zip(left.tolist(), right.tolist()):
                i, j = root(i), root(j)
                if i != j:
                    group[max(i, j)] = min(i, j)
            met = np.flatnonzero(linked).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([keys[i] for i in met], pa.binary()), pa.array(linked[met], pa.int64()),
                 pa.array([keys[root(i)] for i in met], pa.binary())], ["key", "linked", "head"])

    return search


def audit(classes: DataFrame, linked: DataFrame, total: int, least: float) -> float:
    """Share of the true links of a bounded sample of vectors, compared with all others, that were found.

    It is the least of the share of all links and the mean share of a vector, so that a ball of near copies, which has most
    links, cannot hide what small groups miss.
    """
    drawn = F.conv(F.substring(F.md5("key"), 1, 12), 16, 10).cast("double") / float(16**12)
    queries = classes.where(drawn < 2.0 * AUDITED / max(1, total)).orderBy("key").limit(AUDITED).select("key", "unit").collect()
    by_width: dict[int, list] = {}
    for r in queries:
        by_width.setdefault(len(r.unit), []).append(r)
    bases = {w: ([bytes(r.key) for r in v], np.array([r.unit for r in v])) for w, v in by_width.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, copies = batch.column("unit"), batch.column("copies").to_numpy()
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            widths = np.diff(offsets)
            for w, (keys, x) in bases.items():
                at = np.flatnonzero(widths == w)
                y = values[offsets[at][:, None] + np.arange(w)]
                near = ((x @ y.T) >= least) @ copies[at]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(near, pa.int64())], ["key", "true"])

    truth = classes.select("unit", "copies").mapInArrow(count, "key binary, true bigint").groupBy("key").agg(
        F.sum("true").alias("true"))
    own = classes.select("key", "copies").join(truth, "key").join(linked.select("key", "linked"), "key", "left")
    true = F.col("true") - F.col("copies")  # without the vector's own copies
    met = F.least(true, F.coalesce("linked", F.lit(0)))
    row = own.agg(F.sum(true), F.sum(met), F.avg(F.when(true > 0, met / true))).first()
    return 1.0 if not row[0] else min(row[1] / row[0], row[2])


@dataclass(frozen=True)
class NearVectors:
    table: DataFrame
    recall: float


def near_vectors(vectors: DataFrame, least: float = LEAST_COSINE) -> NearVectors:
    """Links of cosine ``least`` or more: vec_id, n_links, component_id, kept of every vector, and the recall.

    Vectors of the same direction are one class from the start, whose copies are counted, not compared.
    Classes are dealt to the shards of their nearest centroids; each shard builds a pruned graph, the lists
    of a vector from all its shards are united, and each shard searches the united graph among its own
    vectors. Every pair is verified by its cosine in double precision and counts in one shard only, so what
    leaves a task grows with its vectors, not with the pairs. The centroids come from a bounded sample, the
    index holds every vector, and a sample of vectors is compared with all to measure the recall; below
    LEAST_RECALL the work is repeated with more overlap.

    Vectors that are null, empty, zero or hold a null or non-finite component link with nothing, nor do
    vectors of different length. Repeated rows count each; a null vec_id is never the smallest of several;
    an empty table gives no rows; further columns are ignored.
    """
    units = stored(vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>"))
                   .mapInArrow(_units, UNITS), "units")
    classes = stored(
        units.where(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("unit").alias("unit")),
        "vector_classes",
    )
    total = classes.count()
    parallel = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def by_block(frame: DataFrame) -> DataFrame:
        return frame.repartition(parallel, "block").sortWithinPartitions("block")

    links, checked, recall = None, None, 1.0
    for overlap in OVERLAPS:
        blocks = stored(_blocks(_shards(classes, total, overlap)) if total else
                        classes.select("key", F.lit(0).cast("bigint").alias("block"), F.array(F.lit(0).cast("bigint")).alias("blocks")),
                        "vector_blocks")
        placed = blocks.join(classes.select("key", "copies", "unit"), "key")
        lists = by_block(placed.select("block", "key", "unit")).mapInArrow(_build, LISTS)
        united = stored(lists.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "united")
        checked = stored(by_block(
            placed.join(united, "key").select("block", "blocks", "key", "copies", "unit", "near")
        ).mapInArrow(_search(least), CHECKED), "vector_links")
        links = stored(checked.groupBy("key").agg(F.sum("linked").alias("linked")), "vector_linked")
        recall = audit(classes, links, total, least)
        if recall >= LEAST_RECALL:
            break
    logging.getLogger(__name__).log(
        logging.INFO if recall >= LEAST_RECALL else logging.WARNING, "recall of near vectors: %.4f with overlap %d", recall, overlap)
    forest = components(checked.select(F.col("key").alias("a"), F.col("head").alias("b")))
    whole = stored(
        classes.select("key", "rep", "copies").join(links, "key", "left")
        .join(forest.withColumnRenamed("node", "key"), "key", "left")
        .select("key", "copies", "rep", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("label", "key").alias("label")),
        "vector_labels",
    )
    smallest = whole.groupBy("label").agg(F.min("rep").alias("component"))
    named = whole.join(smallest, "label").select(F.col("key").alias("_key"), "copies", "linked", "component")
    component = F.coalesce("component", "vec_id")
    table = units.select("vec_id", "key").join(named, F.col("key") == F.col("_key"), "left").select(
        "vec_id", F.coalesce(F.col("copies") - 1 + F.col("linked"), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
    return NearVectors(table, recall)
