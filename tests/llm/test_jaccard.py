"""The Jaccard join against all pairs compared one by one."""

import re

import numpy as np
import pytest

from scoreloom.llm import jaccard


def shingles(text):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    """{doc_id: (class_id, n_links)} of rows with different doc_id."""
    sets = {i: shingles(t) for i, t in rows}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    links = {i: set() for i in sets}
    for i, s in sets.items():
        near = {j for x in s for j in holders[x]} - {i}
        links[i] = {j for j in near if len(s & sets[j]) >= 0.8 * len(s | sets[j]) - 1e-9}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in label:
            low = min([label[i], *(label[j] for j in links[i])])
            changed |= low != label[i]
            label[i] = low
    return {i: (label[i], len(links[i])) for i in sets}


def result(frame):
    return {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(frame).collect()}


def test_same_as_all_pairs(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in docs.collect()])
    assert sum(n > 0 for _, n in want.values()) > 50
    assert result(docs) == want


def test_large_groups_are_cut(spark, monkeypatch):
    """A group of many near copies, compared in many blocks, which the workers see by the frame alone."""
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in rng.integers(0, 5000, 60)]
    rows = []
    for i in range(150):
        w = list(base) + [f"x{k}" for k in rng.integers(0, 9, i % 12)]
        w[int(rng.integers(0, 60))] = f"y{i % 40}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(jaccard, "CHUNK", 1200)
    assert result(spark.createDataFrame(rows, "doc_id bigint, text string")) == brute(rows)


def test_edges(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, "  ...", "b"), (4, "One two", "c"), (5, "one, TWO!", "c"), (6, "two one", None),
        (7, long, None), (8, long + " end", "d"), (None, "one two", "e"), (9, "a b c d e f", None), (9, "a b c d e f", None),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in jaccard.join(frame).collect()), key=repr)
    assert got == sorted([
        (1, 1, 0), (2, 2, 0), (3, 3, 0), (4, 4, 2), (5, 4, 2), (None, 4, 2), (6, 6, 0), (7, 7, 1), (8, 7, 1),
        (9, 9, 1), (9, 9, 1),
    ], key=repr)
    assert jaccard.join(frame.limit(0)).collect() == []


@pytest.mark.parametrize("one_sided", [True, False])
def test_tiles(monkeypatch, one_sided):
    """Common shingles by dense columns and by postings, in tiles."""
    monkeypatch.setattr(jaccard, "TILE", 500)
    rng = np.random.default_rng(2)
    make = lambda n: [np.unique(rng.integers(0, 60, rng.integers(1, 40))).astype(np.uint64) for _ in range(n)]
    rows = make(70)
    columns = rows if one_sided else make(50)
    for a, common in jaccard._common(rows, columns):
        for r, line in enumerate(common):
            assert [int(x) for x in line] == [len(np.intersect1d(rows[a + r], c)) for c in columns]


def test_prefix_depth():
    assert jaccard.prefix_depth(0.8, 0.9999) == 6
    assert jaccard.prefix_depth(0.8, 0.99) == 7
