"""Near vectors against all cosines."""

import numpy as np

from scoreloom.llm import embeddings


def brute(rows, least=0.95):
    """{vec_id: (n_links, component_id, kept)} by all pairs."""
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    links = {i: set() for i, _ in rows}
    for i, v in good:
        for j, w in good:
            if i != j and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= least:
                links[i].add(j)
    label = {i: i for i, _ in rows}
    for _ in rows:
        label = {i: min([label[i], *(label[j] for j in links[i])]) for i in label}
    return {i: (len(links[i]), label[i], label[i] == i) for i, _ in rows}


def result(frame):
    found = embeddings.near_vectors(frame)
    assert found.recall >= 0.9
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found.table.collect()}


def test_table_against_all_cosines(spark, small_dir, monkeypatch):
    """The given vectors with near copies of each, in many overlapping and cut shards."""
    monkeypatch.setattr(embeddings, "SHARD", 200)
    monkeypatch.setattr(embeddings, "CHUNK", 150)
    rows = spark.read.parquet(f"{small_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    rng = np.random.default_rng(4)
    x = np.array([r.embedding for r in rows], float)
    x = np.concatenate([x, x + rng.normal(0, 0.03, x.shape), x[:1] + rng.normal(0, 0.01, (300, x.shape[1]))])
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.95).sum(1) - 1
    got = result(frame)
    assert sum(min(got[i][0], want[i]) for i in got) >= 0.97 * want.sum()
    assert all(got[i][0] <= want[i] for i in got)
    assert len({got[i][1] for i in range(1000, 1300)}) == 1


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0]), (2, [2.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0]), (4, [0.0, 1.0, 0.0]), (5, None), (6, [0.0, 0.0, 0.0]),
        (7, [nan, 1.0, 0.0]), (8, [inf, 0.0, 0.0]), (9, [1.0, None, 0.0]), (10, []), (11, [1.0, 0.0]), (12, [5.0, 0.0]),
        (13, [1e-300, 0.0, 0.0]), (14, [1e300, 0.0, 1e299]),
    ]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").selectExpr("*", "'x' AS key", "1 AS unit")
    got = result(frame)
    want = brute([(i, v) for i, v in rows if i not in (13, 14)])
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12):
        assert got[i] == want[i], i
    assert got[1] == (4, 1, True) and got[13] == (4, 1, False) and got[14][1] == 1
    assert embeddings.near_vectors(frame.limit(0)).table.collect() == []


def test_repeated_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(None, [1.0, 2.0])], "vec_id bigint, embedding array<float>")
    assert {(r.n_links, r.component_id) for r in embeddings.near_vectors(frame).table.collect()} == {(3, 1)}


def test_search_finds_a_large_ball():
    """Hundreds of mutual near copies among scattered vectors: the search expands all within range."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (300, 32)), rng.normal(0, 1, 32) + rng.normal(0, 0.05, (400, 32))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = np.triu((x @ x.T) >= 0.95, 1)
    codes = embeddings.range_search(x, embeddings.pruned_graph(x), 0.95)
    assert near[codes // 700, codes % 700].all()
    assert len(codes) >= 0.99 * near.sum()
