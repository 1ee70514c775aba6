"""The pipeline against brute-force versions of its stages, on a small table of awkward rows."""

import pathlib
import sys

import pytest

import corpus_pipeline
from scoreloom.llm import decontaminate, langid, mixing, pii

sys.path.insert(0, str(pathlib.Path(__file__).parent))
from test_jaccard import brute  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def test_whole_run(spark, tiny_dir):
    """Each stage sees what the one before kept, and its decisions hold at the end."""
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet")
    final = corpus_pipeline.run(spark, tiny_dir)
    rows = final.collect()
    assert [c for c in final.columns if c in docs.columns] == docs.columns
    ids = [r.doc_id for r in rows]
    assert len(ids) == len(set(ids)) > 50

    after = {0: docs}
    frame = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1], 1):
        frame = stage(spark, frame, tiny_dir).cache()
        assert frame.columns == docs.columns
        after[k] = frame
    texts = {k: {r.doc_id: r.text for r in f.collect()} for k, f in after.items()}
    predicted = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert set(texts[1]) == {i for i, r in predicted.items() if r.lang_pred != "und" and r.score >= langid.LEAST_SCORE}
    classes = brute(sorted(texts[1].items()))
    assert set(texts[2]) == {i for i, (c, _) in classes.items() if i == c}
    leaked = {r.doc_id for r in decontaminate.leaks(after[2], spark.read.parquet(f"{tiny_dir}/benchmark.parquet")).collect()}
    assert set(texts[3]) == set(texts[2]) - leaked
    assert set(texts[4]) == set(texts[3])
    assert not any("@mail" in t for t in texts[4].values())
    taken = {r.doc_id: r.taken for r in mixing.mix(after[4]).collect()}
    assert {r.doc_id: r.taken for r in rows} == {i: n for i, n in taken.items() if n > 0}


def test_awkward_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, an empty table, a clashing column."""
    long = " ".join(f"wort{i % 997}" for i in range(20000))
    rows = [
        (None, None, None, None, None), (1, "", "en", "a", 0), (2, long, None, None, None), (2, long, None, None, None),
        (3, "mail me at a.b@c.de or +1 (555) 555-5555 thanks", "en", "b", 10), (4, "1234 !!! ...", None, "b", 5),
        (5, "mail me at a.b@c.de or +1 (555) 555-5555 thanks", "en", "c", 10),
        *[(10 + i, f"plain words of document number {i} in some language {i * 7} end", "en", "a", 60) for i in range(8)],
    ]
    folder = str(tmp_path / "sf")
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS taken", "2 AS key", "3 AS _key", "4 AS spans", "5 AS `a.b`", "6 AS _id").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, "plain words of document number 3 in some language 21 end"), (2, None)],
                          "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "taken", "key", "_key", "spans", "a.b", "_id"]
    kept = {r.doc_id: r.text for r in docs.collect()}
    assert len(kept) == docs.count()
    assert 13 not in kept and 5 not in kept and 1 not in kept and 4 not in kept and None not in kept
    assert kept[3] == "mail me at [EMAIL] or [PHONE] thanks"
    assert kept[2] == long
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() > 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0


@pytest.mark.parametrize("text,want", [
    (None, None), ("", ""), ("nothing here", "nothing here"), ("x 1.2.3.4, y", "x [IP], y"),
    ("a@b.cd", "[EMAIL]"), ("ü +12345678901234 ü", "ü [PHONE] ü"),
])
def test_sanitise(spark, text, want):
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert [r.text for r in pii.sanitise(frame).collect()] == [want]
