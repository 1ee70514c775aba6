"""Periodic runs, phrase collocations and quality rules on small tables, by brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from scoreloom.llm import catalog, periodic, phrases, quality, tokens

DOCS = "doc_id bigint, text string, lang string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- words --------------------------------------------------------------------------------------


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("aÄ \u0085 \t\n\r.,é", max_size=12)), max_size=6), st.integers(1, 20))
def test_tokens(texts, most):
    column = pa.array(["x", *texts, "y"], pa.string()).slice(1, len(texts))
    words, rows = [], []
    for begin, part in tokens.slices(column, most):
        found = tokens.tokenise(part, tokens.kinds(b" \t\n\x0b\x0c\r"))
        assert found.distinct.take(pa.array(found.codes)).to_pylist() == found.words.to_pylist()
        words += found.words.to_pylist()
        rows += (found.doc + begin).tolist()
    want = [(k, w) for k, t in enumerate(texts) for w in WORD.findall(t or "")]
    assert list(zip(rows, words)) == want


# -- periodic runs ------------------------------------------------------------------------------


def runs_by_force(words, shortest=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start >= q and (start, i + q) not in found:
                found[start, i + q] = q
            i = max(i, start + 1)
    return sorted(((s, e, q) for (s, e), q in found.items() if e - s >= max(shortest, 2 * q)), key=lambda r: (r[0], r[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=12), st.integers(1, 9), st.lists(st.integers(0, 2), max_size=20), st.sampled_from([2, 12]))
def test_runs(unit, times, rest, shortest):
    words = unit * times + rest
    got = periodic.runs_of(np.array([*words, 99]), shortest)
    assert [tuple(r) for r in got.tolist()] == runs_by_force(words, shortest)


def test_runs_of_long_texts(monkeypatch):
    monkeypatch.setattr(periodic, "TILE", 50)
    rng = random.Random(5)
    words = [rng.randrange(4) for _ in range(400)]
    words = words + words[100:] + words[100:300] * 2 + [7] * 500
    assert [tuple(r) for r in periodic.runs_of(np.array([*words, -1])).tolist()] == runs_by_force(words)
    assert periodic.runs_of(np.array([3] * 30_000 + [-1])).tolist() == [[0, 30_000, 1]]


def collapse_by_force(words, runs):
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_docs():
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice("ab") if i % 3 else f"w{rng.randrange(300)}" for _ in range(rng.randint(0, 60))), "en") for i in range(150)]
    rows += [(None, "x y " * 9, "en"), (7, rows[7][1], "en"), (200, None, None), (201, "", "en"), (202, " \t\n", "de"),
             (203, "a b a\u0085c\n" * 20, "en"), (204, "é " * 5000, "fr")]
    return rows


def planted_by_force(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_find_and_digests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(periodic, "SLICE_BYTES", 500)
    rows = periodic_docs()
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS n_words", "'z' AS runs")
    want = []
    for doc_id, text, _ in rows:
        words = WORD.findall(text or "")
        runs = runs_by_force(words) if doc_id != 204 else [(0, 5000, 1)]
        want.append((doc_id, len(words), [(s, e - s, q) for s, e, q in runs], collapse_by_force(words, runs)))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.find(frame).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert periodic.find(frame.limit(0)).collect() == []
    assert periodic.digests(periodic.find(frame.limit(0))).collect() == []
    kept = {(r.doc_id, r.text) for r in periodic.collapsed(frame).collect()}
    assert kept == {(d, collapse if runs else t) for (d, t, _), (_, _, runs, collapse) in zip(rows, want)}
    assert periodic.collapsed(frame).columns == frame.columns


def test_op11(spark, tmp_path):
    rows = [r for r in periodic_docs() if r[0] != 204]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    want, changed = [], 0
    for doc_id, text, _ in rows:
        original = WORD.findall(text or "")
        words = planted_by_force(doc_id, original)
        changed += words != original
        runs = runs_by_force(words)
        best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
        head = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
        want.append((doc_id, len(runs), *head, sha(lines), sha(collapse_by_force(words, runs))))
    assert changed
    got = [tuple(r) for r in catalog.QUERIES["op11_periodic"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


# -- phrases ------------------------------------------------------------------------------------


def phrases_by_force(rows, least, longest):
    counts, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, found in counts.items():
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        for p, a in candidates.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in candidates.items())
            if not inside:
                score, _, l, r = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k, found[p[:k]], found[p[k:]]) for k in range(1, len(p)))
                out.append((lang, " ".join(p), a, l, r, n[lang], score))
    return out


def phrase_rows():
    rng = random.Random(2)
    vocabulary = ["The", "of", "AND", "cat", "Äpfel", "äpfel", "x y", "zé"]
    rows = []
    for i in range(300):
        words = [rng.choice(vocabulary) + rng.choice(["", "", "", ",", "\r", "!"]) for _ in range(rng.randint(0, 40))]
        rows.append((" ".join(words) + rng.choice(["", "\t tok one two three", "\nne ver al one"]), rng.choice(["en", "de", None, "und"])))
    return rows + [(None, "en"), ("", "fr"), ("...", "fr"), ("go go go go go go go go", "es"), rows[0]]


@pytest.mark.parametrize("least,longest", [(3, 5), (20, 5), (8, 2), (100, 5)])
def test_phrases(spark, monkeypatch, least, longest):
    monkeypatch.setattr(tokens, "SLICE_BYTES", 700)
    monkeypatch.setattr(phrases, "HELD", 3)
    rows = phrase_rows()
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS).selectExpr("*", "1 AS n", "2 AS prefix")
    got = [tuple(r) for r in phrases.mine(frame.repartition(5), least, longest).collect()]
    want = phrases_by_force(rows, least, longest)
    assert want or least == 100
    assert sorted(got) == sorted(want)


def test_filter_that_passes_everything(spark, monkeypatch):
    """A full filter keeps the counts right, only more of them are taken."""
    monkeypatch.setattr(phrases.Filter, "has", lambda self, hashes: np.ones(len(hashes), bool))
    rows = phrase_rows()
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS)
    assert sorted(map(tuple, phrases.mine(frame, 20).collect())) == sorted(phrases_by_force(rows, 20, 5))


def test_top_phrases(spark):
    rows = phrase_rows()
    frame = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(rows)], DOCS)
    per_lang = defaultdict(list)
    for lang, *rest in sorted(phrases_by_force(rows, 3, 5), key=lambda r: (-r[6], -r[2], r[1].encode())):
        per_lang[lang].append(rest)
    want = [(lang, k + 1, *rest) for lang, found in per_lang.items() for k, rest in enumerate(found[:7])]
    assert sorted(map(tuple, phrases.top(frame, 7, 3).collect())) == sorted(want)
    assert phrases.top(frame.limit(0)).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch):
    a, n = 3 * 10**11, 7 * 10**14
    entries = spark.createDataFrame([("en", "", "p", a + 1), ("en", "", "q", a + 2), ("en", "p", "q", a)], "lang string, prefix string, next string, count bigint")
    totals = spark.createDataFrame([("en", n)], "lang string, n bigint")
    monkeypatch.setattr(phrases, "stripes", lambda *_: (entries, totals))
    assert [tuple(r) for r in phrases.mine(entries).collect()] == [("en", "p q", a, a + 1, a + 2, n, 1000 * a * n // ((a + 1) * (a + 2)))]


# -- quality ------------------------------------------------------------------------------------


def counts_by_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))



def test_counts(spark):
    rng = random.Random(4)
    parts = ["a", "b", "a b c d e", "\n", "Ü#", " ", "\r", "x|y", "a b c d e f\n", "\x1c", "😀", "\x85"]
    texts = [None, "", "\n\n", "a " * 3000, "one two three four five " * 2, " ".join(f"w{i}" for i in range(900))]
    texts += [" ".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: tuple(r[c] for c in quality.COUNTS) for r in quality.described(frame).collect()}
    assert got == {i: counts_by_force(t) for i, t in enumerate(texts)}


def quality_table():
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(900):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(rng.randint(15, 60))]
        kind = i % 9
        if kind == 0:
            words = [w + "##" for w in words]
        elif kind == 1:
            words = [w.upper() + "!" for w in words]
        elif kind == 2 and i % 2:
            words = words[:4] + words[4:9] * 8
        rows.append((i, " ".join(words), "en"))
        if i % 4 < 3:
            labels.append((i, int(kind > 1 and not (kind == 2 and i % 2)), 0))
    return rows, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_learned_rules(spark):
    rows, labels = quality_table()
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)
    found = quality.judge(docs.selectExpr("*", "1 AS n_words", "true AS kept"), known.selectExpr("*", "9 AS s")).collect()
    assert len(found) == len(rows)
    for r in found:
        counts = counts_by_force(rows[r.doc_id][1])
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert tuple(r[c] for c in quality.COUNTS) == counts and r.base_failed == failed
        assert not (failed and r.kept)
        assert r.kept == (r.doc_id % 9 > 1 and not failed)
    again = quality.judge(docs.repartition(7), known).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found))


def test_rules_are_columns(spark):
    rows, labels = quality_table()
    docs, known = spark.createDataFrame(rows, DOCS).selectExpr("*", "2 AS s"), spark.createDataFrame(labels, LABELS)
    stats = quality.described(docs)
    rules = quality.learn(quality.labelled(stats, known))
    assert 1 < len(rules) <= 4 and all(len(r.conditions) <= quality.MOST_CONDITIONS for r in rules)
    assert " > " in str(rules[0]) or " <= " in str(rules[0])
    left = quality.kept(docs, rules)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in quality.judge(docs, known).collect() if r.kept}


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 0)], [(1, None, 0), (None, 0, 1), (5000, 0, 0)]])
def test_without_both_kinds(spark, labels):
    rows = [(1, "w " * 9, "en"), (2, " ".join(map(str, range(30))), "en"), (2, " ".join(map(str, range(30))), "en"), (None, None, None)]
    found = quality.judge(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted((str(r.doc_id), r.kept, r.rule) for r in found) == [("1", False, None), ("2", True, None), ("2", True, None), ("None", False, None)]
    assert quality.judge(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).collect() == []
