"""Mixing, chat formatting, decontamination and personal data on small tables, by brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from scoreloom.llm import chat, decontaminate, mixing, pii

DOCS = "doc_id bigint, text string, lang string, source string"


# -- mixing -----------------------------------------------------------------------------------

def shares(sizes, weights=(1, 2, 3), most=3):
    """Targets by reshares: cap what is above, share the rest anew."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = [s for s in order if s not in full]
        target = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target | {s: most * sizes[s] for s in full}
        full |= above


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 16)
    rng = random.Random(3)
    sources = ["a", "b", "é", "Z", None, "empty", "tiny"]
    rows = [(i, " ".join("w" * rng.randint(0, 9)), "en", rng.choice(["a"] * 6 + sources[:5])) for i in range(400)]
    rows += [(900, "one", "en", "tiny"), (901, "", "en", "empty"), (902, None, None, "empty"), (None, "x\x0by", None, "a"), (3, rows[3][1], "en", rows[3][3])]
    frame = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS size", "2 AS taken")
    got = mixing.mix(frame).collect()
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = shares(dict(sizes))
    assert len(got) == len(rows)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    again = mixing.mix(frame.repartition(5)).collect()
    key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix(frame.limit(0)).collect() == []


def cut_in_order(rows):
    """(doc_id, source, size, taken) by one running sum a source over rows in the order of their keys."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    by_source = {}
    for i, t, _, s in rows:
        key = md5(f"mix:{i if i is not None else md5(t or '')}")
        by_source.setdefault(s, []).append((key, i is not None, i or 0, size(t)))
    want = shares({s: sum(r[3] for r in found) for s, found in by_source.items()})
    out = []
    for s, found in by_source.items():
        total = sum(r[3] for r in found)
        epochs, rest = divmod(int(want[s] + 0.5), total) if total else (0, 0)
        for _, known, i, n in sorted(found):
            out.append((i if known else None, s, n, epochs * n + max(0, min(n, rest))))
            rest -= n
    return sorted(out, key=repr)


def test_mix_cuts_without_shuffling_texts(spark, monkeypatch):
    """Sources cut inside copies of one document, and a plan that moves no row's text."""
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 16)
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(0, 9)), "en", rng.choice("abcde")) for i in range(300)]
    rows += [(7000, f"same size but text {k % 3}", "en", "copies") for k in range(50)]
    rows += [(None, "no number at all", "en", "a")] * 20 + [(None, None, None, None), (8000, "", "en", "blank")]
    frame = spark.createDataFrame(rows, DOCS)
    rows_of = lambda df: sorted(((r.doc_id, r.source, r.size, r.taken) for r in df.collect()), key=repr)
    assert rows_of(mixing.mix(frame)) == cut_in_order(rows)
    mixed = mixing.mixed(frame)
    kept = sorted(map(tuple, mixed.collect()), key=repr)
    assert kept == sorted(map(tuple, mixing.mixed(frame.repartition(5)).collect()), key=repr)
    assert sorted(((r[0], r[3], r[4], r[6]) for r in kept), key=repr) == [r for r in cut_in_order(rows) if r[3] > 0]

    single = spark.createDataFrame(rows[:300], DOCS)
    assert rows_of(mixing.mix(single)) == cut_in_order(rows[:300])
    plan = mixing.mixed(single)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Window" not in plan


# -- chat -------------------------------------------------------------------------------------

@pytest.mark.parametrize("record,want", [
    ('{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}],"x":1}', [("user", "a"), ("assistant", "b")]),
    ('{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}', [("user", "a"), ("assistant", "b")]),
    ('{"instruction":"do","input":"this","output":"done"}', [("user", "do\n\nthis"), ("assistant", "done")]),
    ('{"instruction":"do","output":"done"}', [("user", "do"), ("assistant", "done")]),
    ('{"prompt":"p","response":"r","system":"s"}', [("system", "s"), ("user", "p"), ("assistant", "r")]),
    ('{"data":{"prompt":"p","response":"r"}}', [("user", "p"), ("assistant", "r")]),
    ('{"question":"q","answer":"a","prompt":null}', [("user", "q"), ("assistant", "a")]),
    ('{"strange":"q"}', [(None, None)]), ("no json", [(None, None)]), (None, [(None, None)]),
])
def test_layouts(spark, record, want):
    frame = spark.createDataFrame([(1, record)], "conv_id bigint, record string")
    found = chat.canonical_turns(frame).orderBy("turn").collect()
    assert [(r.role, r.text) for r in found] == want


def test_typed_layout(spark):
    frame = spark.createDataFrame([(1, "p", "c")], "conv_id bigint, prompt string, completion string")
    assert [(r.role, r.text) for r in chat.canonical_turns(frame).orderBy("turn").collect()] == [("user", "p"), ("assistant", "c")]


def conversations(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "1 AS head", "'x' AS body")
    return chat.digest(chat.format_turns(chat.canonical_turns(frame)))


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted(((t if t is not None else -(1 << 63), r or "", x or "") for i, t, r, x in rows if i == c))
        said = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        learned = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def compared(frame):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


def test_conversations(spark):
    rows = [
        (1, 0, "user", r"\### Assistant: </turn> ok"), (1, 1, "assistant", r"\### Assistant: </turn> ok"),
        (2, 1, "assistant", "\n</turn>\n### user: x\n</turn>\n"), (2, 0, "odd: role\n", None), (2, None, None, "ß𝄞"),
        (None, 0, "assistant", "a\\"), (None, 0, "assistant", "a\\"), (3, 5, "assistant", ""),
        (4, 0, "assistant", "########</turn></turn>\\\\</turn>" * 3), (5, 0, "assistant", "long ### \\" * 100_000),
    ]
    assert compared(conversations(spark, rows)) == expected(rows)
    assert conversations(spark, rows).where("conv_id = 99").collect() == []


@given(st.lists(st.text(alphabet="\\#</turn>\n: aé𝄞", max_size=30), min_size=1, max_size=40))
@settings(max_examples=5, deadline=None)
def test_escapes_are_reversible(spark, texts):
    rows = [(i % 7, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    assert compared(conversations(spark, rows)) == expected(rows)


# -- decontamination --------------------------------------------------------------------------

def best(doc, item):
    """Best weighted Jaccard of all windows of the item's length."""
    w, v = (re.findall(r"[^\W_]+", (t or "").lower()) for t in (doc, item))
    grams = lambda x: [tuple(x[i:i + 5]) for i in range(len(x) - 4)]
    d, b = grams(w), grams(v)
    if not b or not d:
        return 0
    found = 0
    for s in range(max(1, len(d) - len(b) + 1)):
        x, y = Counter(d[s:s + len(b)]), Counter(b)
        both = sum((x & y).values())
        found = max(found, both / (sum(x.values()) + sum(y.values()) - both))
    return found


def test_leaks(spark):
    """Planted passages, whole and changed, in texts of any place and length, against all windows."""
    rng = random.Random(5)
    word = lambda: f"v{rng.randint(0, 3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice([6, 12, 30, 60, 120])))) for i in range(12)]
    items += [(50, "too short"), (51, None), (52, "la la la la la la la la la la la la"), (53, " ".join(word() for _ in range(2300)))]
    rows = []
    for k in range(120):
        w = [word() for _ in range(rng.randint(0, 80))]
        own = (items[k % 16][1] or "").split()
        if k % 3 == 0:
            for _ in range(rng.randint(0, 3)):
                if own:
                    own[rng.randrange(len(own))] = word()
        cut = own[rng.randint(0, 3):] if k % 4 == 0 else own
        at = rng.randint(0, len(w))
        rows.append((k, " ".join(w[:at] + cut + w[at:]), "en", "s"))
    rows += [(500, None, None, None), (501, "", None, None), (502, " ".join(word() for _ in range(20000)), None, None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS n", "2 AS window")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(docs, bench).collect()}
    want = {(d[0], i): s for d in rows if d[0] < 502 for i, t in items if i != 53 and (s := best(d[1], t)) >= 0.8}
    assert len(want) > 50
    missing = {k: s for k, s in want.items() if k not in got}
    assert all(abs(got[k] - s) < 1e-9 for k, s in want.items() if k in got)
    assert not set(k for k in got if k[1] != 53) - set(want)
    assert not [k for k, s in missing.items() if s == 1] and len(missing) <= 0.02 * len(want), missing
    assert {d for d, i in got if i == 53} >= {k for k in range(120) if k % 16 == 15 and k % 3}
    assert decontaminate.leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.leaks(docs.limit(0), bench).count() == 0


# -- personal data ----------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


def same(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").selectExpr("*", "1 AS spans", "2 AS key")
    found = {r.doc_id: r for r in pii.find(frame).collect()}
    for i, t in enumerate(texts):
        want = plain_spans(t)
        assert found[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, found[i].spans)
        assert [s for s in found[i].spans.split(",") if s and not s.startswith("term")] == want
        for kind in BASE:
            assert found[i][f"n_{kind}"] == sum(s.startswith(kind) for s in want)
        assert found[i].n_spans == sum(bool(s) for s in found[i].spans.split(","))


def test_spans(spark):
    same(spark, [
        None, "", "a@b.c", "x𝄞 a@b.c.d.@e.f g@h", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112",
        "+1 (523) 555-1055 +123 +1234567890123456", "a@b@c.d", "..a@b.c_d@e.f", "4111111111111111.5 4111  1111", "+49-(0)30.12345678-",
        "1" * 5000, "a" * 30000 + "@", "a@" + "b." * 20000 + "c", "1 " * 20000, "+1" * 5000, "x@y.z " * 3000,
    ])


@given(st.lists(st.text(alphabet="ab@.1234+() -é𝄞\n", max_size=60), min_size=1, max_size=60))
@settings(max_examples=4, deadline=None)
def test_spans_of_any_text(spark, texts):
    same(spark, texts)


def test_table_spans(spark, tiny_dir):
    same(spark, [r.text for r in spark.read.parquet(f"{tiny_dir}/documents.parquet").collect()])


def test_terms(spark):
    """A name that stands only beside one address, in different surroundings, is removed; common words stay."""
    rows = [(i, f"note {i} from Zorbax about item{i} via z@mail.org today case{i}", "en", "s") for i in range(4)]
    rows += [(10 + i, f"note {i} from someone about item today", "en", "s") for i in range(30)]
    rows += [(50 + i, "copy of Qwyx beside q@mail.org always the same", "en", "s") for i in range(5)] + [(60, "ZORBAX, alone", None, None)]
    frame = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r.spans for r in pii.find(frame).collect()}
    assert [s.split(":")[0] for s in found[2].split(",")] == ["term", "term", "email"]
    assert found[60] == "term:0:6" and found[10] == "" and "term" not in found[50]
    clean = {r.doc_id: r.text for r in pii.sanitise(frame).collect()}
    assert clean[12] == rows[6][1] and "[EMAIL]" in clean[2]


def test_terms_of_rare_entities(spark):
    """Values mentioned once or twice count: a firm's name beside its people's addresses, a nickname beside one number."""
    rows = [(i, f"word{i} met Vexmor staff{i} p{i}@firm.net near{i}", "en", "s") for i in range(3)]
    rows += [(10 + i, f"call{i} Qwyxal at{i} +49 30 1234567 soon{i}", "en", "s") for i in range(2)]
    rows += [(20, "once Hapaxon sees lone@other.org here", "en", "s")]
    rows += [(100 + i, f"met someone near item{i % 40} today", "en", "s") for i in range(400)]
    frame = spark.createDataFrame(rows, DOCS)
    terms = {r.doc_id: [s for s in r.spans.split(",") if s.startswith("term")] for r in pii.find(frame).collect()}
    for i in range(3):
        at = rows[i][1].index("Vexmor")
        assert terms[i] == [f"term:{at}:{at + 6}"]
    for i in range(2):
        at = rows[3 + i][1].index("Qwyxal")
        assert terms[10 + i] == [f"term:{at}:{at + 6}"]
    assert terms[20] == [] and not any(terms[100 + i] for i in range(400))


def test_cut_passages_are_leaks(spark):
    """Passages that lack a part of the item at an end, just at the threshold, are found without loss."""
    rng = random.Random(7)
    docs, bench = [], []
    for i in range(120):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(13 + i % 3 * 50)]
        bench.append((i, " ".join(words)))
        cut = (len(words) - 4) // 9
        kept = [words[cut:], words[:-cut], words[cut // 2:len(words) - cut + cut // 2]][i // 3 % 3]
        around = [f"x{rng.randint(0, 10**6)}" for _ in range(300)]
        docs.append((i, " ".join(around[:150] + kept + around[150:]), "en", "s"))
    got = {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words) for r in decontaminate.leaks(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id bigint, text string")).collect()}
    want = {(i, i): s for i in range(120) if (s := best(docs[i][1], bench[i][1])) >= 0.8}
    assert len(want) == 120 and set(got) == set(want)
    assert all(abs(got[k][0] - s) < 1e-9 for k, s in want.items())


def test_long_items_are_compared_whole(spark):
    """A half of an item above 1000 words is no leak; an item's repeated rows and texts count each by itself."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    long = [word() for _ in range(1301)]
    cycle = " ".join(["one two three four five six seven"] * 160).split()
    bench = [(1, " ".join(long)), (2, " ".join(cycle)), (3, "a b c d e f g h"), (3, "a b c d e f g h"), (3, "i j k l m n o p q")]
    edited = list(long)
    for at in range(30, 1301, 60):
        edited[at] = word()
    around = [word() for _ in range(150)]
    texts = [long, long[:650], long[650:], long[:1100], around + long[200:] + around, around + edited + around,
             around + cycle + around, cycle[:500], cycle[:1000] + around, "a b c d e f g h".split(), around + "i j k l m n o p q".split()]
    docs = [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)]
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.leaks(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, "item_id bigint, text string")).collect()}
    want = {}
    for d in docs:
        for i, t in bench:
            if (s := best(d[1], t)) >= 0.8:
                want[d[0], i] = max(s, want.get((d[0], i), 0))
    assert set(got) == set(want) and (1, 1) not in got and len(want) >= 7
    assert all(abs(got[k] - s) < 1e-9 for k, s in want.items())
