"""Language identification, URL filter and license scan."""

import zlib

import numpy as np
import pytest

from scoreloom.llm import langid, licenses, urls


# -- languages --------------------------------------------------------------------------------

def test_held_out_accuracy(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    labels = {r.doc_id: r.lang for r in docs.collect()}
    assert set(found) == set(labels)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    held = [i for i, r in found.items() if r.held_out]
    assert np.mean([found[i].lang_pred == labels[i] for i in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found.values())
    assert langid.recognised(docs).count() >= 0.98 * docs.count()


def test_whole_text_counts():
    """A text's end matters as much as its beginning, and neighbours in a batch do not matter."""
    rng = np.random.default_rng(0)
    make = lambda letters, n: "".join(rng.choice(list(letters), n))
    x, y = "abcdef ", "uvwxyz "
    windows = np.stack([langid.windows_of(make(s, 256).encode())[0] for s in (x, y) * 60])
    net = langid.fit(windows, np.array([0, 1] * 60), ("x", "y"))
    texts = [make(x, 300) + make(y, 3000), None, "123 ...", make(x, 5000), "", make(y, 90)]
    names, scores = langid.predict(net, texts)
    assert names == ["y", "und", "und", "x", "und", "y"]
    assert scores[1] == 0 and scores[0] < scores[3]
    assert langid.predict(net, texts[3:4])[0] == ["x"]
    assert langid.predict(None, texts)[0] == ["und"] * 6


def test_languages_of_awkward_rows(spark):
    rows = [(None, None, None), (1, "...", "en"), (2, "word " * 30000, "en"), (3, "Straße und Weg", "de"), (3, "Straße und Weg", "de")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").selectExpr("*", "1 AS score", "2 AS drawn")
    found = langid.identify(frame).collect()
    assert len(found) == 5 and {r.lang_pred for r in found} <= {"en", "de", "und"}
    assert langid.identify(frame.limit(0)).collect() == []
    unlabelled = langid.identify(frame.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


# -- urls -------------------------------------------------------------------------------------

def plain_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest[: min([k for c in "/?#" if (k := rest.find(c)) >= 0] or [len(rest)])]
    path = rest[len(host):]
    path = path[: min([k for c in "?#" if (k := path.find(c)) >= 0] or [len(path)])]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls(spark, tiny_dir):
    odd = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://example.com", "http://example.com/en", "x://a.net/fr/",
           "http://É.net/es/?://b.com/", "ftp://net/es/q", "http://notexample.com/en/1", "http://a.com#/en/", "http://h.org/" + "a" * 50000,
           "://com/", "http://x\ny.com/p\nq"]
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{tiny_dir}/pages.parquet").collect()]
    rows = pages + [(None, u) for u in odd] + [(1000 + k, u) for k, u in enumerate(odd)] * 2
    frame = spark.createDataFrame(rows, "page_id bigint, url string").selectExpr("*", "1 AS score", "'x' AS host", "2 AS rule")
    model = urls.train(spark)
    got = urls.judge(frame, model).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got if r.page_id is not None}
    for i, u in rows:
        if i is not None:
            host, path = plain_host_path(u)
            rule, verdict = plain_rule(host, path)
            r = by_id[i]
            assert (r.host, r.path, r.rule) == (host, path, rule), u
            assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert urls.judge(frame.limit(0), model).collect() == []


def test_url_model_learns(spark):
    """Hosts and paths that training has not seen, by their parts."""
    block = ["http://casino-online.example/jackpot/slots", "http://cheap-viagra.example/buy", "https://free-warez.example/crack/keygen"]
    allow = ["https://wiki.history.example/article/rome", "http://docs.tools.example/guide/setup", "http://tionsh.example.net/en/25930"]
    frame = spark.createDataFrame(list(enumerate(block + allow)), "page_id bigint, url string")
    found = {r.page_id: r.score for r in urls.judge(frame, urls.train(spark)).collect()}
    assert all(found[k] >= 0.5 for k in range(3)) and all(found[k] < 0.5 for k in range(3, 6)), found


def test_url_model_beside_unseen_words(spark):
    """Names beside words that no training row has, and sites whose names no row teaches."""
    rows = [
        (verdict, host) for verdict, names in urls.NAMES.items() for name in names.split()
        for host in (f"{name}-zone.example.org", f"www.super-{name}.example.net", f"{name}.zenith.example.com")
    ]
    plain = ("adelaide casimir cracow camden paradise telescope microbe granite cathedral orchestra marathon sculpture dinosaur"
             " lighthouse vineyard umbrella chocolate saxophone sussex wintergreen spinoza").split()
    rows += [("plain", f"{sub}{name}.example.org") for name in plain for sub in ("", "www.", "m.")]
    taught = {host for _, host, _ in urls.labelled_urls()}
    assert not taught & {host for _, host in rows}
    frame = spark.createDataFrame([(k, f"http://{host}/de/19") for k, (_, host) in enumerate(rows)], "page_id bigint, url string")
    found = {r.page_id: r.score >= 0.5 for r in urls.judge(frame, urls.train(spark)).collect()}
    share = {kind: np.mean([found[k] for k, row in enumerate(rows) if row[0] == kind]) for kind in ("block", "allow", "plain")}
    assert share["block"] >= 0.7 and share["allow"] <= 0.01 and share["plain"] <= 0.05, share


def test_both_verdicts_look_alike():
    """Subdomains, suffixes and paths tell nothing of the verdict of the names."""
    named = urls.labelled_urls()[sum(len(x.split()) for x in urls.LABELLED.values()):]
    for kind in ("block", "allow"):
        of = [(host, path) for verdict, host, path in named if verdict == kind]
        assert {path for _, path in of} == set(urls.PATHS)
        assert all(any(host.endswith(s) for host, _ in of) for s in urls.SUFFIXES)


# -- licenses ---------------------------------------------------------------------------------

def test_license_scan(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    prose = "some words of a text that says nothing about it " * 3
    rows = [
        (1, "a/LICENSE", mit), (2, "a/x.py", prose), (3, "a/b/c/y.py", prose), (4, "a/b/z.py", prose + "\n" + apache), (5, "q/r.py", prose),
        (6, "a/b/notice", apache), (7, "LICENSED", prose + "\nlicence plate of a car in the street"), (8, None, None), (9, "", ""), (10, None, mit),
        (11, "a/x.py", prose), (11, "a/x.py", prose), (12, "q/long.py", "w " * 100_000 + "\n# SPDX-License-Identifier: GPL-3.0"),
        (13, "p/t.md", prose + "\nLicensed under CC BY-NC 4.0.\n"),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, path string, text string").selectExpr("*", "1 AS license", "2 AS score", "3 AS folder")
    got = licenses.scan(frame).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: (r.license, r.origin, r.inherited_from) for r in got}
    assert found == {
        1: ("MIT", "file", None), 2: ("MIT", "inherited", 1), 3: ("Apache-2.0", "inherited", 6), 4: ("Apache-2.0", "header", None),
        5: (None, None, None), 6: ("Apache-2.0", "file", None), 7: (None, None, None), 8: (None, None, None), 9: (None, None, None),
        10: ("MIT", "file", None), 11: ("MIT", "inherited", 1), 12: ("GPL-3.0", "header", None), 13: ("CC-BY-NC-4.0", "header", None),
    }
    assert licenses.scan(frame.limit(0)).collect() == []


@pytest.mark.parametrize("line,name", [
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Released under the MIT License.", "MIT"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
])
def test_every_license_line_of_the_table(spark, tiny_dir, line, name):
    """Documents that hold the line are found by it, and no others without a cue."""
    docs = spark.read.parquet(f"{tiny_dir}/documents.parquet").selectExpr("doc_id", "CAST(doc_id AS STRING) AS path", "text")
    found = {r.doc_id for r in licenses.scan(docs).collect() if r.origin in ("header", "file") and r.license == name}
    assert found == {r.doc_id for r in docs.collect() if line in r.text.split("\n")}


def test_notices_inside_and_across_lines(spark):
    prose = "some other words of a text that go on and on "
    wrapped = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General"
               " Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# later.\n")
    rows = [
        (1, prose * 3 + "Licensed under the Apache License, Version 2.0. " + prose * 3, "Apache-2.0"),
        (2, wrapped + prose * 20, "GPL-3.0"), (3, wrapped.replace("version 3", "version 2") + prose * 20, "GPL-2.0"),
        (4, prose * 2000 + "Released under the MIT License" + prose * 2000, "MIT"),
        (5, "Released under the Foo License. " + prose, None), (6, "SPDX-License-Identifier: Foo", None),
        (7, "This project is licensed under the terms of the Foo license.", None), (8, "Licensed under CC BY-ND 4.0.", None),
        (9, prose + "// Dedicated to the public\n// domain under CC0 1.0.\n" + prose, "CC0-1.0"),
        (10, prose + "Licensed under CC BY-SA 4.0. " + prose, "CC-BY-SA-4.0"), (11, "license " * 5000, None),
        (12, prose + "a licence to drive a car in the street " + prose, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, want string").selectExpr("*", "concat(doc_id, '/x.py') AS path")
    assert {r.doc_id: r.license for r in licenses.scan(frame).collect()} == {r[0]: r[2] for r in rows}
    assert all(r.origin in (None, "header") for r in licenses.scan(frame.where("doc_id IN (1, 2, 4)")).collect())


def test_windows_against_brute_force(spark):
    """Every template-sized run of words that has a cue where a template has its first one."""
    rng = np.random.default_rng(3)
    vocabulary = ["license", "licensed", "public", "domain", "mit", "permission", "x", "y", "copyrighted", "domain"]
    texts = [" ".join(rng.choice(vocabulary, n)) for n in (1, 2, 5, 40, 120)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").selectExpr("*", "'a' AS path")
    want = set()
    for k, text in enumerate(texts):
        terms = text.split()
        for i, word in enumerate(terms):
            if licenses._is_cue(word, terms[i - 1] if i else None):
                want |= {(k, " ".join(terms[max(0, i - b): max(0, i - b + n)])) for b, n in licenses.reaches()}
    assert {(r.doc_id, r.passage) for r in licenses._windows(frame).collect()} == want
