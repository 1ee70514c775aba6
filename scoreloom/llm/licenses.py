"""License scan: sparse TF-IDF cosine to templates, then inheritance from the nearest directory."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.workspace import stored
from .graph import sized
from .text import bind, words

# The notices that name each license, a template a line.
TEMPLATES = {
    "MIT": """
        Released under the MIT License.
        This project is licensed under the terms of the MIT license.
        SPDX-License-Identifier: MIT
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software
    """,
    "Apache-2.0": """
        Licensed under the Apache License, Version 2.0.
        SPDX-License-Identifier: Apache-2.0
        Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License.
    """,
    "GPL-3.0": """
        This work is licensed under the GNU General Public License, version 3.
        SPDX-License-Identifier: GPL-3.0
        This program is free software: you can redistribute it and modify it under the terms of the GNU General Public License version 3
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License
    """,
    "GPL-2.0": """
        This work is licensed under the GNU General Public License, version 2.
        SPDX-License-Identifier: GPL-2.0
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License
    """,
    "LGPL-3.0": """
        This library is licensed under the GNU Lesser General Public License, version 3.
        SPDX-License-Identifier: LGPL-3.0
    """,
    "BSD-3-Clause": """
        Licensed under the BSD 3-Clause License.
        SPDX-License-Identifier: BSD-3-Clause
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met
    """,
    "MPL-2.0": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.
        SPDX-License-Identifier: MPL-2.0
    """,
    "CC-BY-4.0": """
        Licensed under CC BY 4.0.
        This work is licensed under a Creative Commons Attribution 4.0 International License.
    """,
    "CC-BY-SA-4.0": """
        Licensed under CC BY-SA 4.0.
        This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.
    """,
    "CC-BY-NC-4.0": """
        Licensed under CC BY-NC 4.0.
        This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.
    """,
    "CC0-1.0": """
        Dedicated to the public domain under CC0 1.0.
        SPDX-License-Identifier: CC0-1.0
    """,
}
# Words that name a license or its variant, and the versions in use. A passage must have those of the
# template, and no name of another license.
NAMES = ("mit", "apache", "gpl", "lgpl", "agpl", "gnu", "lesser", "affero", "bsd", "mozilla", "mpl", "cc", "cc0", "sa", "nc", "nd",
         "sharealike", "noncommercial", "noderivatives")
VERSIONS = ("2", "3", "4")
# A text without any of these words has no notice; each template has one.
CUE = r"(?i)licen[sc]e|copyright|permission|permitted|redistribut|public[^\p{L}\p{N}]+domain"
CUE_WORD = r"licen[sc]e|copyright|permission|permitted|redistribut"
FILE_NAME = r"(?i)(^|/)(un)?(licen[sc]e|copying)[^/]*$"
LEAST_COSINE = 0.7
FILE_SHARE = 0.5  # share of a text's words in its notices from which it is a licence file whatever its name


def _known() -> list[tuple[int, str, str, list[str]]]:
    """(template, license, passage, words) of every template."""
    lines = [(name, line.strip()) for name, lines in TEMPLATES.items() for line in lines.strip().splitlines()]
    return [(k, name, line, re.findall("[a-z0-9]+", line.lower())) for k, (name, line) in enumerate(lines)]


def _is_cue(word: str, before: str | None) -> bool:
    return bool(re.search(CUE_WORD, word)) or (before, word) == ("public", "domain")


def reaches() -> list[tuple[int, int]]:
    """(words before its first cue, words) of the templates: the windows to compare around a cue."""
    found = set()
    for _, _, _, terms in _known():
        found.add((next(i for i, w in enumerate(terms) if _is_cue(w, terms[i - 1] if i else None)), len(terms)))
    return sorted(found)


def _lines(files: DataFrame) -> DataFrame:
    """Whole passages: each line with a cue, and all such lines of a file as one."""
    lines = F.split(F.coalesce("text", F.lit("")), r"\r\n|\r|\n")
    cued = F.filter(lines, lambda x: x.rlike(CUE))
    return files.select("doc_id", "path", F.explode(F.array_distinct(F.concat(cued, F.array(F.array_join(cued, " "))))).alias("passage"))


def _windows(files: DataFrame) -> DataFrame:
    """Template-sized windows around each cue, wherever lines break.

    A cue first becomes a row with the words around it, so that a row stays short however long its text is.
    """
    sizes = reaches()
    most = max(size for _, size in sizes)

    def around(w: Column) -> Column:
        def at(word: Column, i: Column) -> Column:
            cue = word.rlike(CUE_WORD) | ((word == "domain") & (i > 0) & (F.get(w, i - 1) == "public"))
            return F.when(cue, i)

        return F.transform(F.array_compact(F.transform(w, at)), lambda i: F.struct(
            F.least(i, F.lit(most)).alias("at"), F.slice(w, F.greatest(i - most, F.lit(0)) + 1, F.lit(2 * most)).alias("near")))

    cues = files.select("doc_id", "path", F.explode(bind(words(F.col("text")), around)).alias("cue"))
    shapes = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(size).alias("size")) for before, size in sizes])

    def window(shape: Column) -> Column:
        start = F.col("cue")["at"] - shape["before"]
        return F.array_join(F.slice(
            F.col("cue")["near"], F.greatest(start, F.lit(0)) + 1, shape["size"] + F.least(start, F.lit(0))), " ")

    return cues.select("doc_id", "path", F.explode(F.array_distinct(F.transform(shapes, window))).alias("passage"))


def _passages(files: DataFrame) -> DataFrame:
    """(doc_id, path, passage, line) of the texts to compare; ``line`` is false for a window."""
    cued = files.where(F.col("text").rlike(CUE)).select("doc_id", "path", "text")
    return _lines(cued).withColumn("line", F.lit(True)).unionAll(_windows(cued).withColumn("line", F.lit(False)))


def _weighted(texts: DataFrame, key: str, idf: DataFrame, total: int) -> DataFrame:
    """(key, term, weight) with unit length over the terms of a key; a term that no line has is as rare as can be."""
    counted = texts.select(key, F.explode(words(F.col("passage"))).alias("term")).groupBy(key, "term").count()
    rarest = F.log(F.lit(1.0) + total) + 1
    raw = counted.join(idf, "term", "left").select(key, "term", (F.col("count") * F.coalesce("idf", rarest)).alias("weight"))
    norm = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    return raw.join(norm, key).select(key, "term", (F.col("weight") / F.col("norm")).alias("weight"))


def classify(spark: SparkSession, passages: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """(print, license, score) of every different passage that is near enough to a template.

    ``passages`` has print, passage and line. Document frequencies count the different lines of the whole table
    and the templates; windows repeat words of lines and do not count. Weights are rows (passage, term), so the
    cosine is a join on terms and a sum. A passage that lacks a name or version of the template, or names
    another license, is not near. Ties go to the smaller name.
    """
    marks = lambda terms, of: [w for w in of if w in terms]
    known = spark.createDataFrame(
        [(k, name, line, marks(terms, NAMES + VERSIONS), marks(terms, NAMES)) for k, name, line, terms in _known()],
        "template int, license string, passage string, needed array<string>, allowed array<string>",
    ).coalesce(1)
    different = stored(
        passages.groupBy("print").agg(F.min("passage").alias("passage"), F.max("line").alias("line")), "license_passages")
    texts = different.where("line").select("print", "passage").unionAll(
        known.select(F.xxhash64("passage"), "passage")).dropDuplicates(["print"])
    total = texts.count()
    idf = sized(stored(
        texts.select("print", F.explode(F.array_distinct(words(F.col("passage")))).alias("term")).groupBy("term").count()
        .select("term", (F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("count"))) + 1).alias("idf")), "license_idf"))
    # Fewer than a hundred templates of some twenty words: broadcasts of fixed size.
    names = F.broadcast(known.select("template", "license", "needed", "allowed"))
    templates = F.broadcast(_weighted(known, "template", idf, total).join(names.select("template", "license"), "template")
                            .select("template", "license", "term", F.col("weight").alias("wanted")))
    near = _weighted(different, "print", idf, total).join(templates, "term").groupBy("print", "template", "license").agg(
        F.sum(F.col("weight") * F.col("wanted")).alias("score")).where(F.round("score", 9) >= least)
    named = different.select("print", F.array_intersect(
        words(F.col("passage")), F.array(*map(F.lit, NAMES + VERSIONS))).alias("marks"))
    fits = (F.size(F.array_except("needed", "marks")) == 0) & (F.size(F.array_except(
        F.array_intersect("marks", F.array(*map(F.lit, NAMES))), "allowed")) == 0)
    near = near.join(named, "print").join(names.drop("license"), "template").where(fits)
    best = near.groupBy("print").agg(F.min(F.struct((-F.round("score", 9)).alias("low"), "license")).alias("best"))
    return best.select("print", F.col("best.license").alias("license"), (-F.col("best.low")).alias("score"))


def scan(files: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """doc_id, path, license, score, origin and inherited_from of every file.

    ``files`` has doc_id, path and text. Passages are the lines with a cue, those of a file together, and
    template-sized windows around each cue, so a notice counts inside a longer line or broken over several
    lines too. origin is ``header`` where the file's own best passage reaches the cosine ``least``, ``file`` where the file is a licence file, and ``inherited`` where it takes the license
    of the licence file in the nearest directory above it; else all are null. A licence file is one by name
    or one whose notices are at least half of its words. Of several in a directory the best score counts,
    then the smaller path. A null text is empty, a null path has no directory; repeated rows give a row
    each; an empty table gives no rows; further columns are ignored.
    """
    own_path = F.coalesce("path", F.lit(""))
    passages = stored(_passages(files).withColumn("print", F.xxhash64("passage")), "license_lines")
    found = stored(classify(files.sparkSession, passages, least), "license_found")
    # The best passage names the license; the longest passage with that license tells the notices' share of the text.
    by_license = passages.join(sized(found), "print").groupBy("doc_id", "path", "license").agg(
        F.max("score").alias("score"), F.max(F.size(words(F.col("passage")))).alias("n_words"))
    own = stored(
        by_license.groupBy("doc_id", "path").agg(F.max(F.struct("score", "license", "n_words")).alias("best"))
        .select("doc_id", "path", "best.license", "best.score", "best.n_words"), "license_own")
    own = own.select(F.col("doc_id").alias("_id"), F.col("path").alias("_path"), "license", "score", "n_words")
    named = files.select("doc_id", "path", F.size(words(F.col("text"))).alias("all_words")).join(
        sized(own), F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("path").eqNullSafe(F.col("_path")), "left")
    is_file = F.col("license").isNotNull() & (
        own_path.rlike(FILE_NAME) | (F.col("n_words") >= FILE_SHARE * F.col("all_words")))
    marked = stored(named.select(
        "doc_id", "path", "license", "score", is_file.alias("is_file"),
        F.when(own_path.contains("/"), F.regexp_replace(own_path, "/[^/]*$", "")).otherwise("").alias("folder"),
    ), "license_marked")
    holders = stored(
        marked.where(F.col("is_file") & F.col("path").isNotNull()).groupBy("folder").agg(F.min(F.struct(
            (-F.col("score")).alias("low"), "path", "doc_id", "license")).alias("best"))
        .select(F.col("folder").alias("holder"), F.col("best.license").alias("passed_on"), F.col("best.low").alias("low"),
                F.col("best.doc_id").alias("passed_from")), "license_holders")
    # Directories are looked up once each, not once a file.
    steps = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, F.lit(1), k), "/"))
    folders = marked.where(F.col("license").isNull() & F.col("path").isNotNull()).select("folder").distinct()
    nearest = stored(
        folders.select("folder", F.posexplode(above).alias("depth", "holder")).join(sized(holders), "holder")
        .groupBy("folder").agg(F.max(F.struct("depth", "passed_on", "low", "passed_from")).alias("n"))
        .select(F.col("folder").alias("_folder"), "n.passed_on", "n.low", "n.passed_from"), "license_nearest")
    mine = F.col("license").isNotNull()
    takes = ~mine & F.col("passed_on").isNotNull()
    return marked.join(
        sized(nearest), (F.col("folder") == F.col("_folder")) & F.col("license").isNull() & F.col("path").isNotNull(), "left"
    ).select(
        "doc_id", "path",
        F.coalesce("license", "passed_on").alias("license"),
        F.round(F.when(mine, F.col("score")).when(takes, -F.col("low")), 6).alias("score"),
        F.when(F.col("is_file"), "file").when(mine, "header").when(takes, "inherited").alias("origin"),
        F.when(takes, F.col("passed_from")).alias("inherited_from"),
    )


def document_path() -> Column:
    """Documents have no path of their own: source, language and number stand for one."""
    part = lambda c: F.coalesce(F.regexp_replace(F.col(c), "/", "_"), F.lit("none"))
    number = F.col("doc_id")
    return F.concat_ws("/", part("source"), part("lang"), F.floor(number / 100).cast("string"), number.cast("string"))
