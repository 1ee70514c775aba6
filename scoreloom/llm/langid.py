"""Language identification by a byte convolutional network, trained here in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .text import packed, unpacked

UNKNOWN = "und"
WINDOW = 256  # bytes a window holds; a shorter rest is padded
WIDTHS = (2, 3, 4)
FILTERS = 10  # of each width
EMBEDDING = 6
WIDEST = max(WIDTHS)

PER_LANGUAGE = 500  # labelled documents of a language that training takes at most
PER_DOCUMENT = 4  # windows of each of them
EPOCHS, BATCH, RATE = 6, 64, 0.01
SEED = 11
LEAST_SCORE = 0.4  # below it a document is rejected


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    table: np.ndarray  # 257 x EMBEDDING, the last row for padding
    filters: np.ndarray  # WIDEST * EMBEDDING x all filters; narrow filters end in zeros
    bias: np.ndarray
    weights: np.ndarray  # all filters x languages
    offset: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC of its id never trains; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text as byte codes, 256 being padding."""
    count = max(1, -(-len(data) // WINDOW))
    out = np.full(count * WINDOW, 256, np.int16)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, WINDOW)


def _unfolded(table: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For each window and place the embeddings of the next WIDEST bytes."""
    seen = table[windows]
    n, places = len(windows), WINDOW - WIDEST + 1
    step = EMBEDDING * seen.itemsize
    return np.lib.stride_tricks.as_strided(
        seen, (n, places, WIDEST * EMBEDDING), (WINDOW * step, step, seen.itemsize)
    ).reshape(n * places, WIDEST * EMBEDDING)


def _pooled(net: Network, windows: np.ndarray, unfolded: np.ndarray) -> np.ndarray:
    return (unfolded @ net.filters).reshape(len(windows), -1, net.filters.shape[1])


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def window_probabilities(net: Network, windows: np.ndarray, batch: int = 64) -> np.ndarray:
    out = np.empty((len(windows), len(net.languages)), np.float32)
    for a in range(0, len(windows), batch):
        part = windows[a:a + batch]
        best = _pooled(net, part, _unfolded(net.table, part)).max(axis=1) + net.bias
        out[a:a + batch] = _softmax(np.maximum(best, 0) @ net.weights + net.offset)
    return out


def fit(windows: np.ndarray, labels: np.ndarray, languages: tuple[str, ...], seed: int = SEED) -> Network:
    """Train by Adam on cross-entropy. The gradient of a maximum reaches one place a window and filter."""
    rng = np.random.default_rng(seed)
    count = FILTERS * len(WIDTHS)
    allowed = np.concatenate([
        np.repeat((np.arange(WIDEST * EMBEDDING) < w * EMBEDDING)[:, None], FILTERS, 1) for w in WIDTHS], axis=1)
    table = rng.normal(0, 0.5, (257, EMBEDDING)).astype(np.float32)
    table[256] = 0
    filters = (rng.normal(0, 0.4, (WIDEST * EMBEDDING, count)) * allowed).astype(np.float32)
    parts = [table, filters, np.zeros(count, np.float32),
             rng.normal(0, 0.2, (count, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    first, second, t = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(windows))
        for a in range(0, len(order), BATCH):
            pick = order[a:a + BATCH]
            net = Network(languages, *parts)
            w, y = windows[pick], labels[pick]
            unfolded = _unfolded(net.table, w)
            response = _pooled(net, w, unfolded)
            places = response.argmax(axis=1)
            best = np.take_along_axis(response, places[:, None, :], 1)[:, 0] + net.bias
            hidden = np.maximum(best, 0)
            wrong = _softmax(hidden @ net.weights + net.offset)
            wrong[np.arange(len(y)), y] -= 1
            wrong /= len(y)
            back = (wrong @ net.weights.T) * (best > 0)
            rows = unfolded.reshape(len(w), -1, WIDEST * EMBEDDING)[np.arange(len(w))[:, None], places]
            to_filters = np.einsum("nfk,nf->kf", rows, back) * allowed
            to_bytes = back[:, :, None] * net.filters.T[None]
            codes = w[np.arange(len(w))[:, None, None], places[:, :, None] + np.arange(WIDEST)]
            to_table = np.zeros_like(net.table)
            np.add.at(to_table, codes.reshape(-1), to_bytes.reshape(-1, EMBEDDING))
            to_table[256] = 0
            slopes = [to_table, to_filters, back.sum(0), hidden.T @ wrong, wrong.sum(0)]
            t += 1
            for k, g in enumerate(slopes):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**t) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
                parts[k] = (parts[k] - RATE * move).astype(np.float32)
    return Network(languages, *parts)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Fit on a bounded sample of the labelled documents; None where there is no label.

    Of each language up to ``per_language`` documents are taken, those of the smallest hashed ids, and of
    each of them up to PER_DOCUMENT windows spread over its length. Held-out documents are never taken.
    """
    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    labelled = docs.where(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & has_letter)
    counts = labelled.groupBy("lang").count()
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("double")
    # A share a little above what is needed keeps the rows that are sorted few, whatever the table's size.
    share = (2.0 * per_language + 50) / F.col("count") * float(16**8)
    near = labelled.select("doc_id", "lang", "text", drawn.alias("drawn")).join(F.broadcast(counts), "lang").where(
        F.col("drawn") < share)
    length = F.char_length("text")
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(PER_DOCUMENT - 1)),
        lambda k: F.floor(F.greatest(length - WINDOW, F.lit(0)) * k / (PER_DOCUMENT - 1)).cast("int") + 1)
    excerpts = F.transform(F.array_distinct(starts), lambda s: F.substring(F.lower("text"), s, F.lit(WINDOW)))
    first = Window.partitionBy("lang").orderBy("drawn", "doc_id", "excerpts")
    rows = (
        near.select("lang", "drawn", "doc_id", excerpts.alias("excerpts"))
        .withColumn("place", F.row_number().over(first)).where(F.col("place") <= per_language)
        .orderBy("lang", "place").select("lang", "excerpts").collect()
    )
    if not rows:
        return None
    languages = tuple(sorted({r.lang for r in rows}))
    samples = [(windows_of(x.encode("utf-8", "replace")[:WINDOW])[0], languages.index(r.lang)) for r in rows for x in r.excerpts]
    return fit(np.stack([s for s, _ in samples]), np.array([y for _, y in samples]), languages)


def predict(net: Network | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of whole texts: the mean over all windows, weighted by their bytes."""
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    held: list[np.ndarray] = []
    owners: list[int] = []
    sizes: list[np.ndarray] = []

    def flush() -> None:
        if owners:
            chances = window_probabilities(net, np.concatenate(held)) * np.concatenate(sizes)[:, None]
            starts = np.cumsum([0] + [len(s) for s in sizes[:-1]])
            means = np.add.reduceat(chances, starts, axis=0)
            means /= means.sum(axis=1, keepdims=True)
            for i, row in zip(owners, means):
                names[i], scores[i] = net.languages[int(row.argmax())], float(min(1.0, row.max()))
        held.clear(), owners.clear(), sizes.clear()

    waiting = 0
    for i, text in enumerate(texts):
        if net is None or text is None or not any(map(str.isalpha, text)):
            continue
        w = windows_of(text.lower().encode("utf-8", "replace"))
        held.append(w), owners.append(i), sizes.append((w < 256).sum(axis=1).astype(np.float32))
        waiting += len(w)
        if waiting > 4096:
            flush()
            waiting = 0
    flush()
    return names, scores


def with_language(docs: DataFrame, net: Network | None, name: str = "_language") -> DataFrame:
    """Add struct (lang, score). Only the text reaches the network.

    Text null or without a letter is ``und`` with score 0; without any label all texts are. Repeated rows
    are predicted each; an empty table gives no rows; other columns pass on.
    """
    @F.pandas_udf("lang string, score double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            lang, score = predict(net, [t if isinstance(t, str) else None for t in texts])
            yield pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn(name, identify(F.col("text")))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, trained on the documents' own labels."""
    found = with_language(docs.select("doc_id", "text"), train(docs))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"), F.col("_language.score").alias("score"))


def recognised(docs: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents in a language that was learned, with a score of ``least_score`` or more; all columns stay."""
    found = with_language(packed(docs, "text"), train(docs))
    keep = (F.col("_language.lang") != UNKNOWN) & (F.col("_language.score") >= least_score)
    return unpacked(found.where(keep), docs)
