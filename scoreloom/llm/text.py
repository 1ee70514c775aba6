"""Word and shingle expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# What separates words, and the size of a shingle in words.
SEPARATOR = r"[^\p{L}\p{N}]+"
SHINGLE = 5


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row.

    The optimizer may write an expression out in place of a column's name, also inside the function of a
    higher-order function, where it would be computed for each element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Lower-case words of letters and digits; none for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SEPARATOR), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column) -> Column:
    """64-bit hashes of all runs of five words, from the words' hashes; none below five words."""
    def runs(h: Column) -> Column:
        last = F.size(h) - SHINGLE
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)]))

    return bind(hashes, runs)


def packed(docs: DataFrame, *fields: str) -> DataFrame:
    """The named fields beside ``row``, a struct of all columns, so that no name of a table can clash."""
    return docs.select(*[F.col(f"`{c}`") for c in fields], F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(frame: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` again, some of them changed."""
    return frame.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])
