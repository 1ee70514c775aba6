"""Quality rules: statistics of texts and a decision list learned from labelled ones by sequential covering."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.workspace import stored
from .text import bind, packed, shingle_hashes, unpacked

# Words, symbols, the length of a window, and the two base rules.
SEPARATOR = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
FEWEST_WORDS = 10
REPEAT_PERCENT = 20

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "n_words", "mean_word", "symbol_share", "mark_share", "upper_share", "digit_share", "dup_line_share", "repeat_share", "distinct_share")

QUANTILES = 32  # thresholds of a feature come from so many quantiles of the good and of the bad documents
MOST_CONDITIONS = 4
MOST_RULES = 16
LEAST_PRECISION = 0.9  # of a rule, on documents that did not grow it
LEAST_COVERED = 3  # bad documents that a rule must cover there


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self, value=F.col) -> Column:
        at = value(self.feature)
        return at > self.threshold if self.above else at <= self.threshold


class Rule(NamedTuple):
    """A conjunction of thresholds; what it covers among the documents that pruned it, bad and good."""

    conditions: tuple[Condition, ...]
    bad: int
    good: int

    def column(self, value=F.col) -> Column:
        found = F.lit(True)
        for condition in self.conditions:
            found = found & condition.column(value)
        return found

    def __str__(self) -> str:
        return " and ".join(f"{c.feature} {'>' if c.above else '<='} {c.threshold:g}" for c in self.conditions)


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of five that the text holds twice or more.

    Windows of equal hash are found first and then compared word by word, so a clash of hashes counts for nothing. Most
    texts have none, which the number of distinct hashes tells.
    """
    def again(keyed: Column) -> Column:
        """Sorted positions of the pairs (key, place) whose key another pair has."""
        def twice(s: Column) -> Column:
            same = F.filter(s, lambda x, i: (F.get(s, i - 1)["key"] == x["key"]) | (F.get(s, i + 1)["key"] == x["key"]))
            return F.sort_array(F.transform(same, lambda x: x["place"]))

        return bind(F.sort_array(keyed), twice)

    def pairs(hashes: Column) -> Column:
        return F.transform(hashes, lambda h, i: F.struct(h.alias("key"), i.alias("place")))

    def covered(w: Column, places: Column) -> Column:
        texts = F.transform(places, lambda i: F.struct(F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("key"), i.alias("place")))
        return bind(again(texts), lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x))

    def count(w: Column) -> Column:
        hashes = shingle_hashes(F.transform(w, lambda x: F.xxhash64(x)))
        return bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            bind(again(pairs(h)), lambda p: covered(w, p))))

    return bind(words, count)


def statistics(text: Column) -> Column:
    """A struct of the counts and features of a text; a null text counts as empty, and shares of nothing are 0."""
    whole = F.coalesce(text.cast("string"), F.lit(""))
    words = F.array_remove(F.split(whole, SEPARATOR), "")

    def left(pattern: str) -> Column:
        """How many characters remain without those of the pattern."""
        return F.char_length(F.regexp_replace(whole, pattern, "")).cast("bigint")

    def lines(found: Column) -> Column:
        return F.struct(F.size(found).alias("many"), (F.size(found) - F.size(F.array_distinct(found))).alias("again"))

    def described(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"), F.size(F.array_distinct(w)).alias("distinct"),
            repeated_words(w).cast("bigint").alias("n_repeat_words"))

    with_word = F.filter(F.split(whole, "\n"), lambda line: line.rlike(WORD))
    parts = F.struct(
        bind(words, described).alias("w"), bind(with_word, lines).alias("l"), left(SEPARATOR).alias("word_chars"),
        left(f"[^{SYMBOLS}]+").alias("n_symbols"), left(r"[\p{L}\p{N}\x20\x09-\x0D]+").alias("marks"),
        left(r"\P{Lu}+").alias("upper"), left(r"\P{N}+").alias("digits"))

    def named(p: Column) -> Column:
        def share(part: Column, of: Column) -> Column:
            return F.when(of > 0, part / of).otherwise(F.lit(0.0))

        n, chars = p["w"]["n_words"], p["word_chars"]
        return F.struct(
            n.alias("n_words"), chars.alias("word_chars"), p["n_symbols"].alias("n_symbols"),
            p["l"]["again"].cast("bigint").alias("n_dup_lines"), p["w"]["n_repeat_words"].alias("n_repeat_words"),
            share(chars, n).alias("mean_word"), share(p["n_symbols"], chars).alias("symbol_share"),
            share(p["marks"], chars).alias("mark_share"), share(p["upper"], chars).alias("upper_share"),
            share(p["digits"], chars).alias("digit_share"), share(p["l"]["again"], p["l"]["many"]).alias("dup_line_share"),
            share(p["w"]["n_repeat_words"], n).alias("repeat_share"), share(p["w"]["distinct"], n).alias("distinct_share"))

    return bind(parts, named)


def base_failed(value=F.col) -> Column:
    return (value("n_words") < FEWEST_WORDS) | (100 * value("n_repeat_words") > REPEAT_PERCENT * value("n_words"))


# -- learning ---------------------------------------------------------------------------------


def _thresholds(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each feature: midpoints between quantiles of the good and of the bad rows."""
    steps = [k / QUANTILES for k in range(1, QUANTILES)]
    found = rows.groupBy("bad").agg(*[
        F.concat(F.array(F.min(f), F.max(f)), F.percentile_approx(f, steps, 10_000)).alias(f) for f in FEATURES
    ]).collect()
    points = {f: sorted({float(x) for row in found for x in row[f]}) for f in FEATURES}
    return {f: [(a + b) / 2 for a, b in zip(p, p[1:])] for f, p in points.items()}


def _coded(rows: DataFrame, thresholds: dict[str, list[float]]) -> DataFrame:
    """``codes``: for each feature with thresholds, how many of them a row is above."""
    def code(f: str) -> Column:
        listed = F.array(*[F.lit(x) for x in thresholds[f]])
        return F.struct(F.lit(f).alias("feature"), F.size(F.filter(listed, lambda x: F.col(f) > x)).alias("code"))

    return rows.withColumn("codes", F.array(*[code(f) for f in FEATURES if thresholds[f]]))


def _best_condition(rows: DataFrame, thresholds: dict[str, list[float]]) -> Condition | None:
    """The condition with the greatest information gain on bad rows; None where none gains.

    One job counts good and bad rows by feature and code; sums over codes give those of every threshold.
    """
    counted = rows.select("bad", F.explode("codes").alias("c")).groupBy("c.feature", "c.code").agg(
        F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
    cells: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(x) + 1)] for f, x in thresholds.items()}
    for row in counted:
        cells[row.feature][row.code] = [row.p, row.n]
    best, gain = None, 1e-9
    for f in FEATURES:
        whole_p, whole_n = (sum(c[k] for c in cells[f]) for k in (0, 1))
        if not whole_p or not whole_n:
            continue
        start, p, n = math.log2(whole_p / (whole_p + whole_n)), 0, 0
        for k, threshold in enumerate(thresholds[f]):
            p, n = p + cells[f][k][0], n + cells[f][k][1]
            for above, a, b in ((False, p, n), (True, whole_p - p, whole_n - n)):
                value = a * (math.log2(a / (a + b)) - start) if a else 0
                if value > gain:
                    best, gain = Condition(f, above, threshold), value
    return best


def _grown(rows: DataFrame, thresholds: dict[str, list[float]]) -> tuple[Condition, ...]:
    conditions: list[Condition] = []
    while len(conditions) < MOST_CONDITIONS:
        condition = _best_condition(rows, thresholds)
        if condition is None:
            break
        conditions.append(condition)
        rows = rows.where(condition.column())
    return tuple(conditions)


def _pruned(rows: DataFrame, conditions: tuple[Condition, ...]) -> Rule:
    """The beginning of the conditions with the best balance of bad over good rows; of equal ones the shortest."""
    starts = [Rule(conditions[:k], 0, 0) for k in range(1, len(conditions) + 1)]
    counted = rows.agg(*[
        F.count_if(s.column() & kind).alias(f"{name}{k}")
        for k, s in enumerate(starts) for name, kind in (("p", F.col("bad")), ("n", ~F.col("bad")))
    ]).first()
    found = [Rule(s.conditions, counted[f"p{k}"], counted[f"n{k}"]) for k, s in enumerate(starts)]
    return max(found, key=lambda r: ((r.bad - r.good) / max(1, r.bad + r.good), -len(r.conditions)))


def learn(rows: DataFrame) -> list[Rule]:
    """An ordered list of rules for bad documents, from rows of features and ``bad``, and ``part`` 0 to 2.

    Rows of parts 0 and 1 grow a conjunction of thresholds, condition by condition; those of part 2 prune it from its end.
    Rows that a rule covers leave before the next is grown. The list ends with the first rule that covers fewer
    than LEAST_COVERED bad rows of part 2 or whose precision there is below LEAST_PRECISION. Without rows of both
    kinds there is no rule. Only counts by threshold leave Spark; all rows take part.
    """
    thresholds = _thresholds(rows)
    if not any(thresholds.values()):
        return []
    left = stored(_coded(rows, thresholds), "labelled")
    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        conditions = _grown(left.where(F.col("part") < 2), thresholds)
        if not conditions:
            break
        rule = _pruned(left.where(F.col("part") == 2), conditions)
        if rule.bad < LEAST_COVERED or rule.bad < LEAST_PRECISION * (rule.bad + rule.good):
            break
        rules.append(rule)
        left = left.where(~rule.column())
    return rules


def first_rule(rules: list[Rule], value=F.col) -> Column:
    """The number, from 1, of the first rule that covers a document; null where none does."""
    found = F.lit(None).cast("int")
    for k in reversed(range(len(rules))):
        found = F.when(rules[k].column(value), F.lit(k + 1)).otherwise(found)
    return found


def described(docs: DataFrame) -> DataFrame:
    """doc_id, counts and features of every document, stored."""
    rows = docs.select("doc_id", statistics(F.col("text")).alias("s"))
    return stored(rows.select("doc_id", "s.*"), "statistics")


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of the labelled documents; of labels that differ the worse counts, null ones do not."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(
        (F.min("quality") == 0).alias("bad"))
    joined = stats.join(known, F.col("doc_id") == F.col("_id")).drop("_id")
    return joined.withColumn("part", F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(3)))


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and rule of every document.

    A document that fails a base rule, or that a learned rule covers, is not kept; ``rule`` is that rule's number. The
    rules are learned from all documents of ``labels`` (doc_id, quality 0/1) that are in ``docs``.

    A null or empty text has no words and fails; repeated rows are judged each; null ids are never labelled; without labels
    of both kinds only the base rules hold; an empty table gives no rows; further columns are ignored. Texts are whole.
    """
    stats = described(docs)
    number = first_rule(learn(labelled(stats, labels)))
    return stats.select(
        "doc_id", *COUNTS, base_failed().alias("base_failed"), (~base_failed() & number.isNull()).alias("kept"), number.alias("rule"))


def kept(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that pass the base rules and a learned list, with all their columns: one scan, no join."""
    rows = packed(docs, "text").withColumn("s", statistics(F.col("text")))

    def value(name: str) -> Column:
        return F.col("s")[name]

    return unpacked(rows.where(~base_failed(value) & first_rule(rules, value).isNull()), docs)
