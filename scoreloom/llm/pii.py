"""Personal data: pattern spans, and terms that corpus co-occurrence shows to reveal them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.workspace import stored
from .graph import sized
from .text import bind, packed, unpacked, words

# The kinds in their order. A match may begin only where a run begins or the last match
# ended, and no part gives characters back; that finds the same leftmost matches in linear time.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a kind to be looked for.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]"}
_OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

CONTEXT_WORDS = 8
CONTEXT_CHARS = 160
DISCLOSURE = 0.9  # least share of an entity's information that a disclosing term carries

_SPAN = "struct<start:int,rank:int,kind:string,end:int,value:string>"
_EMPTY = f"array<{_SPAN}>"


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern, kind: str, rank: int) -> Column:
    """All matches with their places: what splitting at the matches leaves gives the text between them."""
    matches = F.regexp_extract_all(text, pattern if isinstance(pattern, Column) else F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    both = F.slice(F.arrays_zip(gaps.alias("gap"), matches.alias("match")), 1, F.size(matches))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_EMPTY).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["match"])
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                        end.alias("end"), x["match"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    return F.aggregate(both, start, step)["spans"]


def base_spans(text: Column) -> Column:
    """Valid spans of all kinds, ordered by start and then kind."""
    def of(kind: str) -> Column:
        found = F.filter(located(text, PATTERNS[kind], kind, KINDS.index(kind)), lambda s: _valid(kind, s["value"]))
        hint = HINTS[kind]
        may = text.contains(hint) if kind == "email" else text.rlike(hint)
        return F.when(may, found).otherwise(F.array().cast(_EMPTY))

    return F.array_sort(F.concat(*map(of, KINDS)))


def entity(kind: Column, value: Column) -> Column:
    """One spelling of the value: e-mail in lower case, numbers by their digits."""
    spelled = F.when(kind == "email", F.lower(value)).when(kind == "ip", value).otherwise(
        F.regexp_replace(value, "[^0-9]", ""))
    return F.concat(kind, F.lit(":"), spelled)


def with_base(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash that tells texts of equal doc_id apart), spans and the mentions beside them."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def mention(s: Column) -> Column:
        begin = F.greatest(F.lit(0), s["start"] - CONTEXT_CHARS)
        left = F.substring(F.col("_text"), begin + 1, s["start"] - begin)
        right = F.substring(F.col("_text"), s["end"] + 1, F.lit(CONTEXT_CHARS))
        # Words that the edge of the excerpt may have cut are left out.
        left = F.when(begin > 0, F.regexp_replace(left, r"^[\p{L}\p{N}]+", "")).otherwise(left)
        right = F.when(F.char_length(right) == CONTEXT_CHARS, F.regexp_replace(right, r"[\p{L}\p{N}]+$", "")).otherwise(right)
        before, after = F.slice(F.reverse(words(left)), 1, CONTEXT_WORDS), F.slice(words(right), 1, CONTEXT_WORDS)
        return F.struct(entity(s["kind"], s["value"]).alias("entity"), F.concat(before, after).alias("terms"))

    return (
        docs.select("doc_id", text.alias("_text"))
        .withColumn("spans", base_spans(F.col("_text")))
        .select("doc_id", F.xxhash64("_text").alias("key"), "spans",
                F.transform("spans", mention).alias("mentions"))
    )


def circle(name: Column) -> Column:
    """What the entity shares with others: mail domain, network, card issuer, or a number without its last four digits."""
    return (
        F.when(name.startswith("email:"), F.regexp_replace(name, "^email:.*@", "email@"))
        .when(name.startswith("ip:"), F.regexp_replace(name, r"^ip:(.*)\.[0-9]+$", "ip/$1"))
        .when(name.startswith("card:"), F.concat(F.lit("card/"), F.substring(name, 6, 6)))
        .otherwise(F.regexp_replace(name, "^phone:(.*)[0-9]{4}$", "phone/$1"))
    )


def _surprise(both: Column, left: Column, right: Column, total: Column) -> Column:
    """Half the log-likelihood ratio of a table of two by two counts: e to its negative bounds the odds of chance."""
    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))

    rest = F.greatest(F.lit(0), total - left - right + both)
    total = both + (left - both) + (right - both) + rest
    return (part(both) + part(left - both) + part(right - both) + part(rest) + part(total)
            - part(left) - part(total - left) - part(right) - part(total - right))


def disclosing_terms(docs: DataFrame, base: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """Terms (term, disclosure) that reveal a protected entity, from counts over the whole corpus.

    With N documents, n(e) of them holding entity e, n(t) term t and n(e,t) term t beside e, the term
    carries log(N n(e,t) / n(e) n(t)) of the log(N / n(e)) bits that e has. It discloses e from the share
    ``disclosure`` on, 1 meaning that t stands nowhere but beside e. An entity is a value and also the
    circle of all values of a mail domain, network, issuer or number prefix, so values that are
    mentioned once count together.

    Copies of one passage are one piece of evidence, a surrounding. The first one only names the pair of
    e and t; the others must be too many for chance: their log-likelihood ratio has to exceed what the
    best of all named pairs would reach by chance.
    """
    seen = base.select("doc_id", "key", F.explode("mentions").alias("m")).select(
        "doc_id", "key", "m.entity", "m.terms", F.xxhash64("m.terms").alias("context"))
    seen = seen.withColumn("entity", F.explode(F.array("entity", circle(F.col("entity")))))
    beside = seen.select("doc_id", "key", "entity", "context", F.explode(F.array_distinct("terms")).alias("term"))
    named = stored(
        beside.select("entity", "term", "context").distinct()
        .groupBy("entity", "term").agg(F.count(F.lit(1)).alias("contexts")), "pii_named")
    n_named = named.count()
    together = beside.select("entity", "term", "doc_id", "key").distinct().groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("n_both"))
    pairs = stored(named.where("contexts > 1").join(together, ["entity", "term"]), "pii_pairs")
    if pairs.isEmpty():  # no term can disclose anything, so nothing needs counting
        return pairs.select("term", F.lit(0.0).alias("disclosure")).where(F.lit(False))
    per_entity = seen.select("entity", "doc_id", "key").distinct().groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_entity"))
    places = seen.select("entity", "context").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_contexts"))
    per_entity = stored(per_entity.join(places, "entity"), "pii_entities")
    # Counted over all words first, so that no word of the text is shuffled more than once a task.
    per_term = docs.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("n_term"))
    total = F.lit(float(base.count()))
    share = F.log(total * F.col("n_both") / (F.col("n_entity") * F.col("n_term"))) / F.log(total / F.col("n_entity"))
    # Documents in which the two stand beside each other count by their surroundings, and without the first.
    again = F.col("contexts") - 1
    surprise = _surprise(
        again, F.col("n_contexts") - 1, F.greatest(again, F.col("n_term") - F.col("n_both") + again),
        total - F.col("n_entity") + F.col("n_contexts") - 1)
    return (
        pairs.join(sized(per_entity), "entity").join(per_term, "term")
        .where(F.col("n_entity") < total)
        .withColumn("disclosure", F.least(F.lit(1.0), share))
        .where(F.col("disclosure") >= disclosure - 1e-12)
        .where(surprise > F.log(F.lit(float(n_named))))
        .groupBy("term").agg(F.max("disclosure").alias("disclosure"))
    )


def term_spans(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Spans of disclosing terms by doc_id and key, of the documents that hold some."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", text.alias("_text")).withColumn("key", F.xxhash64("_text"))
    holding = (
        keyed.select("doc_id", "key", F.explode(F.array_distinct(words(F.col("_text")))).alias("term"))
        .join(terms, "term").groupBy("doc_id", "key").agg(F.collect_set("term").alias("terms"))
    )
    holding = stored(holding, "pii_holding").select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "terms")
    pattern = F.concat(
        F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(F.array_sort("terms"), "|"), F.lit(r")(?![\p{L}\p{N}])"))
    joined = keyed.join(holding, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")))
    return (
        joined.dropDuplicates(["doc_id", "key"])
        .select("doc_id", "key", located(F.col("_text"), pattern, TERM, len(KINDS)).alias("term_spans"))
    )


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """All spans of every document: doc_id, n_email, n_ip, n_card, n_phone, n_term, n_spans, base_sha256, spans.

    ``spans`` are kind:start:end in code points, end exclusive, by start and then kind; the base kinds
    come from the patterns, ``term`` from the corpus. A null text is empty; repeated rows give a row
    each; rows with a null doc_id are kept; an empty table gives no rows; further columns are ignored.
    """
    base = stored(with_base(docs), "pii_base")
    terms = stored(disclosing_terms(docs, base, disclosure), "pii_terms")
    none = F.array().cast(_EMPTY)
    if terms.isEmpty():
        whole = base.withColumn("all", F.col("spans"))
    else:
        more = term_spans(docs, terms).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "term_spans")
        whole = base.join(
            more, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left"
        ).withColumn("all", F.array_sort(F.concat("spans", F.coalesce("term_spans", none))))
    counts = [
        F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in (*KINDS, TERM)
    ]
    return whole.select(
        "doc_id", *counts, F.size("all").cast("bigint").alias("n_spans"), F.sha2(_joined(F.col("spans")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans")
    )


def _merged(spans: Column) -> Column:
    """Overlapping spans as one, which keeps the kind of the first."""
    kind = "array<struct<start:int,end:int,kind:string>>"

    def step(acc: Column, s: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        own = F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
        longer = F.array(F.struct(
            last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind")))
        overlaps = (F.size(acc) > 0) & (s["start"] < F.coalesce(last["end"], F.lit(0)))
        return F.when(overlaps, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), longer)).otherwise(
            F.concat(acc, own))

    return F.aggregate(spans, F.array().cast(kind), step)


def _replaced(text: Column, cuts: Column) -> Column:
    """The text with each cut as its kind in brackets."""
    def rebuilt(c: Column) -> Column:
        def piece(cut: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(c, i - 1)["end"]).otherwise(F.lit(0))
            return F.concat(
                F.substring(text, before + 1, cut["start"] - before), F.lit("["), F.upper(cut["kind"]), F.lit("]"))

        tail = F.get(c, F.size(c) - 1)["end"]
        whole = F.concat(F.array_join(F.transform(c, piece), ""), F.substring(text, tail + 1, F.char_length(text)))
        return F.when(F.size(c) > 0, whole).otherwise(text)

    return bind(cuts, rebuilt)


def sanitise(docs: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """The documents with every span generalised to its kind, such as ``[EMAIL]``; n_chars follows.

    All columns and rows stay, a null text too.
    """
    base = stored(with_base(docs), "pii_base")
    terms = stored(disclosing_terms(docs, base, disclosure), "pii_terms")
    text = F.col("text")
    found = packed(docs, "doc_id", "text").withColumn("spans", base_spans(F.coalesce(text, F.lit(""))))
    if not terms.isEmpty():
        more = term_spans(docs, terms).select(F.col("doc_id").alias("id"), "key", "term_spans")
        found = found.join(
            sized(stored(more, "pii_term_spans")), F.col("doc_id").eqNullSafe(F.col("id"))
            & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("key")), "left"
        ).withColumn("spans", F.array_sort(F.concat("spans", F.coalesce("term_spans", F.array().cast(_EMPTY)))))
    cut = found.select("text", "row", _merged(F.col("spans")).alias("cuts")).select(
        "row", "cuts", _replaced(text, F.col("cuts")).alias("clean"))
    changed = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        own = F.col("row")["n_chars"]
        changed["n_chars"] = F.when(F.size("cuts") > 0, F.char_length("clean").cast("bigint")).otherwise(own)
    return unpacked(cut, docs, **changed)
