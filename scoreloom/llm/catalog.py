"""One query per operator, with independent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import table
from . import (
    chat, decontaminate, embeddings, jaccard, langid, licenses, mixing, periodic, phrases, pii, quality, urls, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same rows on the same tables."""
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return run

    return register


@query("op1_warc", sql=r"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), d AS (
    SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first_id,
        list_transform(range(8), lambda k: CAST('0x' || substr(hex, CAST(5 * k + 1 AS INTEGER), 5) AS INTEGER)) AS fives
    FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((fives[CAST(i // 4 + 1 AS INTEGER)] >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER) + 1, 1)),
        'string_agg', '') AS payload_digest,
    CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM d
""")
def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archive_round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query("op2_mixing", sql=r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS key
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT source, source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
        CAST(3 * source_size AS DOUBLE) AS most, CAST(sum(source_size) OVER () AS DOUBLE) AS total
    FROM s
), l AS (
    SELECT *, most / weight AS full_at,
        (total - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
), t AS (
    SELECT source, source_size, least(weight * (SELECT max(level) FROM l WHERE level <= full_at), most) AS target FROM l
), b AS (
    SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS budget,
        CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS epochs
    FROM t
), r AS (
    SELECT d.*, b.source_size, b.target, b.epochs, b.budget - b.epochs * b.source_size AS rest,
        CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target,
    CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
FROM r
""")
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op7_chat", sql=r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), ''))
        AS loss_sha256,
    CAST(sum(15 + length(url_encode(role)) + length(regexp_replace(text, '(###|</turn>)', '\\\1', 'g'))) AS BIGINT)
        AS formatted_chars
FROM c GROUP BY conv_id
""")
def op7_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Formats the table with one row per turn and one record of the messages layout."""
    content = r"\### Assistant: </turn> ok"
    record = F.to_json(F.struct(F.array(*[
        F.struct(F.lit(role).alias("role"), F.lit(content).alias("content")) for role in ("user", "assistant")
    ]).alias("messages")))
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), record.alias("record"))
    turns = chat.canonical_turns(table(spark, folder, "conversations")).unionByName(chat.canonical_turns(extra))
    return chat.digest(chat.format_turns(turns))


@query("op8_urls")
def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), urls.train(spark))


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op5_pii")
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


@query("op10_jaccard")
def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(table(spark, folder, "documents")).select("doc_id", "class_id", "copy_of", "n_links")


@query("op6_langid")
def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents"))


@query("op4_embeddings")
def op4_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, folder, "embeddings")).table


@query("op9_licenses")
def op9_licenses(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return licenses.scan(docs.select("doc_id", licenses.document_path().alias("path"), "text"))


@query("op11_periodic")
def op11_periodic(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return periodic.digests(periodic.find(docs.select(
        "doc_id", periodic.planted(F.col("doc_id"), F.col("text")).alias("text"))))


@query("op12_phrases", sql=r"""
WITH d AS (
    SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), p AS (
    SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p
), t AS (
    SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang
), g AS (
    SELECT lang, k.size AS size, unnest(list_transform(range(1, len(words) - k.size + 2), lambda i: words[i:i + k.size - 1])) AS phrase
    FROM w, (SELECT unnest(range(1, 6)) AS size) AS k WHERE len(words) >= k.size
), f AS (
    SELECT lang, size, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100
), o AS (
    SELECT lang, size, phrase, a FROM f AS c WHERE size > 1 AND NOT EXISTS (
        SELECT 1 FROM f AS b, (SELECT unnest(range(0, 4)) AS at) AS x
        WHERE b.lang = c.lang AND b.size > c.size AND x.at <= b.size - c.size
            AND b.phrase[x.at + 1:x.at + c.size] = c.phrase AND 100 * b.a >= 100 * c.a)
), u AS (
    SELECT o.lang, o.phrase, o.a, h.a AS l, r.a AS r, t.n, k.cut,
        CAST((1000 * CAST(o.a AS HUGEINT) * t.n) // (CAST(h.a AS HUGEINT) * r.a) AS BIGINT) AS score
    FROM o JOIN t ON t.lang = o.lang JOIN (SELECT unnest(range(1, 5)) AS cut) AS k ON k.cut < o.size
        JOIN f AS h ON h.lang = o.lang AND h.phrase = o.phrase[1:k.cut]
        JOIN f AS r ON r.lang = o.lang AND r.phrase = o.phrase[k.cut + 1:]
), s AS (
    SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, n, score FROM u
    QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM s QUALIFY rank <= 2000
""")
def op12_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.top(table(spark, folder, "documents"))


@query("op13_quality")
def op13_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))
