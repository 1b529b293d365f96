"""The queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, collocation, dialogue, exact, html_text, imatch, langid, mil, packing, simhash, substring, toxicity, warc
from tidemark.llm.common import importable, written

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can express it."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            importable(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op3_pack_windows")
def pack_windows(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query("op5_byte_bpe")
def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.token_digests(table(spark, folder, "documents"), path, public_tokenizers.PATTERN)


@query(
    "op8_exact_dedup",
    """
    WITH texts AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents),
    groups AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM texts GROUP BY text_sha256)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM texts JOIN groups USING (text_sha256)
    """,
)
def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.copy_groups(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query("op10_toxic_segments")
def toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query("op7_simhash_groups")
def simhash_groups(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_groups(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op1_substring_dedup")
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out, removed, total = substring.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col(removed).alias("removed_sentences"), F.col(total).alias("sentences"))


@query("op2_quality_mil")
def quality_mil(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return mil.score(docs, mil.fit(docs, table(spark, folder, "labels")))


@query("op4_language_filters")
def language_filters(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.identify(docs, langid.fit(docs))


@query("op6_html_density")
def html_density(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query("op9_imatch")
def imatch_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, folder, "documents"))


@query(
    "op11_warc_archives",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
    g AS (SELECT payload, max(page_id) AS original FROM p WHERE strlen(payload) >= 1000 GROUP BY payload)
    SELECT p.page_id, CAST(strlen(p.payload) AS BIGINT) AS payload_bytes, sha1(p.payload) AS payload_digest,
           CASE WHEN g.payload IS NULL OR p.page_id IS NOT DISTINCT FROM g.original THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN p.page_id IS DISTINCT FROM g.original THEN g.original END AS refers_to
    FROM p LEFT JOIN g USING (payload)
    """,
)
def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    found = warc.outermost(written(warc.records(warc.archive(pages), content=False), "records"))
    kind = pages.schema["page_id"].dataType
    return found.filter("type IN ('response', 'revisit')").select(
        F.col("page").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by a hash of conversation and turn. Nulls in role and text become one space."""
    blank = F.lit(" ")
    named = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *named).cast("binary")) % 20
    text = F.coalesce("text", blank)
    rows = conversations.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, F.lit("")).when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, 2).otherwise(1)
    return rows.filter("fault != 0").select(
        "conv_id", "turn", role.alias("role"), text.otherwise(F.col("text")).alias("text"), F.explode(F.array_repeat(F.lit(1), times))
    )


@query("op12_conversation_repair")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations")
    facts, turns = dialogue.repair(damaged(rows))
    found = facts.join(dialogue.digests(turns).withColumnRenamed("conv", "hashed"), F.col("conv").eqNullSafe(F.col("hashed")))
    ids = rows.select("conv_id").distinct()
    out = ids.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    none = F.sha2(F.lit("").cast("binary"), 256)
    return out.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", none).alias("repaired_sha256")
    )


@query(
    "op13_phrase_collocations",
    """
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]'
        )) AS piece FROM documents),
    split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
    runs AS (
        SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
        FROM split, range(1, 5) sizes(k)),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
    cuts AS (SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS c FROM candidates),
    scored AS (
        SELECT u.lang, u.phrase, u.a, u.c, x.f AS l, y.f AS r, 2000000 * CAST(u.a AS HUGEINT) // (x.f + y.f) AS score
        FROM cuts u
        JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:u.c], ' ')
        JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[u.c + 1:u.k], ' ')),
    least AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS place FROM scored),
    parts AS (
        SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
        FROM candidates, range(2, 4) sizes(m) WHERE m < k),
    longer AS (SELECT lang, phrase, max(a) AS most FROM parts GROUP BY ALL),
    ranked AS (
        SELECT s.lang, s.phrase, s.a, s.l, s.r, n.n, CAST(s.score AS BIGINT) AS score,
               row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase) AS rank
        FROM least s JOIN n USING (lang) LEFT JOIN longer o ON o.lang = s.lang AND o.phrase = s.phrase
        WHERE place = 1 AND NOT coalesce(100 * CAST(o.most AS HUGEINT) >= 80 * CAST(s.a AS HUGEINT), false))
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocation.collocations(table(spark, folder, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)
