"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bit_sliced_topk,
    bpe,
    decontaminate,
    hard_negatives,
    language_id,
    lexical_search,
    pseudonyms,
    quality_lm,
    simhash_dedup,
    token_counts,
    toxicity_chain,
    url_rules,
    warc,
)
from clickloom.plans.bindings import table
from clickloom.session import tables_folder

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "word_bpe_49k.json"
COUNTED_VOCABULARY = "byte_bpe_50k.json"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages through ARC and WARC archives and back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc.page_archive(pages, f"{tables_folder(spark)}/archives-{uuid.uuid4().hex}")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.learn_from_documents(docs))
    return found.select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other rows of every fiftieth embedding."""
    vectors = table(spark, sf_dir, "embeddings")
    return bit_sliced_topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url; pages of low-quality documents train the mined rules."""
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("blocked")
    )
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), labels)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under a model of the well-labelled ones."""
    trusted = table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return quality_lm.judge_quality(table(spark, sf_dir, "documents"), trusted)


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal numbers and dates replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities of the toxicity categories of every document."""
    return toxicity_chain.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_dedup.fingerprint_text().alias("fingerprint"), "component_id")


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth embedding; every seventh row has the next label."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return token_counts.count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path(COUNTED_VOCABULARY)
    )


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_language_id": op2_language_id,
    "op3_bpe": op3_bpe,
    "op4_top_k": op4_top_k,
    "op5_url_rules": op5_url_rules,
    "op6_quality": op6_quality,
    "op7_pseudonyms": op7_pseudonyms,
    "op8_toxicity": op8_toxicity,
    "op9_simhash": op9_simhash,
    "op10_decontaminate": op10_decontaminate,
    "op11_lexical_search": op11_lexical_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_counts": op13_token_counts,
}

ORACLE: dict[str, str] = {
    "op4_top_k": """
        WITH usable AS (
            SELECT vec_id, embedding FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND vec_id NOT IN (
                SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
                WHERE vec_id IS NOT NULL AND (x IS NULL OR NOT isfinite(x)))
        ),
        part AS (
            SELECT vec_id, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
            FROM usable, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i)
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
            FROM part q JOIN part c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0
            GROUP BY q.vec_id, c.vec_id
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
              FROM scored)
        WHERE rank <= 5
    """,
    "op1_warc": """
        WITH payload AS (
            SELECT page_id, coalesce(html, '') AS html, url FROM pages
        ),
        sized AS (
            SELECT *, strlen(html) AS n, sha1(html) AS digest,
                   max(page_id) OVER (PARTITION BY html) AS kept
            FROM payload
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND page_id <> kept THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> kept THEN kept END AS refers_to,
               url AS target_uri, '2024-02-29T23:59:59Z' AS warc_date, true AS digest_ok
        FROM sized
    """,
    "op11_lexical_search": r"""
        WITH doc AS (
            SELECT row_number() OVER () AS r, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
        ),
        posting AS (
            SELECT r, doc_id, term, count(*) AS tf FROM (
                SELECT r, doc_id, unnest(regexp_extract_all(text,
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc)
            GROUP BY r, doc_id, term
        ),
        sized AS (SELECT r, CAST(sum(tf) AS BIGINT) AS n FROM posting GROUP BY r),
        totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sized),
        holders AS (SELECT term, count(*) AS df FROM posting GROUP BY term),
        asked AS (
            SELECT item_id, term, count(*) AS times FROM (
                SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM (SELECT DISTINCT item_id, text FROM benchmark))
            GROUP BY item_id, term
        ),
        scored AS (
            SELECT item_id, r, doc_id, CAST(sum(
                times * CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT)
                * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total)))) AS BIGINT) AS score
            FROM asked JOIN posting USING (term) JOIN holders USING (term) JOIN sized USING (r) CROSS JOIN totals
            GROUP BY item_id, r, doc_id
        )
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
              FROM scored WHERE score > 0)
        WHERE rank <= 10
    """,
    "op12_hard_negatives": """
        WITH usable AS (
            SELECT vec_id, embedding, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND vec_id NOT IN (
                SELECT vec_id FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings)
                WHERE vec_id IS NOT NULL AND (x IS NULL OR NOT isfinite(x)))
        ),
        part AS (
            SELECT vec_id, label, i, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
            FROM usable, LATERAL (SELECT unnest(range(1, len(embedding) + 1)) AS i)
        ),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
            FROM part a JOIN part c ON a.i = c.i AND a.vec_id <> c.vec_id
            WHERE a.vec_id % 50 = 0
            GROUP BY a.vec_id, c.vec_id, a.label, c.label
        ),
        positive AS (
            SELECT * FROM (
                SELECT anchor_id, vec_id AS positive_id, score AS positive_score, CAST(row_number() OVER (
                       PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
                FROM scored WHERE same)
            WHERE positive_rank <= 5
        ),
        fit AS (
            SELECT anchor_id, positive_id, positive_rank, positive_score, s.vec_id AS negative_id,
                   s.score AS negative_score, CAST(row_number() OVER (
                   PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
            FROM positive JOIN scored s USING (anchor_id)
            WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
        )
        SELECT * FROM fit WHERE rank <= 3
    """,
}
