"""The corpus pipeline: documents in, tokenized clean documents out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its
predecessor kept; its result is written as Parquet and read again. All but the
last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import bpe, decontaminate, id_filter, language_id, pseudonyms, simhash_dedup
from clickloom.llm.queries import VOCABULARY
from clickloom.plans.bindings import table
from clickloom.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not rejected.

    NULL and empty texts, and texts without a letter, have no language and go.
    Repeated rows are judged alike, an empty table stays empty, and other columns
    are carried along.
    """
    return language_id.keep_identified(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document with the smallest id.

    Documents without an id are in no group and stay. Where rows share an id,
    each is judged by its own text, and of those in one group one stays. NULL
    and empty texts are near duplicates of each other. An empty table stays
    empty; other columns are carried along, whatever their names.
    """
    named = docs.filter(F.col("doc_id").isNotNull())
    found = written(simhash_dedup.near_duplicates(named, with_root=True))
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.min("component_id").alias("component_id"))
    shared, copy = F.col("n") > 1, F.col("doc_id") != F.col("component_id")
    judged = written(ids.filter(shared | copy).select("doc_id", shared.alias("shared")))
    kept = id_filter.without_ids(docs, "doc_id", judged, "doc_id")
    several = written(judged.filter("shared").select(F.col("doc_id").alias("shared_id")))
    if several.isEmpty():
        return kept
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.join(several, F.col("doc_id") == F.col("shared_id"), "left_semi")
    rows = written(rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("version"), row.alias("row")))
    prints = simhash_dedup.fingerprints(rows.select("version", "text").dropDuplicates(["version"]), "version")
    first = found.join(several, F.col("doc_id") == F.col("shared_id"), "left_semi")
    first = first.filter(F.col("doc_id") == F.col("component_id")).select("doc_id", "fp", "root").distinct()
    one = rows.drop("text").join(prints, "version").join(first, ["doc_id", "fp"]).dropDuplicates(["doc_id", "root"])
    return kept.unionByName(one.select("row.*"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    NULL and empty texts hold none, nor does any text where there are no items.
    Repeated rows are judged alike, an empty table stays empty, and other columns
    are carried along.
    """
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal numbers and dates; formats keep lengths.

    All rows stay, NULL and empty texts as they are; ``n_chars`` follows the text
    and is NULL with it. Other columns are carried along, whatever their names.
    """
    changed = pseudonyms.pseudonymize(docs).select(docs.columns)
    return changed.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else changed


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id`` with the number of tokens and the digests of ids and decoded text.

    One row per row; NULL and empty texts have no tokens. Other columns are not read.
    """
    return bpe.token_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_languages),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("personal_data", without_personal_data),
    ("tokens", tokenized),
]

# Models and permutations are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
