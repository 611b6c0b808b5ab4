"""The registered corpus queries: registration, SQL, and their intended tables."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from clickloom.llm import queries
from compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_registration():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert [name.split("_")[0] for name in queries.QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLE[name]) is None


def test_languages_of_held_out_documents(spark):
    rows = queries.op2_language_id(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in held)
    assert held and right >= 0.97 * len(held)


def test_quality_keeps_trusted_documents(spark):
    rows = {r.doc_id: r.keep for r in queries.op6_quality(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good = [rows[r.doc_id] for r in labels if r.quality == 1]
    bad = [rows[r.doc_id] for r in labels if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) < 0.6 * len(bad)
