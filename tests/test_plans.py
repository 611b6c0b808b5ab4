"""Shapes of the physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from clickloom.operators import session_filter
from clickloom.plans.queries import QUERIES
from clickloom.schemas import SESSION_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
# Queries whose result is one row of totals gather partial totals in one task.
TOTALS = {"word_counters", "session_metrics", "filter_counters", "paragraph_length"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return re.findall(r"Exchange (\w+)", text)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_products_no_single_task(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text
    if name not in TOTALS:
        assert "SinglePartition" not in text


def test_word_statistics_shuffle_words_only(spark):
    text = plan(QUERIES["word_stats_full"](spark, SF_DIR))
    by_key = [s for s in re.findall(r"Exchange hashpartitioning\((\w+)#", text) if s != "doc_id"]
    assert by_key == ["word"]


def test_sessions_take_one_shuffle(spark):
    assert shuffles(plan(QUERIES["user_sessions"](spark, SF_DIR))) == ["hashpartitioning"]


def test_session_types_read_few_columns(spark):
    text = plan(QUERIES["session_types"](spark, SF_DIR))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in text
    assert shuffles(text) == ["hashpartitioning"]


def test_routing_of_stored_sessions_has_no_shuffle(spark, tmp_path):
    path = str(tmp_path / "sessions")
    spark.createDataFrame([], SESSION_SCHEMA).write.parquet(path)
    small = session_filter.drop_large_sessions(spark.read.parquet(path))
    routed = session_filter.sample_sessions(session_filter.classify_sessions(small), ["user_id"])
    text = plan(routed)
    assert "Exchange" not in text
    assert "LessThanOrEqual(session_events,100)" in text


def test_duplicate_vehicles_merge_before_the_shuffle(spark):
    text = plan(QUERIES["mileage_by_year"](spark, SF_DIR))
    assert "Window" not in text and "partial_min" in text


def test_crowded_keys_read_the_key_only(spark, monkeypatch):
    from clickloom.operators import groups

    seen, write = [], groups.written
    monkeypatch.setattr(groups, "written", lambda df: seen.append(plan(df)) or write(df))
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").select("user_id", "event_type", "value")
    groups.ordered_groups(rows, ["user_id"], F.col("value"), distinct=True, segment_size=10_000)
    assert "ReadSchema: struct<user_id:bigint>" in seen[0] and "Sample" in seen[0]


@pytest.mark.parametrize("name", ["verse_index_segments", "user_session_segments", "header_index", "verse_index"])
def test_groups_derive_and_shuffle_their_rows_once(spark, monkeypatch, name):
    """All else that reads the input reads a sample; only sorted pieces are written."""
    from clickloom.operators import groups

    seen, write = [], groups.written
    monkeypatch.setattr(groups, "written", lambda df: seen.append(plan(df)) or write(df))
    result = plan(QUERIES[name](spark, SF_DIR))
    full = [text for text in [*seen, result] if SF_DIR in text and "Sample" not in text]
    assert len(full) == 1 and "collect_" in full[0]
    assert [s for s in shuffles(full[0]) if "Broadcast" not in s] == ["hashpartitioning"]


def test_ordered_sessions_are_gathered_in_range_order(spark):
    """The range shuffle carries events; the gathered arrays stay where they are."""
    text = plan(QUERIES["user_day_sessions"](spark, SF_DIR))
    assert shuffles(text) == ["rangepartitioning"]
    assert text.index("collect_set") < text.index("Exchange rangepartitioning")


def test_mileage_report_reads_its_own_columns(spark):
    text = plan(QUERIES["mileage_by_year"](spark, SF_DIR))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert {c.split(":")[0] for c in schema.split(",")} == {"l_partkey", "l_quantity", "l_shipdate"}
    assert re.search(r"PushedFilters: \[[^\]]*l_quantity[^\]]*0", text)


@pytest.mark.parametrize("name", ["large_session_filter", "shower_sample", "city_partitions"])
def test_sessions_are_chosen_before_they_are_gathered(spark, name):
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    gather = re.search(r"collect_(set|list)", text).start()
    assert "Filter" not in text[:gather].replace("Filter isnotnull", "")
