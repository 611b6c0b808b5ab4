import pytest
from pyspark.sql import functions as F

from clickloom.functions.hashing import city_bucket, string_hash
from clickloom.operators.layout import by_user_and_city, city_partitions, union_events


def model_hash(text):
    value = 0
    units = text.encode("utf-16-be")
    for i in range(0, len(units), 2):
        value = (value * 31 + (units[i] << 8 | units[i + 1])) & 0xFFFFFFFF
    return value - (1 << 32) if value >= 1 << 31 else value


@pytest.mark.parametrize(
    "text", ["", "Austin", "San Francisco", "null", "München", "東京", "a😀b", "polygenelubricants"]
)
def test_hash(spark, text):
    got = spark.createDataFrame([(text,)], "c string").select(string_hash(F.col("c"))).first()[0]
    assert got == model_hash(text)


def test_bucket_of_null_and_of_the_smallest_hash(spark):
    df = spark.createDataFrame([(None,), ("null",), ("polygenelubricants",)], "c string")
    buckets = [r[0] for r in df.select(city_bucket(F.col("c"))).collect()]
    assert buckets[0] == buckets[1] == abs(model_hash("null")) % 6
    assert model_hash("polygenelubricants") == -(1 << 31)
    assert buckets[2] == (1 << 31) % 6


@pytest.fixture
def sessions(spark):
    rows = [(f"u{i % 7}", c, 0) for i, c in enumerate(["Austin", "Waco", None, "El Paso"] * 10)]
    return spark.createDataFrame(rows, "user_id string, city string, segment long").distinct()


def test_total_order(sessions):
    got = [(r["user_id"], r["city"] or "") for r in by_user_and_city(sessions).collect()]
    assert got == sorted(got)


def test_partitions_are_sorted_and_whole(sessions):
    placed = city_partitions(sessions).withColumn("task", F.spark_partition_id())
    rows = placed.collect()
    assert len(rows) == sessions.count()
    by_task = {}
    for r in rows:
        by_task.setdefault(r["task"], []).append((r["city_bucket"], r["user_id"], r["city"] or ""))
    assert all(keys == sorted(keys) for keys in by_task.values())
    assert all(r["city_bucket"] == abs(model_hash(r["city"] or "null")) % 6 for r in rows)


def test_union_matches_columns_by_name(spark):
    first = spark.createDataFrame([("a", 1)], "x string, y int")
    second = spark.createDataFrame([(1, "a")], "y int, x string")
    assert [tuple(r) for r in union_events(first, second).collect()] == [("a", 1), ("a", 1)]
