"""Unions, ordering and placement of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.hashing import CITY_BUCKETS, city_bucket


def union_events(first: DataFrame, second: DataFrame) -> DataFrame:
    """All rows of both sources, columns matched by name."""
    return first.unionByName(second)


def by_user_and_city(sessions: DataFrame) -> DataFrame:
    """Total order by user, then city, then segment."""
    return sessions.orderBy("user_id", "city", "segment")


def city_partitions(sessions: DataFrame, buckets: int = CITY_BUCKETS) -> DataFrame:
    """Place sessions by city bucket, sorted by user and city inside each.

    Buckets are split by range over the tasks: six tasks could not hold the
    data, and one city may be large.
    """
    order = ["city_bucket", "user_id", "city", "segment"]
    placed = sessions.withColumn("city_bucket", city_bucket(F.col("city"), buckets))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)
