"""File writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.hashing import CITY_BUCKETS, city_bucket

# Marks rows for counting as they are written.
Counted = Callable[[DataFrame], DataFrame]


def _as_is(df: DataFrame) -> DataFrame:
    return df


def _texts(df: DataFrame) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(c) for c in df.columns]


def write_tab_separated(df: DataFrame, path: str) -> None:
    """One ``key<TAB>value...`` line per row."""
    df.select(F.concat_ws("\t", *_texts(df)).alias("value")).write.text(path)


def write_tuples(df: DataFrame, path: str) -> None:
    """One ``(key,value...)`` line per row, in the row order of ``df``."""
    line = F.concat(F.lit("("), F.concat_ws(",", *_texts(df)), F.lit(")"))
    df.select(line.alias("value")).write.text(path)


def write_records(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Nested records. ``fmt="avro"`` needs the Avro connector on the class path."""
    df.write.format(fmt).save(path)


def write_routed(
    df: DataFrame, path: str, by: str = "session_type", fmt: str = "parquet"
) -> None:
    """One output folder per value of ``by``, with as many files as its bytes need.

    Rows are rebalanced by value: adaptive execution splits a large value over
    several tasks and lets small ones share a task, so the number of files does
    not grow with the number of tasks that read.
    """
    df.hint("rebalance", F.col(by)).write.partitionBy(by).format(fmt).save(path)


def write_csv(
    df: DataFrame, path: str, keys: list[str], single_file: bool = False, counted: Counted = _as_is
) -> None:
    """CSV in key order, in part files that follow each other in name order.

    ``single_file`` puts the whole report through one task; it is meant for
    reports that are known to be small. ``counted`` marks the rows for counting
    behind the sort.
    """
    rows = df.repartition(1).sortWithinPartitions(*keys) if single_file else df.orderBy(*keys)
    counted(rows).write.csv(path)


def _by_city_bucket(sessions: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Rows range-partitioned by bucket and key, so that many tasks share a large city."""
    order = ["city_bucket", *keys]
    placed = sessions.withColumn("city_bucket", city_bucket(F.col("city"), buckets))
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)


def write_city_buckets(
    sessions: DataFrame,
    path: str,
    keys: list[str],
    buckets: int = CITY_BUCKETS,
    counted: Counted = _as_is,
) -> None:
    """One folder per city bucket, each holding files sorted by session key."""
    rows = counted(_by_city_bucket(sessions, keys, buckets))
    rows.write.partitionBy("city_bucket").parquet(path)


def write_city_tuples(
    sessions: DataFrame,
    path: str,
    keys: list[str],
    value: str,
    buckets: int = CITY_BUCKETS,
    counted: Counted = _as_is,
) -> None:
    """The same folders as text, a line ``((key,...),[value])`` per row.

    ``value`` is a text column. Lines of one city stand in key order.
    """
    key = F.concat(F.lit("("), F.concat_ws(",", *_texts(sessions.select(*keys))), F.lit(")"))
    line = F.concat(F.lit("("), key, F.lit(",["), F.col(value), F.lit("])"))
    rows = counted(_by_city_bucket(sessions, [*keys, "segment"], buckets))
    rows.select("city_bucket", line.alias("value")).write.partitionBy("city_bucket").text(path)
