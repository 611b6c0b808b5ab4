"""File readers. Every reader takes one path or several of the same format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.events import click_log_columns
from clickloom.schemas import IMPRESSION_SCHEMA, VEHICLE_COLUMNS

Paths = str | list[str]


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """Text lines in a single column ``value``."""
    return spark.read.text(paths)


def read_click_log(spark: SparkSession, paths: Paths) -> DataFrame:
    """Tab-separated click log as 16 text columns.

    Lines are split as text, not as CSV: a quote is an ordinary character and
    a blank field in mid-line stays a blank.
    """
    return click_log_columns(read_lines(spark, paths), F.col("value"))


def read_impressions(spark: SparkSession, paths: Paths) -> DataFrame:
    """Marketplace impressions: ``vin, kind, n``."""
    return spark.read.csv(paths, schema=IMPRESSION_SCHEMA)


def read_vehicles(spark: SparkSession, paths: Paths) -> DataFrame:
    """Vehicle events from CSV without a header option; header lines are dropped."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in VEHICLE_COLUMNS])
    rows = spark.read.csv(paths, schema=schema)
    header = F.col("price").eqNullSafe("price") & F.col("mileage").eqNullSafe("mileage")
    return rows.filter(~header)


def read_records(spark: SparkSession, paths: Paths, fmt: str = "parquet") -> DataFrame:
    """Nested records. ``fmt="avro"`` needs the Avro connector on the class path."""
    return spark.read.format(fmt).load(paths)
