"""Histogram of ``field:value`` pairs of a click log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.events import feature_items
from clickloom.schemas import CLICK_LOG_COLUMNS

# Fields left out, and the one field that is a list.
SKIPPED = ("event_timestamp", "mileage", "price", "user_id", "vin")
LIST_FIELD = "features"
LIST_PREFIX = "feature:"


def field_values(log: DataFrame) -> DataFrame:
    """One ``pair`` row per field value; fields missing from a line give none."""
    fields = [c for c in CLICK_LOG_COLUMNS if c not in SKIPPED and c != LIST_FIELD]
    single = F.array(*[F.concat(F.lit(f"{c}:"), F.col(c)) for c in fields])
    listed = F.transform(feature_items(F.col(LIST_FIELD)), lambda f: F.concat(F.lit(LIST_PREFIX), f))
    return log.select(F.explode(F.concat(F.array_compact(single), listed)).alias("pair"))


def field_histogram(log: DataFrame) -> DataFrame:
    """``pair, count``."""
    return field_values(log).groupBy("pair").agg(F.count(F.lit(1)).alias("count"))
