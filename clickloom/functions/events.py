"""Parsing of click-log fields into typed event columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import (
    BODY_STYLES,
    CAB_STYLES,
    CLICK_LOG_COLUMNS,
    CONDITIONS,
    EVENT_SUBTYPES,
    EVENT_TYPES,
)


def one_of(value: Column, domain: Iterable[str]) -> Column:
    """The value when it belongs to the domain, else NULL."""
    return F.when(value.isin(*domain), value)


def click_log_columns(lines: DataFrame, text: Column) -> DataFrame:
    """The 16 click-log columns of tab-separated lines; trailing blanks are NULL.

    The split array is a column of its own, so a line is split once however
    many fields a query reads.
    """
    fields = F.split(F.regexp_replace(text, r"\t++$", ""), r"\t")
    return lines.select(fields.alias("fields")).select(
        *[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(CLICK_LOG_COLUMNS)]
    )


def event_type(compound: Column) -> Column:
    """``edit contact form`` -> ``EDIT``; unknown types are NULL."""
    return one_of(F.upper(F.substring_index(compound, " ", 1)), EVENT_TYPES)


def event_subtype(compound: Column) -> Column:
    """``edit contact form`` -> ``CONTACT_FORM`` from words two and three."""
    words = F.slice(F.split(compound, " "), 2, 2)
    return one_of(F.upper(F.array_join(words, "_")), EVENT_SUBTYPES)


def split_compound(compound: Column) -> tuple[Column, Column]:
    """First word and remaining text of a compound event, as written."""
    words = F.split(compound, " ", 2)
    return F.get(words, 0), F.get(words, 1)


def feature_items(features: Column) -> Column:
    """Non-empty ``:``-separated features in file order; none for NULL."""
    return F.coalesce(
        F.array_remove(F.split(features, ":"), ""), F.array().cast("array<string>")
    )


def parse_events(log: DataFrame) -> DataFrame:
    """Typed events, one row each, from the 16 text columns of a click log."""
    col = F.col
    return log.select(
        "user_id",
        col("event_timestamp").alias("event_time"),
        event_type(col("event_type")).alias("event_type"),
        event_subtype(col("event_type")).alias("event_subtype"),
        "city",
        "vin",
        one_of(col("vehicle_condition"), CONDITIONS).alias("condition"),
        "year",
        "make",
        "model",
        "trim",
        one_of(col("body_style"), BODY_STYLES).alias("body_style"),
        one_of(F.substring_index(col("cab_style"), " ", 1), CAB_STYLES).alias("cab_style"),
        col("price").try_cast("double").alias("price"),
        col("mileage").try_cast("bigint").alias("mileage"),
        (col("free_carfax_report") != "f").alias("free_carfax_report"),
        F.sort_array(feature_items(col("features"))).alias("features"),
    )


def parse_city_events(log: DataFrame) -> DataFrame:
    """User, city, time, lower-case type, subtype text and VIN of a click log."""
    kind, subtype = split_compound(F.col("event_type"))
    return log.select(
        "user_id",
        "city",
        F.col("event_timestamp").alias("event_time"),
        kind.alias("event_type"),
        subtype.alias("event_subtype"),
        "vin",
    )
