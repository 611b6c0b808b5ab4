"""Text renderings of records for the delimited sinks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def statistics_text(count: Column, mean: Column, variance: Column) -> Column:
    """``count,mean,variance``."""
    return F.concat_ws(",", count.cast("string"), mean.cast("string"), variance.cast("string"))


def city_event_text(event: Column) -> Column:
    """``<type:subtype,time>``; the VIN is left out."""
    return F.format_string(
        "<%s:%s,%s>", event["event_type"], event["event_subtype"], event["event_time"]
    )


def city_events_text(events: Column) -> Column:
    return F.array_join(F.transform(events, city_event_text), ", ")


def posting_map_text(postings: Column) -> Column:
    """Values of a posting map joined by spaces."""
    return F.array_join(F.map_values(postings), " ")


def counts_text(counts: Column) -> Column:
    """``key=value`` pairs of a count map, joined by commas in key order."""
    pairs = F.sort_array(F.map_entries(counts))
    return F.array_join(
        F.transform(pairs, lambda p: F.concat(p["key"], F.lit("="), p["value"].cast("string"))),
        ",",
    )
