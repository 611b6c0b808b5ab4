"""Sessions: all events of a key, sorted, as nested records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators.groups import ordered_groups
from clickloom.schemas import EVENT_FIELDS

# A session longer than this is stored as several rows.
SEGMENT_EVENTS = 10_000

# Sort and identity fields of an event in a city session.
CITY_EVENT_FIELDS = ("event_time", "event_type", "event_subtype", "vin")


def sessionize(
    events: DataFrame,
    keys: list[str],
    fields: tuple[str, ...] = EVENT_FIELDS,
    *,
    distinct: bool = True,
    segment_events: int = SEGMENT_EVENTS,
    any_of: Mapping[str, Column] | None = None,
    keep: Column | None = None,
    max_events: int | None = None,
    unobserved: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Sorted sessions: ``keys, segment, session_events, flags, events``.

    Events sort by time, then type, then the remaining fields. ``distinct``
    drops events equal in every field. Sessions that fail ``keep``, a condition
    on keys and flags, or have more than ``max_events`` events are never gathered.
    ``unobserved`` and ``ordered`` are those of ``ordered_groups``.
    """
    groups = ordered_groups(
        events,
        keys,
        F.struct(*fields),
        distinct=distinct,
        segment_size=segment_events,
        any_of=any_of,
        keep=keep,
        max_items=max_events,
        unobserved=unobserved,
        ordered=ordered,
    )
    return groups.withColumnsRenamed({"group_size": "session_events", "items": "events"})


def session_events(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Event rows of stored sessions."""
    events = sessions.select(*keys, F.explode("events").alias("event"))
    fields = [f for f in sessions.schema["events"].dataType.elementType.names if f not in keys]
    return events.select(*keys, *[F.col(f"event.{f}").alias(f) for f in fields])
