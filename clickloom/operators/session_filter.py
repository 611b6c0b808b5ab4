"""Session profiles, the large-session filter, classification and sampling."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions.sessions import (
    NO_RULE,
    SAMPLE_RATES,
    SHOWER_RATE,
    TYPE_RULES,
    is_shower,
    keep_fraction,
    sample_rate,
    session_type_by_flags,
    session_type_of,
    session_type_over,
    shower_flags,
    type_flags,
)
from clickloom.operators.sessionize import CITY_EVENT_FIELDS, SEGMENT_EVENTS, sessionize
from clickloom.schemas import EVENT_SUBTYPES

# Fixed value: sessions with more events than this are dropped.
MAX_EVENTS = 100


def session_profiles(events: DataFrame, keys: list[str]) -> DataFrame:
    """One row per session from event rows: length, type and subtype counts.

    Every column is a mergeable aggregate, so a session of any length costs
    one small state per task; no session is gathered.
    """
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("session_events"),
        session_type_over(F.col("event_type")).alias("session_type"),
        *[F.count_if(F.col("event_subtype") == s).alias(s) for s in EVENT_SUBTYPES],
    )


def typed_sessions(
    events: DataFrame,
    keys: list[str],
    distinct: bool = True,
    segment_events: int = SEGMENT_EVENTS,
    unobserved: DataFrame | None = None,
) -> DataFrame:
    """Sorted sessions with ``session_type``.

    The type is that of the whole session on each of its rows, however many
    there are: its flags are gathered beside the events.
    """
    flags = type_flags()
    sessions = sessionize(
        events,
        keys,
        distinct=distinct,
        segment_events=segment_events,
        any_of=flags,
        unobserved=unobserved,
    )
    return sessions.withColumn("session_type", session_type_by_flags()).drop(*flags)


def classify_sessions(sessions: DataFrame, max_events: int | None = None) -> DataFrame:
    """Add ``session_type`` to nested sessions without a shuffle.

    Stored sessions that bring their type keep it. Others are typed by their
    events; sessions of more than ``max_events`` events, if given, get none. A
    session that was written in several rows has one type for all of them, which
    a row alone cannot tell: such a row raises an error.
    """
    if "session_type" in sessions.columns:
        return sessions
    split = F.size("events") < F.col("session_events")
    message = F.lit("a session split over several rows has no type by row")
    kind = F.when(split, F.raise_error(message).cast("string")).otherwise(session_type_of(F.col("events")))
    if max_events is not None:
        kind = F.when(F.col("session_events") <= max_events, kind)
    return sessions.withColumn("session_type", kind)


def nested_profiles(sessions: DataFrame, keys: list[str]) -> DataFrame:
    """Profiles of small nested sessions, computed inside each row."""

    def count_of(subtype: str) -> Column:
        held = F.filter("events", lambda event: event["event_subtype"] == subtype)
        return F.size(held).cast("bigint").alias(subtype)

    return classify_sessions(sessions).select(
        *keys, "session_events", "session_type", *[count_of(s) for s in EVENT_SUBTYPES]
    )


def drop_large_sessions(sessions: DataFrame, max_events: int = MAX_EVENTS) -> DataFrame:
    """Keep sessions of at most ``max_events`` events."""
    if max_events > SEGMENT_EVENTS:
        raise ValueError(f"max_events is at most {SEGMENT_EVENTS}, the size of one session row")
    return sessions.filter(F.col("session_events") <= max_events)


def sample_sessions(
    sessions: DataFrame,
    keys: list[str],
    rates: Mapping[str, float] = SAMPLE_RATES,
    seed: int = 0,
) -> DataFrame:
    """Keep a share of the sessions of each type given in ``rates``."""
    rate = sample_rate(F.col("session_type"), rates)
    return sessions.filter(keep_fraction(rate, *keys, seed=seed))


def session_type_tally(profiles: DataFrame) -> DataFrame:
    return profiles.groupBy("session_type").agg(F.count(F.lit(1)).alias("sessions"))


def filter_counters(
    profiles: DataFrame,
    keys: list[str],
    max_events: int = MAX_EVENTS,
    rates: Mapping[str, float] = SAMPLE_RATES,
    seed: int = 0,
) -> DataFrame:
    """One row: sessions seen, large ones discarded, sampled-out ones per type."""
    return profiles.agg(
        F.count(F.lit(1)).alias("sessions"),
        *[c.alias(name) for name, c in discards(keys, max_events, rates, seed).items()],
    )


def discards(
    keys: list[str],
    max_events: int = MAX_EVENTS,
    rates: Mapping[str, float] = SAMPLE_RATES,
    seed: int = 0,
    once: Column | None = None,
) -> dict[str, Column]:
    """Aggregates over typed sessions: large ones, and those sampled out per type.

    ``once`` is true for one row of each session.
    """
    kind = F.col("session_type")
    large = F.col("session_events") > max_events
    kept = keep_fraction(sample_rate(kind, rates), *keys, seed=seed)
    once = F.lit(True) if once is None else once
    return {
        "large_discards": F.count_if(once & large),
        **{f"{name}_discards": F.count_if(once & ~large & (kind == name) & ~kept) for name in rates},
    }


def type_tallies(prefix: str) -> dict[str, Column]:
    """Aggregates over typed session rows: sessions of each type, a long one once."""
    first = F.col("segment") == 0
    return {
        f"{prefix}_{name}": F.count_if(first & (F.col("session_type") == name))
        for name in (*[name for name, _ in TYPE_RULES], NO_RULE)
    }


def city_sessions(
    events: DataFrame,
    segment_events: int = SEGMENT_EVENTS,
    keep: Column | None = None,
    unobserved: DataFrame | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Sessions per user and city with the flags of the SHOWER test.

    ``keep``, a condition on user, city and flags, chooses sessions before
    their events are gathered. ``ordered`` gives them by user and city.
    """
    return sessionize(
        events,
        ["user_id", "city"],
        CITY_EVENT_FIELDS,
        segment_events=segment_events,
        any_of=shower_flags(),
        keep=keep,
        unobserved=unobserved,
        ordered=ordered,
    )


def _kept(rate: float, seed: int) -> Column:
    return ~is_shower() | keep_fraction(rate, "user_id", "city", seed=seed)


def sample_showers(
    sessions: DataFrame, rate: float = SHOWER_RATE, seed: int = 0
) -> DataFrame:
    """Of stored city sessions, keep a share of the SHOWER ones and every other one."""
    return sessions.filter(_kept(rate, seed))


def sampled_city_sessions(
    events: DataFrame,
    rate: float = SHOWER_RATE,
    seed: int = 0,
    segment_events: int = SEGMENT_EVENTS,
    unobserved: DataFrame | None = None,
) -> DataFrame:
    """The same sample from event rows; sessions left out are never gathered."""
    return city_sessions(events, segment_events, _kept(rate, seed), unobserved)


def city_session_metrics(
    events: DataFrame, rate: float = SHOWER_RATE, seed: int = 0
) -> DataFrame:
    """One row of five totals around the SHOWER sample."""
    keys = ["user_id", "city"]
    flags = shower_flags()
    n = F.col("session_events")
    kept = ~F.col("shower") | keep_fraction(rate, *keys, seed=seed)
    sessions = (
        events.select(*keys, *CITY_EVENT_FIELDS)
        .dropDuplicates()
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("session_events"),
            *[F.bool_or(F.coalesce(c, F.lit(False))).alias(name) for name, c in flags.items()],
        )
        .select(*keys, "session_events", is_shower().alias("shower"))
    )
    return sessions.select("session_events", "shower", kept.alias("kept")).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("events_before"),
        F.coalesce(F.sum(F.when(F.col("kept"), n)), F.lit(0)).alias("events_after"),
        F.count(F.lit(1)).alias("sessions"),
        F.count_if("shower").alias("shower_sessions"),
        F.count_if(F.col("shower") & ~F.col("kept")).alias("shower_dropped"),
    )
