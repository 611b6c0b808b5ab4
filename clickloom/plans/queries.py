"""Registered queries: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.events import parse_city_events, parse_events
from clickloom.functions.rendering import city_events_text, counts_text
from clickloom.operators import counters, layout, session_filter, subtype_statistics
from clickloom.operators import vehicle_activity, vehicle_reports, word_statistics
from clickloom.operators.histogram import field_histogram as histogram
from clickloom.operators.inverted_index import header_index as build_header_index
from clickloom.operators.inverted_index import verse_index as build_verse_index
from clickloom.operators.sessionize import SEGMENT_EVENTS, sessionize
from clickloom.operators.word_count import sorted_by_word
from clickloom.operators.word_count import word_count as count_words
from clickloom.plans import bindings

Query = Callable[[SparkSession, str], DataFrame]
CITY_KEYS = ["user_id", "city"]

# Parameters of registered queries that their SQL counterparts repeat.
SMALL_SESSION_EVENTS = 60
SHORT_SEGMENT_EVENTS = 20
SHORT_SEGMENT_POSTINGS = 500


# --- words -----------------------------------------------------------------


def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_words(bindings.paragraphs(spark, sf_dir), F.col("line"))


def word_count_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_by_word(word_count(spark, sf_dir))


def word_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.word_counters(bindings.paragraphs(spark, sf_dir), F.col("line"))


def paragraph_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.paragraphs(spark, sf_dir)
    return word_statistics.paragraph_words(lines, F.col("line"), ["doc_id", "line_no"])


def word_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_statistics.word_statistics(bindings.paragraphs(spark, sf_dir), F.col("line"))


def word_stats_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_statistics.word_statistics_full(bindings.paragraphs(spark, sf_dir), F.col("line"))


def paragraph_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = word_statistics.paragraph_lengths(bindings.paragraphs(spark, sf_dir), F.col("line"))
    return word_statistics.finish(word_statistics.partial_states(lengths))


# --- indexes ---------------------------------------------------------------


def verse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_verse_index(bindings.verses(spark, sf_dir), F.col("value"))


def verse_index_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bindings.verses(spark, sf_dir)
    return build_verse_index(lines, F.col("value"), segment_size=SHORT_SEGMENT_POSTINGS)


def header_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_header_index(bindings.emails(spark, sf_dir), F.col("value"))


# --- click log -------------------------------------------------------------


def field_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(bindings.click_log(spark, sf_dir))


def parsed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(bindings.click_log(spark, sf_dir))
    return events.withColumn("features", F.array_join("features", ":"))


def events_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["user_id", "city", "event_timestamp", "event_type", "vin"]
    return layout.union_events(
        bindings.click_log(spark, sf_dir).select(*columns), bindings.order_log(spark, sf_dir)
    )


def _delivered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = bindings.click_log(spark, sf_dir)
    return layout.union_events(log, bindings.redelivered(log))


def _session_rows(sessions: DataFrame) -> DataFrame:
    """Sessions with their events as text, for comparison by value."""

    def text(e):
        missing = F.lit("-")
        coded = [e["event_type"], e["event_subtype"], e["condition"], e["body_style"], e["cab_style"]]
        plain = [e[c] for c in ("city", "vin", "year", "make", "model", "trim")]
        numbers = [e[c].cast("string") for c in ("price", "mileage", "free_carfax_report")]
        return F.concat_ws(
            "|",
            e["event_time"],
            *[F.coalesce(c, missing) for c in coded + plain + numbers],
            F.array_join(e["features"], ":"),
        )

    return sessions.select(
        "user_id",
        "segment",
        "session_events",
        F.array_join(F.transform("events", text), " ; ").alias("events"),
    )


def _user_sessions(
    spark: SparkSession, sf_dir: str, distinct: bool, segment_events: int = SEGMENT_EVENTS
) -> DataFrame:
    events = parse_events(_delivered_log(spark, sf_dir))
    return sessionize(events, ["user_id"], distinct=distinct, segment_events=segment_events)


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_rows(_user_sessions(spark, sf_dir, True))


def user_sessions_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_rows(_user_sessions(spark, sf_dir, False))


def user_session_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _session_rows(_user_sessions(spark, sf_dir, False, SHORT_SEGMENT_EVENTS))


def large_session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(bindings.click_log(spark, sf_dir))
    return _session_rows(sessionize(events, ["user_id"], max_events=SMALL_SESSION_EVENTS))


# --- city (user and day) sessions ------------------------------------------


def _city_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_city_events(_delivered_log(spark, sf_dir))


def _city_rows(sessions: DataFrame) -> DataFrame:
    return sessions.withColumn("events", city_events_text(F.col("events"))).drop(
        "has_contact_form", "has_click", "has_view"
    )


def user_day_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_rows(session_filter.city_sessions(_city_events(spark, sf_dir), ordered=True))


def shower_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _city_rows(session_filter.sampled_city_sessions(_city_events(spark, sf_dir)))


def session_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_filter.city_session_metrics(_city_events(spark, sf_dir))


def city_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = session_filter.sampled_city_sessions(_city_events(spark, sf_dir))
    return _city_rows(layout.city_partitions(sessions))


# --- session types and statistics ------------------------------------------


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_filter.session_profiles(
        parse_events(bindings.click_log(spark, sf_dir)), CITY_KEYS
    )


def _small_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_filter.drop_large_sessions(_profiles(spark, sf_dir))


def session_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _small_profiles(spark, sf_dir).select(*CITY_KEYS, "session_events", "session_type")


def session_type_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_filter.session_type_tally(_small_profiles(spark, sf_dir))


def session_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = session_filter.sample_sessions(_small_profiles(spark, sf_dir), CITY_KEYS)
    return kept.select(*CITY_KEYS, "session_events", "session_type")


def filter_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return session_filter.filter_counters(_profiles(spark, sf_dir), CITY_KEYS)


def subtype_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtype_statistics.subtype_statistics(_small_profiles(spark, sf_dir))


def subtype_stats_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subtype_statistics.subtype_statistics_any(_small_profiles(spark, sf_dir))


# --- vehicles --------------------------------------------------------------


def vin_user_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = vehicle_activity.vehicle_users(parse_events(bindings.click_log(spark, sf_dir)))
    return users.withColumn("clicks", counts_text(F.col("clicks")))


def vin_impressions_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = vehicle_activity.vehicle_impressions(
        parse_events(bindings.click_log(spark, sf_dir)), bindings.impressions(spark, sf_dir)
    )
    return joined.withColumn("clicks", counts_text(F.col("clicks")))


def _one_listing_per_vin(
    spark: SparkSession, sf_dir: str, nonzero: str, columns: list[str] | None = None
) -> DataFrame:
    """One row per vehicle, of the given columns only."""
    lines = bindings.vehicle_lines(spark, sf_dir, nonzero)
    return vehicle_reports.one_per_key(lines.select(columns or lines.columns), "vin")


def distinct_vin(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Make and model depend on the vehicle alone, so they are looked up for
    # one row per vehicle and not for every line.
    rows = _one_listing_per_vin(spark, sf_dir, "l_extendedprice")
    return bindings.with_make_and_model(spark, sf_dir, rows)


def price_by_make_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _one_listing_per_vin(spark, sf_dir, "l_extendedprice", ["vin", "price"])
    listed = bindings.with_make_and_model(spark, sf_dir, rows)
    report = vehicle_reports.price_by_make_model(listed)
    return report.select(
        "make",
        "model",
        F.col("min_price").cast("bigint").alias("min_price"),
        F.col("max_price").cast("bigint").alias("max_price"),
        F.col("avg_price").cast("double").alias("avg_price"),
    )


def mileage_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _one_listing_per_vin(spark, sf_dir, "l_quantity", ["vin", "year", "mileage"])
    report = vehicle_reports.mileage_by_year(rows)
    return report.select(
        "year",
        F.col("min_mileage").cast("bigint").alias("min_mileage"),
        F.col("max_mileage").cast("bigint").alias("max_mileage"),
        F.col("avg_mileage").cast("double").alias("avg_mileage"),
    )


def vin_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vehicle_reports.vehicle_event_counts(bindings.vehicle_lines(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "word_count": word_count,
    "word_count_sorted": word_count_sorted,
    "word_counters": word_counters,
    "paragraph_words": paragraph_words,
    "word_stats": word_stats,
    "word_stats_full": word_stats_full,
    "paragraph_length": paragraph_length,
    "verse_index": verse_index,
    "verse_index_segments": verse_index_segments,
    "header_index": header_index,
    "field_histogram": field_histogram,
    "parsed_events": parsed_events,
    "events_union": events_union,
    "user_sessions": user_sessions,
    "user_sessions_with_duplicates": user_sessions_with_duplicates,
    "user_session_segments": user_session_segments,
    "large_session_filter": large_session_filter,
    "user_day_sessions": user_day_sessions,
    "shower_sample": shower_sample,
    "session_metrics": session_metrics,
    "city_partitions": city_partitions,
    "session_types": session_types,
    "session_type_tally": session_type_tally,
    "session_sample": session_sample,
    "filter_counters": filter_counters,
    "subtype_stats": subtype_stats,
    "subtype_stats_any": subtype_stats_any,
    "vin_user_stats": vin_user_stats,
    "vin_impressions_join": vin_impressions_join,
    "distinct_vin": distinct_vin,
    "price_by_make_model": price_by_make_model,
    "mileage_by_year": mileage_by_year,
    "vin_event_counts": vin_event_counts,
}
