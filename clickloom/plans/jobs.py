"""The batch jobs, from input files to output files.

``python -m clickloom.plans.jobs <job> <input>... <output>`` runs one and prints
its counters, ``name<TAB>value``, taken while the output was written.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import sinks, sources
from clickloom.functions.events import parse_city_events, parse_events
from clickloom.functions.rendering import (
    city_events_text,
    counts_text,
    posting_map_text,
    statistics_text,
)
from clickloom.operators import layout, session_filter, subtype_statistics
from clickloom.operators import vehicle_activity, vehicle_reports, word_statistics
from clickloom.operators.counters import Counters, word_counters
from clickloom.operators.histogram import field_histogram
from clickloom.operators.inverted_index import (
    header_addresses,
    header_index,
    message_postings,
    verse_index,
)
from clickloom.operators.sessionize import session_events
from clickloom.operators.word_count import sorted_by_word, word_count
from clickloom.session import build_session, drop_tables

Inputs = list[str]
Counts = dict[str, int]


def count_words(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    counts = word_count(lines, F.col("value"))
    counts = counters.rows(counts, "groups_written", words_out=F.sum("count"))
    sinks.write_tab_separated(counts, output)
    return counters.values()


def count_words_sorted(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    counts = sorted_by_word(word_count(lines, F.col("value")))
    sinks.write_tuples(counters.rows(counts, "groups_written", words_out=F.sum("count")), output)
    return counters.values()


def report_word_counters(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Lines read, words and groups written by a word count."""
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    totals = word_counters(lines, F.col("value"))
    sinks.write_tab_separated(counters.rows(totals, "rows_written"), output)
    return counters.values()


def describe_words(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Word, then ``count,mean,variance``."""
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    stats = word_statistics.word_statistics(lines, F.col("value"))
    stats = counters.rows(stats, "words_written", words_out=F.sum("document_count"))
    text = statistics_text(F.col("document_count"), F.col("mean"), F.col("variance"))
    sinks.write_tab_separated(stats.select("word", text.alias("statistics")), output)
    return counters.values()


def describe_words_fully(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    stats = word_statistics.word_statistics_full(lines, F.col("value"))
    stats = counters.rows(stats, "words_written", words_out=F.sum("document_count"))
    sinks.write_tab_separated(stats, output)
    return counters.values()


def index_emails(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Address key and its message ids in key order; a very long list takes several lines."""
    counters = Counters()
    plain = sources.read_lines(spark, inputs)
    lines = counters.rows(plain, "lines_read")
    index = header_index(lines, F.col("value"), unobserved=plain).orderBy("key", "segment")
    keys = F.count_if(F.col("segment") == 0)
    index = counters.rows(index, "rows_written", keys_written=keys)
    sinks.write_tab_separated(index.select("key", "message_ids"), output)
    return counters.values()


def list_email_postings(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Address key and the posting map of one message, for every message that names the key."""
    counters = Counters()
    lines = counters.rows(sources.read_lines(spark, inputs), "lines_read")
    postings = message_postings(header_addresses(lines, F.col("value")))
    postings = counters.rows(postings, "rows_written")
    text = posting_map_text(F.col("postings"))
    sinks.write_tab_separated(postings.select("key", text.alias("postings")), output)
    return counters.values()


def index_verses(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Word and its verses in word order; a very long list takes several lines."""
    counters = Counters()
    plain = sources.read_lines(spark, inputs)
    lines = counters.rows(plain, "lines_read")
    index = verse_index(lines, F.col("value"), unobserved=plain).orderBy("word", "segment")
    words = F.count_if(F.col("segment") == 0)
    ordered = counters.rows(index, "rows_written", words_written=words)
    verses = F.concat(F.lit("["), F.col("verses"), F.lit("]"))
    sinks.write_tuples(ordered.select("word", verses.alias("verses")), output)
    return counters.values()


def count_fields(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    counters = Counters()
    log = counters.rows(sources.read_click_log(spark, inputs), "lines_read")
    pairs = counters.rows(field_histogram(log), "pairs_written", pairs_out=F.sum("count"))
    sinks.write_tab_separated(pairs, output)
    return counters.values()


def _sessions_job(spark: SparkSession, inputs: Inputs, output: str, distinct: bool) -> Counts:
    counters = Counters()
    plain = sources.read_click_log(spark, inputs)
    log = counters.rows(plain, "lines_read")
    sessions = session_filter.typed_sessions(
        parse_events(log), ["user_id"], distinct, unobserved=parse_events(plain)
    )
    sessions = counters.rows(
        sessions,
        "rows_written",
        sessions_written=F.count_if(F.col("segment") == 0),
        events_written=F.sum(F.size("events")),
    )
    sinks.write_records(sessions, output)
    return counters.values()


def build_sessions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """One nested session per user, equal events dropped."""
    return _sessions_job(spark, inputs, output, True)


def build_sessions_with_duplicates(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    return _sessions_job(spark, inputs, output, False)


def join_impressions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """First input: nested sessions. The others: impression CSV files."""
    counters = Counters()
    sessions = counters.rows(sources.read_records(spark, inputs[0]), "session_rows_read")
    events = session_events(sessions, ["user_id"])
    shown = counters.rows(sources.read_impressions(spark, inputs[1:]), "impression_lines_read")
    joined = counters.rows(vehicle_activity.vehicle_impressions(events, shown), "vehicles_written")
    sinks.write_tab_separated(joined.withColumn("clicks", counts_text(F.col("clicks"))), output)
    return counters.values()


def _typed_sessions(spark: SparkSession, inputs: Inputs, counters: Counters) -> DataFrame:
    """Stored sessions with their type; large ones are not yet dropped."""
    sessions = sources.read_records(spark, inputs)
    typed = session_filter.classify_sessions(sessions, session_filter.MAX_EVENTS)
    # A long session takes several rows; its first one stands for it.
    return counters.rows(typed, None, sessions_read=F.count_if(F.col("segment") == 0))


def filter_sessions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Classify, sample and route sessions, with the discards of each kind."""
    counters, keys = Counters(), ["user_id"]
    typed = _typed_sessions(spark, inputs, counters)
    typed = counters.rows(typed, None, **session_filter.discards(keys, once=F.col("segment") == 0))
    kept = session_filter.sample_sessions(session_filter.drop_large_sessions(typed), keys)
    kept = counters.rows(kept, "rows_written", **session_filter.type_tallies("written"))
    sinks.write_routed(kept, output)
    return counters.values()


def bin_sessions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Classify and route every small session, without sampling, with a tally of the types."""
    counters = Counters()
    small = session_filter.drop_large_sessions(_typed_sessions(spark, inputs, counters))
    small = counters.rows(small, "rows_written", **session_filter.type_tallies("written"))
    sinks.write_routed(small, output)
    return counters.values()


def report_filter_counters(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Sessions read, and discarded as large or by sampling, in a session filter."""
    counters = Counters()
    typed = _typed_sessions(spark, inputs, counters).filter(F.col("segment") == 0)
    sinks.write_tab_separated(session_filter.filter_counters(typed, ["user_id"]), output)
    return counters.values()


def describe_sessions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Subtype statistics per session type and over all of them."""
    counters = Counters()
    small = session_filter.drop_large_sessions(_typed_sessions(spark, inputs, counters))
    small = counters.rows(small, None, **session_filter.type_tallies("described"))
    profiles = session_filter.nested_profiles(small, ["user_id"])
    stats = counters.rows(subtype_statistics.subtype_statistics_any(profiles), "rows_written")
    sinks.write_tab_separated(stats, output)
    return counters.values()


def _city_events(spark: SparkSession, inputs: Inputs) -> DataFrame:
    logs = [parse_city_events(sources.read_click_log(spark, p)) for p in inputs]
    return reduce(layout.union_events, logs)


def _city_rows(spark: SparkSession, inputs: Inputs, counters: Counters) -> DataFrame:
    plain = _city_events(spark, inputs)
    sessions = session_filter.sampled_city_sessions(
        counters.rows(plain, "lines_read"), unobserved=plain
    )
    events = city_events_text(F.col("events")).alias("events")
    return sessions.select("user_id", "city", "segment", "session_events", events)


def _city_counts(counters: Counters) -> sinks.Counted:
    first = F.col("segment") == 0
    return lambda rows: counters.rows(
        rows,
        "rows_written",
        sessions_written=F.count_if(first),
        events_written=F.sum(F.when(first, F.col("session_events"))),
    )


def build_city_sessions(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Sampled user and city sessions, one folder per city bucket."""
    counters = Counters()
    rows = _city_rows(spark, inputs, counters)
    keys = ["user_id", "city", "segment"]
    sinks.write_city_buckets(rows, output, keys, counted=_city_counts(counters))
    return counters.values()


def write_city_session_tuples(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """The same sessions as text: ``((user,city),[<type:subtype,time>, ...])`` lines."""
    counters = Counters()
    rows = _city_rows(spark, inputs, counters)
    keys, counted = ["user_id", "city"], _city_counts(counters)
    sinks.write_city_tuples(rows, output, keys, "events", counted=counted)
    return counters.values()


def report_city_metrics(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Events and sessions before and after the sample of city sessions."""
    counters = Counters()
    events = counters.rows(_city_events(spark, inputs), "lines_read")
    metrics = session_filter.city_session_metrics(events)
    sinks.write_tab_separated(metrics, output)
    return counters.values()


def report_vehicles(spark: SparkSession, inputs: Inputs, output: str) -> Counts:
    """Three CSV reports: prices, mileage, events per vehicle."""
    counters = Counters()
    rows = sources.read_vehicles(spark, inputs)
    # The row of a vehicle is chosen by what its report reads; make and model
    # belong to the vehicle.
    priced = vehicle_reports.listed(rows, "price").select("vin", "make", "model", "price")
    driven = vehicle_reports.listed(rows, "mileage").select("vin", "year", "mileage")
    prices = vehicle_reports.price_by_make_model(
        vehicle_reports.one_per_key(priced, "vin", ["price"])
    )
    mileage = vehicle_reports.mileage_by_year(
        vehicle_reports.one_per_key(driven, "vin", ["year", "mileage"])
    )
    events = vehicle_reports.vehicle_event_counts(counters.rows(rows, "lines_read"))
    reports = (
        (prices, "make_model", ["make", "model"]),
        (mileage, "year", ["year"]),
        (events, "vin", ["vin", "event"]),
    )
    for report, name, keys in reports:
        counted = partial(counters.rows, name=f"{name}_rows_written")
        sinks.write_csv(report, f"{output}/{name}", keys, counted=counted)
    return counters.values()


JOBS: dict[str, Callable[[SparkSession, Inputs, str], Counts]] = {
    "word-count": count_words,
    "word-count-sorted": count_words_sorted,
    "word-counters": report_word_counters,
    "word-statistics": describe_words,
    "word-statistics-full": describe_words_fully,
    "email-index": index_emails,
    "email-postings": list_email_postings,
    "verse-index": index_verses,
    "field-histogram": count_fields,
    "user-sessions": build_sessions,
    "user-sessions-with-duplicates": build_sessions_with_duplicates,
    "vehicle-impressions": join_impressions,
    "session-filter": filter_sessions,
    "session-bins": bin_sessions,
    "session-filter-counters": report_filter_counters,
    "session-statistics": describe_sessions,
    "city-sessions": build_city_sessions,
    "city-session-tuples": write_city_session_tuples,
    "city-session-metrics": report_city_metrics,
    "vehicle-reports": report_vehicles,
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clickloom")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("inputs", nargs="+", help="input paths")
    parser.add_argument("output", help="output folder")
    args = parser.parse_args(argv)
    spark = build_session(f"clickloom-{args.job}")
    try:
        for name, value in JOBS[args.job](spark, args.inputs, args.output).items():
            print(f"{name}\t{value}")
    finally:
        drop_tables(spark)


if __name__ == "__main__":
    main()
