import pytest
from pyspark.sql import functions as F

from clickloom.functions.rendering import city_events_text
from clickloom.functions.sessions import keep_fraction
from clickloom.operators import session_filter, subtype_statistics
from clickloom.operators.session_filter import (
    classify_sessions,
    city_session_metrics,
    city_sessions,
    drop_large_sessions,
    filter_counters,
    nested_profiles,
    sample_sessions,
    sample_showers,
    session_profiles,
    session_type_tally,
)
from clickloom.operators.sessionize import sessionize
from clickloom.schemas import EVENT_SUBTYPES

EVENT = "user_id string, event_time string, event_type string, event_subtype string"
FIELDS = ("event_time", "event_type", "event_subtype")


@pytest.fixture
def events(spark):
    def make(sessions):
        rows = [
            (user, f"t{i:04d}", kind, subtype)
            for user, items in sessions.items()
            for i, (kind, subtype) in enumerate(items)
        ]
        return spark.createDataFrame(rows, EVENT)

    return make


def kinds(*names):
    return [(n, "BADGES") for n in names]


TYPED = {
    "submitter1": kinds("VISIT", "CLICK", "CHANGE"),
    "submitter2": kinds("EDIT"),
    "submitter3": kinds("SHOW", "SUBMIT", "CLICK"),
    "clicker1": kinds("SHOW", "CLICK", "VISIT"),
    "shower1": kinds("VISIT", "DISPLAY"),
    "shower2": kinds("SHOW"),
    "visitor1": kinds("VISIT"),
    "other1": kinds(None),
}


def test_types_agree_in_both_forms(events):
    flat = events(TYPED)
    for df in (
        session_profiles(flat, ["user_id"]),
        classify_sessions(sessionize(flat, ["user_id"], FIELDS)),
    ):
        for row in df.collect():
            assert row["session_type"] == row["user_id"].rstrip("0123456789"), row["user_id"]


def test_session_without_events_is_other(spark):
    empty = spark.sql(
        "SELECT 'u' AS user_id, 0L AS session_events, "
        "CAST(array() AS array<struct<event_type:string,event_subtype:string>>) AS events"
    )
    assert classify_sessions(empty).first()["session_type"] == "other"


def test_large_session_boundary(events):
    flat = events({"at100": kinds(*["SHOW"] * 100), "at101": kinds(*["SHOW"] * 101)})
    sessions = sessionize(flat, ["user_id"], FIELDS, distinct=False)
    assert [r["user_id"] for r in drop_large_sessions(sessions).collect()] == ["at100"]
    assert drop_large_sessions(sessions, 101).count() == 2
    with pytest.raises(ValueError):
        drop_large_sessions(sessions, 10_001)


def test_sampling_keeps_a_stable_subset(spark):
    users = spark.range(20_000).select(
        F.col("id").cast("string").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "clicker")
        .when(F.col("id") % 4 == 1, "shower")
        .otherwise("visitor")
        .alias("session_type"),
    )
    kept = sample_sessions(users, ["user_id"])
    counts = {r["session_type"]: r["count"] for r in kept.groupBy("session_type").count().collect()}
    assert counts["visitor"] == 5_000
    assert 900 < counts["clicker"] < 1_100
    assert 60 < counts["shower"] < 140
    again = sample_sessions(users.repartition(7), ["user_id"])
    assert kept.exceptAll(again).count() == 0 and again.count() == kept.count()
    other = sample_sessions(users, ["user_id"], seed=1)
    assert other.exceptAll(kept).count() > 0
    assert kept.exceptAll(users).count() == 0


def test_sampling_extremes(spark):
    users = spark.range(100).select(F.col("id").cast("string").alias("user_id"))
    assert users.filter(keep_fraction(1.0, "user_id")).count() == 100
    assert users.filter(keep_fraction(0.0, "user_id")).count() == 0


def test_filter_counters(events):
    flat = events({**TYPED, "big": kinds(*["SHOW"] * 101)})
    row = filter_counters(session_profiles(flat, ["user_id"]), ["user_id"], rates={"clicker": 0.0, "shower": 1.0}).first()
    assert row.asDict() == {
        "sessions": 9,
        "large_discards": 1,
        "clicker_discards": 1,
        "shower_discards": 0,
    }


def test_tally(events):
    got = {r[0]: r[1] for r in session_type_tally(session_profiles(events(TYPED), ["user_id"])).collect()}
    assert got == {"submitter": 3, "clicker": 1, "shower": 2, "visitor": 1, "other": 1}


SUBTYPED = {
    "a": [("CLICK", "BADGES"), ("CLICK", "BADGES"), ("SHOW", "FEATURES")],
    "b": [("CLICK", "FEATURES")],
    "c": [("SHOW", "BADGES")],
    "d": [(None, "BADGES")],
}


def test_subtype_statistics(events):
    flat = events(SUBTYPED)
    nested = nested_profiles(sessionize(flat, ["user_id"], FIELDS), ["user_id"])
    for profiles in (session_profiles(flat, ["user_id"]), nested):
        got = {
            (r["session_type"], r["event_subtype"]): tuple(r)[2:]
            for r in subtype_statistics.subtype_statistics_any(profiles).collect()
        }
        assert len(got) == 3 * len(EVENT_SUBTYPES)
        assert got["CLICKER", "BADGES"] == (2, 2, 4, 1.0, 1.0)
        assert got["CLICKER", "FEATURES"] == (2, 2, 2, 1.0, 0.0)
        assert got["CLICKER", "PHOTO_MODAL"] == (2, 0, 0, 0.0, 0.0)
        assert got["SHOWER", "BADGES"] == (1, 1, 1, 1.0, 0.0)
        # ``other`` sessions take no part in ANY.
        assert got["ANY", "BADGES"][:3] == (3, 3, 5)
        plain = subtype_statistics.subtype_statistics(profiles)
        assert plain.count() == 2 * len(EVENT_SUBTYPES)


@pytest.fixture
def city_events(spark):
    rows = [
        # user, city, time, type, subtype, vin
        ("u1", "A", "t2", "show", "badges", "v"),
        ("u1", "A", "t1", "visit", "badges", "v"),
        ("u1", "A", "t1", "visit", "badges", "v"),  # copy
        ("u1", "A", "t1", "visit", "badges", "w"),  # other vehicle: kept
        ("u1", "B", "t1", "click", "badges", "v"),
        ("u1", "B", "t2", "show", "badges", "v"),
        ("u2", "A", "t1", "show", "contact form", "v"),
        ("u2", None, "t1", "display", "badges", "v"),
        ("u3", "A", "t1", "visit", "badges", "v"),
    ]
    return spark.createDataFrame(
        rows, "user_id string, city string, event_time string, event_type string, event_subtype string, vin string"
    )


def test_city_sessions(city_events):
    sessions = city_sessions(city_events)
    got = {
        (r["user_id"], r["city"]): r["text"]
        for r in sessions.withColumn("text", city_events_text(F.col("events"))).collect()
    }
    assert got["u1", "A"] == "<visit:badges,t1>, <visit:badges,t1>, <show:badges,t2>"
    assert got["u1", "B"] == "<click:badges,t1>, <show:badges,t2>"
    assert len(got) == 5
    none = sample_showers(sessions, rate=0.0)
    assert sorted((r["user_id"], r["city"] or "") for r in none.collect()) == [
        ("u1", "B"),
        ("u2", "A"),
        ("u3", "A"),
    ]
    assert sample_showers(sessions, rate=1.0).count() == 5


@pytest.mark.parametrize("rate, after, dropped", [(0.0, 4, 2), (1.0, 8, 0)])
def test_city_metrics(city_events, rate, after, dropped):
    assert city_session_metrics(city_events, rate=rate).first().asDict() == {
        "events_before": 8,
        "events_after": after,
        "sessions": 5,
        "shower_sessions": 2,
        "shower_dropped": dropped,
    }


def test_city_flags_cover_all_segments(city_events):
    """A session cut into segments keeps its whole-session flags on each."""
    whole = {(r["user_id"], r["city"]): r["has_click"] for r in city_sessions(city_events).collect()}
    cut = city_sessions(city_events, segment_events=1).collect()
    assert len(cut) == 8
    assert all(r["has_click"] == whole[r["user_id"], r["city"]] for r in cut)


def test_defaults():
    assert session_filter.MAX_EVENTS == 100


def test_a_split_session_is_not_typed_by_row(spark):
    rows = [("u", 30, [("show", "x")] * 20)]
    split = spark.createDataFrame(
        rows, "user_id string, session_events long, events array<struct<event_type:string,event_subtype:string>>"
    )
    with pytest.raises(Exception, match="no type by row"):
        classify_sessions(split).collect()


@pytest.mark.parametrize("rate", [0.0, 0.5, 1.0])
@pytest.mark.parametrize("segment_events", [1, 10_000])
def test_sampling_before_gathering_keeps_the_same_sessions(city_events, rate, segment_events):
    after = sample_showers(city_sessions(city_events, segment_events), rate=rate)
    before = session_filter.sampled_city_sessions(city_events, rate, segment_events=segment_events)
    assert before.columns == after.columns
    assert sorted(map(str, before.collect())) == sorted(map(str, after.collect()))


@pytest.mark.parametrize("distinct", [True, False])
def test_sessions_over_a_size_are_left_out_whole(spark, distinct):
    rows = [(user, f"t{i % n}", "SHOW") for user, n, rows in
            [("few", 2, 2), ("copies", 2, 9), ("edge", 3, 3), ("many", 9, 9), (None, 2, 2), (None, 2, 5)]
            for i in range(rows)]
    events = spark.createDataFrame(rows, "user_id string, event_time string, event_type string")
    fields = ("event_time", "event_type")
    every = sessionize(events, ["user_id"], fields, distinct=distinct)
    few = sessionize(events, ["user_id"], fields, distinct=distinct, max_events=3)
    expected = every.filter(F.col("session_events") <= 3)
    assert few.columns == every.columns
    assert sorted(map(str, few.collect())) == sorted(map(str, expected.collect()))
    assert few.count() == (4 if distinct else 2)
    with pytest.raises(ValueError):
        sessionize(events, ["user_id"], fields, segment_events=2, max_events=3)
