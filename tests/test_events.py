import pytest
from pyspark.sql import functions as F

from clickloom.functions.events import click_log_columns, parse_city_events, parse_events
from clickloom.operators.histogram import field_histogram
from clickloom.operators.sessionize import session_events, sessionize
from clickloom.schemas import CLICK_LOG_COLUMNS

BASE = {
    "user_id": "u1",
    "event_type": "edit contact form",
    "event_timestamp": "2015-01-01 10:00:00",
    "city": "Austin",
    "vin": "V1",
    "vehicle_condition": "Used",
    "year": "2010",
    "make": "Ford",
    "model": "F-150",
    "trim": "XL",
    "body_style": "Pickup",
    "cab_style": "Crew Cab",
    "price": "12000.5",
    "mileage": "900",
    "free_carfax_report": "f",
    "features": "sunroof:abs",
}


def line(**changes):
    return "\t".join({**BASE, **changes}[c] for c in CLICK_LOG_COLUMNS)


@pytest.fixture
def log(lines):
    def make(*texts):
        return click_log_columns(lines(*texts), F.col("value"))

    return make


def test_typed_event(log):
    row = parse_events(log(line())).first().asDict()
    assert row == {
        "user_id": "u1",
        "event_time": "2015-01-01 10:00:00",
        "event_type": "EDIT",
        "event_subtype": "CONTACT_FORM",
        "city": "Austin",
        "vin": "V1",
        "condition": "Used",
        "year": "2010",
        "make": "Ford",
        "model": "F-150",
        "trim": "XL",
        "body_style": "Pickup",
        "cab_style": "Crew",
        "price": 12000.5,
        "mileage": 900,
        "free_carfax_report": False,
        "features": ["abs", "sunroof"],
    }


def test_unknown_and_bad_values(log):
    text = line(
        event_type="poke thing",
        vehicle_condition="used",
        body_style="Truck",
        cab_style="",
        price="n/a",
        mileage="",
        free_carfax_report="t",
        features="",
    )
    row = parse_events(log(text)).first()
    for name in ("event_type", "event_subtype", "condition", "body_style", "cab_style", "price", "mileage"):
        assert row[name] is None, name
    assert row["free_carfax_report"] is True
    assert row["features"] == []


@pytest.mark.parametrize(
    "compound, kind, subtype",
    [
        ("show badge detail", "SHOW", "BADGE_DETAIL"),
        ("visit alternative", "VISIT", "ALTERNATIVE"),
        ("change contact form extra", "CHANGE", "CONTACT_FORM"),
        ("click", "CLICK", None),
    ],
)
def test_compound_event(log, compound, kind, subtype):
    row = parse_events(log(line(event_type=compound))).first()
    assert (row["event_type"], row["event_subtype"]) == (kind, subtype)


def test_city_event_keeps_text(log):
    row = parse_city_events(log(line(event_type="change contact form extra"))).first()
    assert (row["event_type"], row["event_subtype"]) == ("change", "contact form extra")


def test_histogram(log):
    got = {
        r["pair"]: r["count"]
        for r in field_histogram(
            log(line(), line(trim="", features="abs::"), line(features="abs"), line(features=""))
        ).collect()
    }
    assert got["make:Ford"] == 4
    assert got["event_type:edit contact form"] == 4
    assert got["trim:"] == 1 and got["trim:XL"] == 3
    assert got["feature:abs"] == 3 and got["feature:sunroof"] == 1
    assert "feature:" not in got
    skipped = ("user_id:", "vin:", "price:", "mileage:", "event_timestamp:", "features:")
    assert not [p for p in got if p.startswith(skipped)]


def test_short_line_gives_only_present_fields(log):
    got = {r["pair"] for r in field_histogram(log("u1\tshow badges\t2015\tAustin\t\t\t")).collect()}
    assert got == {"event_type:show badges", "city:Austin"}


def test_sessions_sort_and_drop_copies(log):
    first = line(event_type="show badges")
    texts = [
        line(event_timestamp="2015-01-02"),
        first,
        line(event_type="click badges"),
        first,  # equal to the second, another event between them
        line(event_type="show features"),
        line(user_id="u2"),
    ]
    events = parse_events(log(*texts))
    got = {r["user_id"]: r for r in sessionize(events, ["user_id"]).collect()}
    assert got["u1"]["session_events"] == 4
    assert [(e["event_time"][:10], e["event_type"], e["event_subtype"]) for e in got["u1"]["events"]] == [
        ("2015-01-01", "CLICK", "BADGES"),
        ("2015-01-01", "SHOW", "BADGES"),
        ("2015-01-01", "SHOW", "FEATURES"),
        ("2015-01-02", "EDIT", "CONTACT_FORM"),
    ]
    copies = {r["user_id"]: r for r in sessionize(events, ["user_id"], distinct=False).collect()}
    assert copies["u1"]["session_events"] == 5
    assert copies["u2"]["session_events"] == 1


def test_segments_hold_the_whole_session(log):
    texts = [line(event_timestamp=f"2015-01-{d:02d}") for d in range(1, 12)] + [line(user_id="u2")]
    events = parse_events(log(*texts))
    sessions = sessionize(events, ["user_id"], segment_events=4)
    assert sorted((r["user_id"], r["segment"], len(r["events"])) for r in sessions.collect()) == [
        ("u1", 0, 4),
        ("u1", 1, 4),
        ("u1", 2, 3),
        ("u2", 0, 1),
    ]
    assert session_events(sessions, ["user_id"]).select(*events.columns).exceptAll(events).count() == 0
    assert session_events(sessions, ["user_id"]).count() == events.count()
