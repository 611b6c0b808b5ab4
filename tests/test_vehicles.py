from decimal import Decimal

import pytest

from clickloom.functions.rendering import counts_text
from clickloom.operators.vehicle_activity import impression_totals, vehicle_impressions, vehicle_users
from clickloom.operators.vehicle_reports import (
    listed,
    mileage_by_year,
    one_per_key,
    price_by_make_model,
    vehicle_event_counts,
)


@pytest.fixture
def events(spark):
    rows = [
        ("u1", "v1", "CLICK", "BADGES"),
        ("u1", "v1", "CLICK", "BADGES"),
        ("u1", "v1", "CLICK", "FEATURES"),
        ("u2", "v1", "CLICK", "BADGES"),
        ("u2", "v1", "EDIT", "CONTACT_FORM"),
        ("u2", "v1", "EDIT", "CONTACT_FORM"),
        ("u3", "v1", "SHOW", "CONTACT_FORM"),
        ("u3", "v2", "EDIT", "BADGES"),
        ("u3", None, "CLICK", "BADGES"),
    ]
    return spark.createDataFrame(
        rows, "user_id string, vin string, event_type string, event_subtype string"
    )


@pytest.fixture
def impressions(spark):
    rows = [("v1", "SRP", 5), ("v1", "VDP", 2), ("v1", "SRP", 1), ("v1", "x", 4), ("v9", "SRP", 7)]
    return spark.createDataFrame(rows, "vin string, kind string, n long")


def test_users_per_vehicle(events):
    got = {r["vin"]: r for r in vehicle_users(events).collect()}
    assert set(got) == {"v1", "v2"}
    assert got["v1"]["unique_users"] == 3
    assert got["v1"]["edit_contact_form"] == 1
    assert got["v1"]["clicks"] == {"BADGES": 2, "FEATURES": 1}
    assert got["v2"]["clicks"] == {}
    assert got["v2"]["edit_contact_form"] == 0


def test_left_join_with_impressions(events, impressions):
    got = {r["vin"]: r for r in vehicle_impressions(events, impressions).collect()}
    assert set(got) == {"v1", "v2"}  # v9 has impressions only
    assert (got["v1"]["marketplace_srps"], got["v1"]["marketplace_vdps"]) == (6, 6)
    assert (got["v2"]["marketplace_srps"], got["v2"]["marketplace_vdps"]) == (0, 0)
    totals = {r["vin"]: tuple(r)[1:] for r in impression_totals(impressions).collect()}
    assert totals == {"v1": (6, 6), "v9": (7, 0)}


def test_click_map_text(events):
    row = vehicle_users(events).filter("vin = 'v1'").select(counts_text("clicks")).first()
    assert row[0] == "BADGES=2,FEATURES=1"


COLUMNS = "userID string, event string, timestamp string, vin string, condition string, " \
    "year string, make string, model string, price string, mileage string"


@pytest.fixture
def vehicles(spark):
    rows = [
        ("u2", "show badges", "t", "v1", "Used", "2001", "Ford", "F", "10.5", "100"),
        ("u1", "click badges", "t", "v1", "Used", "2001", "Ford", "F", "30", "0"),
        ("u1", "show badges", "t", "v2", "New", "2001", "Ford", "F", "0", "50"),
        ("u1", "show badges", "t", "v3", "New", "2002", "Ford", "F", "2.5", ""),
        ("u1", "show", "t", "v4", "New", "2002", "Kia", "K", None, "x"),
        ("u1", "price", "t", "v5", "New", "2002", "Kia", "K", "price", "mileage"),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def test_price_report(vehicles):
    rows = one_per_key(listed(vehicles, "price"), "vin")
    assert sorted((r["vin"], r["userID"]) for r in rows.collect()) == [("v1", "u1"), ("v3", "u1")]
    assert [tuple(r) for r in price_by_make_model(rows).collect()] == [
        ("Ford", "F", Decimal(3), Decimal(30), Decimal("16.5000"))
    ]


def test_mileage_report(vehicles):
    rows = one_per_key(listed(vehicles, "mileage"), "vin")
    assert [tuple(r) for r in mileage_by_year(rows).collect()] == [
        ("2001", Decimal(50), Decimal(100), Decimal("75.0000"))
    ]


def test_event_counts_use_every_row(vehicles):
    got = [tuple(r) for r in vehicle_event_counts(vehicles).collect()]
    assert got == [
        ("v1", "click", 1),
        ("v1", "show", 1),
        ("v2", "show", 1),
        ("v3", "show", 1),
        ("v4", "show", 1),
        ("v5", "price", 1),
    ]
