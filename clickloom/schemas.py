"""Record layouts and value domains shared by the operators."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of one click-log line, in file order.
CLICK_LOG_COLUMNS = (
    "user_id",
    "event_type",
    "event_timestamp",
    "city",
    "vin",
    "vehicle_condition",
    "year",
    "make",
    "model",
    "trim",
    "body_style",
    "cab_style",
    "price",
    "mileage",
    "free_carfax_report",
    "features",
)

# The columns of one vehicle CSV line, in file order.
VEHICLE_COLUMNS = (
    "userID",
    "event",
    "timestamp",
    "vin",
    "condition",
    "year",
    "make",
    "model",
    "price",
    "mileage",
)

# The domains of the coded event fields. Event types are in
# alphabetical order, so ordering by name is ordering by code.
EVENT_TYPES = ("CHANGE", "CLICK", "DISPLAY", "EDIT", "SHOW", "SUBMIT", "VISIT")
EVENT_SUBTYPES = (
    "ALTERNATIVE",
    "BADGE_DETAIL",
    "BADGES",
    "CONTACT_BANNER",
    "CONTACT_BUTTON",
    "CONTACT_FORM",
    "DEALER_PHONE",
    "FEATURES",
    "GET_DIRECTIONS",
    "MARKET_REPORT",
    "PHOTO_MODAL",
    "VEHICLE_HISTORY",
)
CONDITIONS = ("New", "Used", "CPO")
BODY_STYLES = (
    "Chassis",
    "Convertible",
    "Coupe",
    "Hatchback",
    "Minivan",
    "Pickup",
    "SUV",
    "Sedan",
    "Van",
    "Wagon",
)
CAB_STYLES = ("Crew", "Extended", "Regular")

IMPRESSION_SCHEMA = "vin string, kind string, n long"

# One event inside a session. Time and type come first because sorting the
# structs then is the session order: by time, then type, then everything else.
EVENT_STRUCT = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_subtype", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("vin", T.StringType()),
        T.StructField("condition", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("make", T.StringType()),
        T.StructField("model", T.StringType()),
        T.StructField("trim", T.StringType()),
        T.StructField("body_style", T.StringType()),
        T.StructField("cab_style", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("mileage", T.LongType()),
        T.StructField("free_carfax_report", T.BooleanType()),
        T.StructField("features", T.ArrayType(T.StringType())),
    ]
)
EVENT_FIELDS = tuple(EVENT_STRUCT.fieldNames())

# One stored session row. A session longer than the segment size is stored as
# several rows, numbered by ``segment``; ``session_events`` is the length of
# the whole session on each of them.
SESSION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("segment", T.LongType()),
        T.StructField("session_events", T.LongType()),
        T.StructField("events", T.ArrayType(EVENT_STRUCT)),
    ]
)
