"""Per-vehicle user activity, and its left join with marketplace impressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.schemas import EVENT_SUBTYPES

# Fixed value: the impression kind counted as a search-result impression;
# every other kind counts as a vehicle-page impression.
SEARCH_RESULT = "SRP"


def user_vehicle_flags(events: DataFrame) -> DataFrame:
    """Per user and vehicle: which subtypes were clicked, and a contact-form edit.

    Clicked subtypes are bits of one number, which merges by OR.
    """
    clicked = F.lit(0)
    for bit, subtype in enumerate(EVENT_SUBTYPES):
        clicked = F.when(F.col("event_subtype") == subtype, F.lit(1 << bit)).otherwise(clicked)
    is_click = F.col("event_type") == "CLICK"
    is_edit = (F.col("event_type") == "EDIT") & (F.col("event_subtype") == "CONTACT_FORM")
    return (
        events.filter(F.col("vin").isNotNull())
        .groupBy("user_id", "vin")
        .agg(
            F.bit_or(F.when(is_click, clicked).otherwise(0)).alias("clicked"),
            F.max(F.when(is_edit, 1).otherwise(0)).cast("bigint").alias("edited"),
        )
    )


def vehicle_users(events: DataFrame) -> DataFrame:
    """``vin, unique_users, edit_contact_form, clicks``: users per vehicle.

    ``clicks`` maps a subtype to the number of users who clicked it.
    """
    flags = user_vehicle_flags(events)
    per_vin = flags.groupBy("vin").agg(
        F.count(F.lit(1)).alias("unique_users"),
        F.sum("edited").alias("edit_contact_form"),
        *[
            F.count_if(F.col("clicked").bitwiseAND(F.lit(1 << bit)) != 0).alias(s)
            for bit, s in enumerate(EVENT_SUBTYPES)
        ],
    )
    entries = F.array_compact(
        F.array(
            *[
                F.when(F.col(s) > 0, F.struct(F.lit(s).alias("key"), F.col(s).alias("value")))
                for s in EVENT_SUBTYPES
            ]
        )
    )
    return per_vin.select(
        "vin", "unique_users", "edit_contact_form", F.map_from_entries(entries).alias("clicks")
    )


def impression_totals(impressions: DataFrame) -> DataFrame:
    """``vin, marketplace_srps, marketplace_vdps``."""
    n = F.col("n")
    is_search = F.col("kind").eqNullSafe(SEARCH_RESULT)
    return impressions.groupBy("vin").agg(
        F.sum(F.when(is_search, n).otherwise(0)).alias("marketplace_srps"),
        F.sum(F.when(~is_search, n).otherwise(0)).alias("marketplace_vdps"),
    )


def vehicle_impressions(events: DataFrame, impressions: DataFrame) -> DataFrame:
    """Activity of every vehicle users saw, with its impressions or zeros.

    Both sides hold one row per vehicle before the join, so a vehicle with
    very many events or impressions does not skew it.
    """
    joined = vehicle_users(events).join(impression_totals(impressions), "vin", "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "vin",
        "unique_users",
        "clicks",
        "edit_contact_form",
        F.coalesce("marketplace_srps", zero).alias("marketplace_srps"),
        F.coalesce("marketplace_vdps", zero).alias("marketplace_vdps"),
    )
