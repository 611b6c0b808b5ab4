"""Session classification and reproducible sampling expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event types that decide a session's type, strongest first.
TYPE_RULES = (
    ("submitter", ("CHANGE", "EDIT", "SUBMIT")),
    ("clicker", ("CLICK",)),
    ("shower", ("SHOW", "DISPLAY")),
    ("visitor", ("VISIT",)),
)
NO_RULE = "other"

# Share of sessions kept per type; other types are kept whole.
SAMPLE_RATES = {"clicker": 0.10, "shower": 0.02}
SHOWER_RATE = 0.10

_HASH_RANGE = 1 << 32


def _first_match(flags: Mapping[str, Column]) -> Column:
    chosen = F.lit(NO_RULE)
    for name, _ in reversed(TYPE_RULES):
        chosen = F.when(flags[name], F.lit(name)).otherwise(chosen)
    return chosen


def session_type_of(events: Column) -> Column:
    """Type of a nested session, decided inside its row."""

    def holds(types: tuple[str, ...]) -> Column:
        found = F.exists(events, lambda event: event["event_type"].isin(*types))
        return F.coalesce(found, F.lit(False))

    return _first_match({name: holds(types) for name, types in TYPE_RULES})


def session_type_over(event_type: Column) -> Column:
    """Aggregate over event rows: the type of the session they make up."""
    return _first_match(
        {
            name: F.coalesce(F.bool_or(event_type.isin(*types)), F.lit(False))
            for name, types in TYPE_RULES
        }
    )


def type_flags() -> dict[str, Column]:
    """Row conditions that, taken over a session, decide its type."""
    return {f"has_{name}": F.col("event_type").isin(*types) for name, types in TYPE_RULES}


def session_type_by_flags() -> Column:
    """Type of a session over its ``type_flags`` columns."""
    return _first_match({name: F.col(f"has_{name}") for name, _ in TYPE_RULES})


def shower_flags() -> dict[str, Column]:
    """Row conditions that, taken over a city session, make it a SHOWER."""
    return {
        "has_contact_form": F.col("event_subtype") == "contact form",
        "has_click": F.col("event_type") == "click",
        "has_view": F.col("event_type").isin("show", "display"),
    }


def is_shower() -> Column:
    """SHOWER test of a city session over its ``shower_flags`` columns."""
    return ~F.col("has_contact_form") & ~F.col("has_click") & F.col("has_view")


def keep_fraction(rate: Column | float, *keys: str, seed: int = 0) -> Column:
    """True for the given share of key values, the same ones on every run.

    The decision hashes the key, so a recomputed task repeats it exactly.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return draw < F.floor(F.lit(rate) * F.lit(_HASH_RANGE))


def sample_rate(session_type: Column, rates: Mapping[str, float] = SAMPLE_RATES) -> Column:
    chosen = F.lit(1.0)
    for name, rate in rates.items():
        chosen = F.when(session_type == name, F.lit(rate)).otherwise(chosen)
    return chosen
