"""Hash of a string by the rule s[0]*31^(n-1) + ... + s[n-1] in 32 bits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CITY_BUCKETS = 6


def _wrapped(units: Column, of: Callable[[Column], Column]) -> Column:
    """The rule over an array, in the unsigned range."""
    mask = F.lit(0xFFFFFFFF)
    return F.aggregate(
        units, F.lit(0).cast("bigint"), lambda total, unit: (total * 31 + of(unit)).bitwiseAND(mask)
    )


def string_hash(text: Column) -> Column:
    """Signed 32-bit value over the UTF-16 code units of the text."""
    # In ASCII text characters are code units.
    plain = _wrapped(F.split(text, ""), F.ascii)
    digits = F.hex(F.encode(text, "UTF-16BE"))
    starts = F.when(F.length(digits) > 0, F.sequence(F.lit(1), F.length(digits), F.lit(4)))
    wide = _wrapped(
        F.coalesce(starts, F.array().cast("array<int>")),
        lambda at: F.conv(F.substring(digits, at, F.lit(4)), 16, 10).cast("bigint"),
    )
    value = F.when(F.length(text) == F.octet_length(text), plain).otherwise(wide)
    return F.when(value >= 1 << 31, value - (1 << 32)).otherwise(value)


def city_bucket(city: Column, buckets: int = CITY_BUCKETS) -> Column:
    """Bucket of a city in 0..buckets-1; a NULL city counts as the text ``null``."""
    hashed = string_hash(F.coalesce(city, F.lit("null")))
    return (F.abs(hashed) % buckets).cast("int")
