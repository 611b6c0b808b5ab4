"""Statistics of event subtypes per session type, with an ANY roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.sessions import NO_RULE
from clickloom.operators.word_statistics import mean_and_variance
from clickloom.schemas import EVENT_SUBTYPES

# Fixed value: the session type of the roll-up rows.
ANY = "ANY"


def _sums(profiles: DataFrame) -> DataFrame:
    """Per type and subtype sums; every session of the type counts in each.

    Sums are taken over the twelve count columns side by side and turned into
    rows only afterwards, so no session row is multiplied.
    """
    wide = (
        profiles.filter(F.col("session_type") != NO_RULE)
        .groupBy(F.upper("session_type").alias("session_type"))
        .agg(
            F.count(F.lit(1)).alias("session_count"),
            *[F.sum(s).alias(s) for s in EVENT_SUBTYPES],
            *[F.sum(F.col(s) * F.col(s)).alias(f"{s}_SQUARES") for s in EVENT_SUBTYPES],
        )
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("event_subtype"),
                F.col(s).alias("total_count"),
                F.col(f"{s}_SQUARES").alias("sum_of_squares"),
            )
            for s in EVENT_SUBTYPES
        ]
    )
    return wide.select("session_type", "session_count", F.inline(rows))


def _finish(sums: DataFrame) -> DataFrame:
    return sums.select(
        "session_type",
        "event_subtype",
        "session_count",
        "total_count",
        "sum_of_squares",
        *mean_and_variance(
            F.col("session_count"), F.col("total_count"), F.col("sum_of_squares")
        ),
    )


def subtype_statistics(profiles: DataFrame) -> DataFrame:
    """Count, total, squares, mean and variance per session type and subtype."""
    return _finish(_sums(profiles))


def subtype_statistics_any(profiles: DataFrame) -> DataFrame:
    """Adds rows of type ANY over all session types."""
    kind, subtype = F.col("session_type"), F.col("event_subtype")
    rolled = (
        _sums(profiles)
        .groupingSets([[kind, subtype], [subtype]], kind, subtype)
        .agg(
            F.sum("session_count").alias("session_count"),
            F.sum("total_count").alias("total_count"),
            F.sum("sum_of_squares").alias("sum_of_squares"),
        )
        .withColumn("session_type", F.coalesce(kind, F.lit(ANY)))
    )
    return _finish(rolled)
