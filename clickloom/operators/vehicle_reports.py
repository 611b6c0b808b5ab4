"""Price, mileage and event reports over vehicle rows, in Spark SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def listed(rows: DataFrame, column: str) -> DataFrame:
    """Rows whose text column holds a number other than zero."""
    return rows.filter(F.col(column).try_cast("double") != 0)


def one_per_key(rows: DataFrame, key: str, by: list[str] | None = None) -> DataFrame:
    """One row per key, chosen without regard to what is in it.

    The choice is the row with the smallest MD5 of its key and its columns
    ``by`` (all, if not given), so it favours neither low nor high values, any
    run repeats it, and one candidate per key and task is all that is shuffled.
    Rows equal in ``by`` are told apart by the other columns in order.
    """
    others = [c for c in rows.columns if c != key]
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, *(by or others))]
    draw = F.md5(F.concat_ws("|", *parts))
    return (
        rows.groupBy(key)
        .agg(F.min(F.struct(draw.alias("draw"), *others)).alias("row"))
        .select(*[F.col(c) if c == key else F.col(f"row.{c}").alias(c) for c in rows.columns])
    )


def price_by_make_model(rows: DataFrame) -> DataFrame:
    """Lowest, highest and average price per make and model, whole units."""
    return rows.sparkSession.sql(
        """
        SELECT make, model,
               MIN(TRY_CAST(price AS DECIMAL(10, 0))) AS min_price,
               MAX(TRY_CAST(price AS DECIMAL(10, 0))) AS max_price,
               AVG(TRY_CAST(price AS DECIMAL(10, 0))) AS avg_price
        FROM {rows}
        GROUP BY make, model
        ORDER BY make, model
        """,
        rows=rows,
    )


def mileage_by_year(rows: DataFrame) -> DataFrame:
    """Lowest, highest and average mileage per year, whole units."""
    return rows.sparkSession.sql(
        """
        SELECT year,
               MIN(TRY_CAST(mileage AS DECIMAL(10, 0))) AS min_mileage,
               MAX(TRY_CAST(mileage AS DECIMAL(10, 0))) AS max_mileage,
               AVG(TRY_CAST(mileage AS DECIMAL(10, 0))) AS avg_mileage
        FROM {rows}
        GROUP BY year
        ORDER BY year
        """,
        rows=rows,
    )


def vehicle_event_counts(rows: DataFrame, view: str | None = None) -> DataFrame:
    """Events per vehicle and first word of the event, over a temporary view.

    A view that is given a name stays; one without is dropped once the query is planned.
    """
    name = view or f"vehicle_events_{uuid.uuid4().hex}"
    rows.withColumn("event_type", F.substring_index("event", " ", 1)).createOrReplaceTempView(name)
    try:
        return rows.sparkSession.sql(
            f"""
            SELECT vin, event_type AS event, COUNT(*) AS events
            FROM {name}
            GROUP BY vin, event_type
            ORDER BY vin, event_type
            """
        )
    finally:
        if view is None:
            rows.sparkSession.catalog.dropTempView(name)
