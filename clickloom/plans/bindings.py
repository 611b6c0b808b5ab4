"""The jobs' inputs, derived row by row from the parquet tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions.events import event_type
from clickloom.schemas import EVENT_SUBTYPES, VEHICLE_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of each document: ``doc_id, source, line_no, line``."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return documents.select(
        "doc_id", "source", F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines led by their reference ``source:doc_id:line_no``."""
    reference = F.concat_ws(":", "source", "doc_id", "line_no")
    return paragraphs(spark, sf_dir).select(F.concat_ws(" ", reference, "line").alias("value"))


def emails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each conversation turn as an email line.

    The words of a turn are its addresses: a user's stand under From, an
    assistant's under To, a system turn's under Cc.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def words_of(role: str) -> Column:
        return F.when(F.col("role") == role, F.col("text")).otherwise("")

    line = F.concat_ws(
        " ",
        F.lit("Message-ID:"),
        "conv_id",
        F.lit("From:"),
        words_of("user"),
        F.lit("To:"),
        words_of("assistant"),
        F.lit("Subject:"),
        F.concat(F.lit("turn-"), "turn"),
        F.lit("Cc:"),
        words_of("system"),
        F.lit("Mime-Version: 1.0 X-From:"),
    )
    return turns.select(line.alias("value"))


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as the 16 text columns of a click log."""
    k = F.get_json_object("props", "$.k").cast("int")

    def choice(*values: str) -> Column:
        return F.get(F.array(*[F.lit(v) for v in values]), F.col("k") % len(values))

    kind = (
        F.when(F.col("event_type") == "view", F.lit("show"))
        .when(F.col("event_type") == "click", F.lit("click"))
        .when(F.col("event_type") == "purchase", choice("submit", "edit", "change"))
        .when(F.col("event_type") == "signup", F.lit("visit"))
        .otherwise(F.lit("display"))
    )
    subtype = choice(*[s.lower().replace("_", " ") for s in EVENT_SUBTYPES])
    events = table(spark, sf_dir, "events").withColumn("k", k)
    return events.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws(" ", kind, subtype).alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("city"),
        F.col("k").cast("string").alias("vin"),
        choice("New", "Used", "CPO", "Salvage").alias("vehicle_condition"),
        (2000 + F.col("k") % 20).cast("string").alias("year"),
        F.concat(F.lit("make"), F.col("k") % 7).alias("make"),
        F.concat(F.lit("model"), F.col("k") % 13).alias("model"),
        choice("", "S", "SE").alias("trim"),
        choice("Sedan", "SUV", "Coupe", "Pickup", "Truck").alias("body_style"),
        choice("Crew Cab", "Extended Cab", "Regular Cab", "").alias("cab_style"),
        F.col("value").cast("string").alias("price"),
        (F.col("event_id") % 1000).cast("string").alias("mileage"),
        choice("t", "f").alias("free_carfax_report"),
        choice("", "abs", "sunroof:abs::", "navigation:abs:sunroof").alias("features"),
    )


def redelivered(log: DataFrame) -> DataFrame:
    """A second delivery of the submitting events of a log."""
    kind = event_type(F.col("event_type"))
    return log.filter(kind.isin("SUBMIT", "EDIT", "CHANGE"))


def order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events of a second source: user, city, type, time, vehicle."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("city"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_timestamp"),
        F.lit("submit contact form").alias("event_type"),
        (F.col("o_orderkey") % 100).cast("string").alias("vin"),
    )


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as marketplace impressions: ``vin, kind, n``."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 100).cast("string").alias("vin"),
        F.when(F.col("l_returnflag") == "R", "SRP").otherwise("VDP").alias("kind"),
        F.col("l_quantity").cast("bigint").alias("n"),
    )


def vehicle_lines(spark: SparkSession, sf_dir: str, nonzero: str | None = None) -> DataFrame:
    """Line items as vehicle rows, all text, still without make and model.

    ``nonzero`` names a number that must not be zero. It is tested before it
    becomes text, so that the test reaches the scan.
    """
    lines = table(spark, sf_dir, "lineitem")
    if nonzero:
        lines = lines.filter(F.col(nonzero) != 0)
    event = F.concat_ws(
        " ",
        F.when(F.col("l_returnflag") == "A", "show")
        .when(F.col("l_returnflag") == "N", "click")
        .otherwise("edit"),
        F.when(F.col("l_linestatus") == "F", "badges").otherwise("contact form"),
    )
    return lines.select(
        F.col("l_orderkey").cast("string").alias("userID"),
        event.alias("event"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("timestamp"),
        F.col("l_partkey").cast("string").alias("vin"),
        F.col("l_linestatus").alias("condition"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.col("l_extendedprice").cast("string").alias("price"),
        F.col("l_quantity").cast("string").alias("mileage"),
    )


def with_make_and_model(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Add make and model of each vehicle from the parts table, if it is listed there."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("vin"),
        F.col("p_brand").alias("make"),
        F.col("p_type").alias("model"),
    )
    return rows.join(parts, "vin", "left").select(
        *[c for c in VEHICLE_COLUMNS if c in (*rows.columns, "make", "model")]
    )
