"""Which driver table plays which part (FIXTURES.md, section 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping.
SUBSYSTEM = "error"
KIND_LIMITS = [("AircraftOnGround", 200), ("Safety", 150), ("Delay", 100)]
SERIES = ["view", "click"]
LAST_LOGGED_DAY = 15  # of the month: interruptions were logged until then
MORNING = 12  # utilization counts what happened before this hour


# Given schemas spare a job per read that would look them up.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
)
LABELS_SCHEMA = "doc_id bigint, quality int, toxic int"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LABELS_SCHEMA).parquet(f"{sf_dir}/labels.parquet")


def asset() -> Column:
    return F.col("user_id").cast("string")


def readings(spark: SparkSession, sf_dir: str, series: list[str] = SERIES) -> DataFrame:
    """asset_id, date, series, value; of several series."""
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type").isin(series))
        .select(
            asset().alias("asset_id"),
            F.col("ts").alias("date"),
            F.col("event_type").alias("series"),
            "value",
        )
    )


def utilization_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per asset and day, named as the operational table is.

    Mornings only, so some days with readings and requests have none.
    """
    return (
        events(spark, sf_dir)
        .filter(F.hour("ts") < MORNING)
        .groupBy(asset().alias("aircraftid"), F.to_date("ts").alias("timeid"))
        .agg(
            F.sum("value").alias("flighthours"),
            F.count(F.lit(1)).cast("double").alias("flightcycles"),
            F.max("value").alias("delayedminutes"),
        )
    )


def interruptions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event of the first days, named as the operational table is."""
    kind = F.lit("Other")
    for name, limit in reversed(KIND_LIMITS):
        kind = F.when(F.col("value") > limit, name).otherwise(kind)
    logged = events(spark, sf_dir).filter(F.dayofmonth("ts") <= LAST_LOGGED_DAY)
    return logged.select(
        F.col("event_type").alias("subsystem"),
        kind.alias("kind"),
        F.col("ts").alias("starttime"),
        asset().alias("aircraftregistration"),
    )


def requests_of(events: DataFrame) -> DataFrame:
    """Purchases as requests; those above 100 name a day that is none."""
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.filter(F.col("event_type") == "purchase").select(
        F.when(F.col("value") > 100, F.concat(F.lit("about "), day)).otherwise(day).alias("timeid"),
        asset().alias("aircraftid"),
    )


def requests_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests_of(events(spark, sf_dir))
