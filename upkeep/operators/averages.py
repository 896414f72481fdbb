"""Daily sensor averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import ASSET, AVERAGE, DAY, KEYS


def daily_average(readings: DataFrame, series: str | None = None) -> DataFrame:
    """Mean value per (asset, day) over all files and series; NULLs are ignored.

    Each map task sends one partial sum per key, so raw readings never travel
    and an asset holding most of them costs no more than any other.
    """
    if series is not None:
        readings = readings.filter(F.col("series") == series)
    return (
        readings.select(ASSET, F.to_date("date").alias(DAY), "value")
        .groupBy(*KEYS)
        .agg(F.avg("value").alias(AVERAGE))
    )
