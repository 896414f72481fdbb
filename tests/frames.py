"""Small hand-made inputs."""

import datetime

from upkeep.fixed import KPIS


def day(text):
    return None if text is None else datetime.date.fromisoformat(text)


def daily(spark, rows):
    return spark.createDataFrame(
        [(asset, day(d), value) for asset, d, value in rows],
        "asset_id string, day date, average double",
    )


def keys(spark, rows):
    return spark.createDataFrame([(a, day(d)) for a, d in rows], "asset_id string, day date")


def utilization(spark, rows):
    return spark.createDataFrame(
        [(asset, day(d), *map(float, kpis)) for asset, d, *kpis in rows],
        "asset_id string, day date, " + ", ".join(f"{name} double" for name in KPIS),
    )


def interruptions(spark, rows):
    return spark.createDataFrame(
        [(asset, day(d)) for asset, d in rows], "asset_id string, start_day date"
    )


def rows(frame):
    return sorted((tuple(row) for row in frame.collect()), key=repr)
