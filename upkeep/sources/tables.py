"""Operational tables: utilization and interruptions, by JDBC or as files."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from upkeep.fixed import (
    ASSET,
    DAY,
    INTERRUPTION_ASSET,
    INTERRUPTION_START,
    KPIS,
    UTILIZATION_ASSET,
    UTILIZATION_DAY,
)


def jdbc_options(
    options: dict[str, str], table: str, partitioning: dict[str, Any] | None = None
) -> dict[str, str]:
    """Reader options for a JDBC table.

    ``options`` holds the caller's connection (url, driver, user, ...); none is
    built in. ``partitioning`` (column, lower, upper, partitions) splits the
    read by ranges of a date or numeric column.
    """
    merged = {**options, "dbtable": table}
    if partitioning is not None:
        merged.update(
            partitionColumn=str(partitioning["column"]),
            lowerBound=str(partitioning["lower"]),
            upperBound=str(partitioning["upper"]),
            numPartitions=str(partitioning["partitions"]),
        )
    return merged


def day_predicates(
    counts: Sequence[tuple[datetime.date | None, int]], column: str, partitions: int
) -> list[str]:
    """Conditions that cut a table into at most ``partitions`` parts of about equal rows.

    ``counts`` are the rows of each day. The parts are ranges of days, the first and the
    last of them open, so that days that come meanwhile are in one part too; a day is
    never divided. Rows without a day go with the first part.
    """
    held = sorted((day, n) for day, n in counts if day is not None)
    total, so_far, cuts = sum(n for _, n in held), 0, []
    part = 1  # in which the rows so far end
    for day, n in held:
        # Cut where it is nearer to an even part: before the day or, next time, after it.
        if so_far and (so_far + n / 2) * partitions >= total * part:
            cuts.append(day)
            part = int(so_far * partitions / total) + 1
            part += (so_far + n / 2) * partitions >= total * part
        so_far += n
    bounds = [f"DATE '{day}'" for day in cuts[: partitions - 1]]
    if not bounds:
        return ["1 = 1"]
    first, last = f"{column} < {bounds[0]} OR {column} IS NULL", f"{column} >= {bounds[-1]}"
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:])]
    return [first, *between, last]


def read_jdbc_by_day(
    spark: SparkSession, options: dict[str, str], table: str, column: str, partitions: int
) -> DataFrame:
    """A JDBC table in parts of about equal rows, whose bounds nobody has to know.

    The database counts its rows by day first; the driver sees a row per calendar day,
    however large the table is. Equal ranges would leave most parts empty where days
    were logged unevenly.
    """
    days = f"(SELECT CAST({column} AS DATE) AS day, COUNT(*) AS n FROM {table} GROUP BY CAST({column} AS DATE)) days"
    counted = spark.read.format("jdbc").options(**jdbc_options(options, days)).load()
    counts = [(row["day"], row["n"]) for row in counted.collect()]
    return spark.read.jdbc(
        options["url"],
        table,
        predicates=day_predicates(counts, column, partitions),
        properties={k: v for k, v in options.items() if k != "url"},
    )


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table: str,
    columns: Sequence[str] | None = None,
    partitioning: dict[str, Any] | None = None,
    one_task: bool = False,
) -> DataFrame:
    """A JDBC table. Column lists and filters set later still reach the database.

    Without ``partitioning`` one task would read everything, however large the table;
    that must be asked for with ``one_task``.
    """
    if partitioning is None and not one_task:
        raise ValueError(f"give a partitioning for {table}, or one_task to read it in one")
    frame = spark.read.format("jdbc").options(**jdbc_options(options, table, partitioning)).load()
    return frame if columns is None else frame.select(*columns)


def read_source(spark: SparkSession, spec: dict[str, Any], stream: bool = False) -> DataFrame:
    """A table named by a small spec, so that jobs need not know where it lives.

    ``{"format": "jdbc", "options": {...}, "table": t, "partitioning": {...}}``, with
    ``"one_task": true`` in place of a partitioning for a small table, or with
    ``"by_day": {"column": c, "partitions": n}`` for parts of about equal rows,
    or ``{"format": "parquet", "path": p, "schema": ddl, "options": {...}}``,
    the latter also as a stream; the schema may be left out for a batch.
    """
    options = spec.get("options", {})
    if spec["format"] == "jdbc" and "by_day" in spec:
        return read_jdbc_by_day(spark, options, spec["table"], **spec["by_day"])
    if spec["format"] == "jdbc":
        return read_jdbc(
            spark,
            options,
            spec["table"],
            partitioning=spec.get("partitioning"),
            one_task=spec.get("one_task", False),
        )
    reader = (spark.readStream if stream else spark.read).format(spec["format"])
    if "schema" in spec:
        reader = reader.schema(spec["schema"])
    return reader.options(**options).load(spec.get("path"))


def utilization_from(
    table: DataFrame, asset: str = UTILIZATION_ASSET, day: str = UTILIZATION_DAY
) -> DataFrame:
    """Keys and KPIs of a utilization table; nothing else is read."""
    return table.select(
        F.col(asset).cast("string").alias(ASSET),
        F.to_date(day).alias(DAY),
        *[F.col(name).cast("double").alias(name) for name in KPIS],
    )


def interruptions_from(
    table: DataFrame,
    subsystem: str | None = None,
    kinds: Sequence[str] | None = None,
    start: str = INTERRUPTION_START,
    asset: str = INTERRUPTION_ASSET,
) -> DataFrame:
    """Asset and start day of the interruptions that count.

    The conditions compare bare columns with literals, so a JDBC or Parquet
    scan evaluates them. ``None`` leaves a condition out.
    """
    if subsystem is not None:
        table = table.filter(F.col("subsystem") == subsystem)
    if kinds is not None:
        table = table.filter(F.col("kind").isin(list(kinds)))
    return table.select(
        F.col(asset).cast("string").alias(ASSET), F.to_date(start).alias("start_day")
    )
