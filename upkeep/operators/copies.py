"""Spreading rows by content, identical rows included."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 10_000


def pack_copies(frame: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Identical rows as one row per ``chunk`` of copies.

    Adds ``_chunk`` (running number) and ``_copies`` (1..chunk). Copies collapse
    on the map side, so a group of them is small before it is shuffled, and its
    chunks can then go to different tasks.
    """
    counted = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {int(chunk)}"))
    return (
        counted.withColumn("_chunk", F.explode(chunks))
        .withColumn("_copies", F.least(F.lit(chunk), F.col("_n") - F.col("_chunk") * chunk))
        .drop("_n")
    )


def unpack_copies(packed: DataFrame) -> DataFrame:
    """The rows that ``pack_copies`` packed."""
    repeats = F.array_repeat(F.lit(True), F.col("_copies").cast("int"))
    return packed.withColumn("_copy", F.explode(repeats)).drop("_chunk", "_copies", "_copy")


def spread(frame: DataFrame, partitions: int, chunk: int = CHUNK) -> DataFrame:
    """Repartition and order by content alone.

    The same rows always give the same partitions in the same order, whatever
    the input files or the cluster look like, and even a group of identical
    rows is divided over the partitions.
    """
    packed = pack_copies(frame, chunk)
    by_content = packed.columns
    return unpack_copies(
        packed.repartition(partitions, *by_content).sortWithinPartitions(*by_content)
    )
