"""Daily averages of directories that go on growing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from upkeep.fixed import ASSET, AVERAGE, DAY, KEYS, MONTH
from upkeep.functions import month_of
from upkeep.sinks.batches import Batches
from upkeep.sources.readings import stream_readings

#: What is stored: sums that can go on being added up.
PARTIAL = T.StructType(
    [
        T.StructField(ASSET, T.StringType()),
        T.StructField(DAY, T.DateType()),
        T.StructField("total", T.DoubleType()),
        T.StructField("counted", T.LongType()),
        T.StructField(MONTH, T.StringType()),
    ]
)


def partial_average(readings: DataFrame) -> DataFrame:
    """Sum and number of the values per (asset, day), which add up over disjoint readings."""
    return (
        readings.select(ASSET, F.to_date("date").alias(DAY), "value")
        .groupBy(*KEYS)
        .agg(F.sum("value").alias("total"), F.count("value").alias("counted"))
        .withColumn(MONTH, month_of(F.col(DAY)))
    )


def merged(partial: DataFrame) -> DataFrame:
    """Partial sums of several batches, one row per key."""
    return partial.groupBy(*KEYS, MONTH).agg(
        F.sum("total").alias("total"), F.sum("counted").alias("counted")
    )


def update_averages(
    spark: SparkSession,
    paths: str | list[str],
    out: str,
    progress: str,
    series: str | None = None,
    files_per_batch: int | None = None,
    **trigger: object,
) -> StreamingQuery:
    """Add the files that came since the last run to the averages in ``out``.

    The stream in ``progress`` remembers the files it has seen, so each is read once,
    whatever days it holds; a file must not change after that. All new files are worked
    off, at most ``files_per_batch`` at a time (per directory), and the query ends,
    unless ``trigger`` says otherwise. A batch stores one row per asset and day that it
    has readings of. A run that breaks off is taken up by the next: a batch counts once
    it is whole, and only once.
    """
    batches = Batches(spark, out)

    def store(batch: DataFrame, batch_id: int) -> None:
        if series is not None:
            batch = batch.filter(F.col("series") == series)
        rows = partial_average(batch).select(*PARTIAL.names).hint("rebalance", F.col(MONTH))
        batches.write(rows, batch_id, MONTH)

    return (
        stream_readings(spark, paths, files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", progress)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_averages(spark: SparkSession, path: str) -> DataFrame:
    """asset_id, day, month, average of all batches stored so far.

    The averages are those of all readings at once, up to the order in which doubles are
    added. A filter on ``month`` or ``day`` reaches the scan.
    """
    sums = merged(Batches(spark, path).read(PARTIAL))
    return sums.select(*KEYS, MONTH, (F.col("total") / F.col("counted")).alias(AVERAGE))


def compact_averages(spark: SparkSession, path: str) -> bool:
    """Merge all batches into one, which readers then see in their place.

    Worth it after many small ones; not while a stream writes. Frames read before keep
    their batches, whose files stay.
    """
    batches = Batches(spark, path)
    spans = batches.committed()
    if len(spans) < 2:
        return False
    first, last = min(a for a, _ in spans), max(b for _, b in spans)
    rows = merged(batches.read(PARTIAL)).select(*PARTIAL.names).hint("rebalance", F.col(MONTH))
    return batches.write(rows, last, MONTH, first=first)
