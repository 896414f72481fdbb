"""Scoring a stream of requests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from upkeep.fixed import ASSET, AVERAGE, DAY, KPIS
from upkeep.operators.requests import BROADCAST_KEYS, take_requests
from upkeep.plans.scoring import score
from upkeep.sinks.batches import Batches

#: Opens a table as it is now.
Opens = Callable[[], DataFrame]

#: What is stored of a scored request.
SCORES = T.StructType(
    [
        T.StructField(ASSET, T.StringType()),
        T.StructField(DAY, T.DateType()),
        T.StructField("requested_day", T.StringType()),
        T.StructField("requests", T.LongType()),
        T.StructField("status", T.StringType()),
        *(T.StructField(name, T.DoubleType()) for name in [*KPIS, AVERAGE]),
        T.StructField("prediction", T.DoubleType()),
        T.StructField("verdict", T.StringType()),
    ]
)


def score_stream(
    requests: DataFrame,
    daily: Opens,
    utilization: Opens,
    model: PipelineModel,
    path: str,
    checkpoint: str,
    find_hot: bool = False,
    max_keys: int = BROADCAST_KEYS,
    **trigger: object,
) -> StreamingQuery:
    """Score a request stream into Parquet under ``path``, batch by batch.

    ``daily`` and ``utilization`` are opened anew for each batch: a frame lists its
    files when it is made, and days stored later would never be seen. Let ``daily``
    open a stored table of averages, since it is read once per batch. Each micro-batch
    goes through the batch ``score``: being small, its keys are broadcast and the
    tables are filtered by them while scanning, which a left stream-static join could
    not do. Stateless: requests are independent, so there is nothing to keep or to be
    late.

    ``read_scores`` shows batches once they are whole, each exactly once, also while
    one is run again. ``trigger`` as in ``DataStreamWriter.trigger``; by default all
    available requests are scored and the query ends.
    """
    batches = Batches(requests.sparkSession, path)

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        with take_requests(batch) as asked:
            scored = score(asked, daily(), utilization(), model, find_hot, max_keys)
            batches.write(scored.select(*SCORES.names), batch_id)

    return (
        requests.writeStream.foreachBatch(score_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """All requests scored so far, with the ``batch_id`` they were scored in."""
    return Batches(spark, path).read(SCORES)
