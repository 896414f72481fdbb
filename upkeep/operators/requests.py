"""What is known about each requested (asset, day)."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import (
    ASSET,
    AVERAGE,
    DAY,
    FEATURES,
    INVALID_REQUEST,
    KEYS,
    KPIS,
    MONTH,
    NO_READINGS,
    NO_UTILIZATION,
    SCORED,
)
from upkeep.functions import month_of
from upkeep.operators.hotkeys import ROWS_PER_PIECE, hot_keys, join_on_keys
from upkeep.operators.keyfilter import filter_bits, maybe_in
from upkeep.session import delete_path, shared_path

#: Requested keys that are broadcast, at most.
BROADCAST_KEYS = 200_000


def is_valid() -> Column:
    """A request that names both an asset and a day."""
    return F.col(ASSET).isNotNull() & F.col(DAY).isNotNull()


@dataclass
class Asked:
    """Requests as they stood at one moment.

    ``requests`` has each once, with ``requests``, the number of copies; a valid one is
    the only row of its key. ``keys`` counts the valid ones, ``first`` and ``last``
    bound their days. The requests are a stored snapshot: use them in a ``with`` block, or
    ``close`` them when what was made of them has been written, and it is deleted if
    ``take_requests`` chose its place.
    """

    requests: DataFrame
    keys: int
    first: datetime.date | None
    last: datetime.date | None
    snapshot: str | None = None

    def __enter__(self) -> Asked:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()

    def close(self) -> None:
        """Delete the snapshot; frames made of it can no longer be read."""
        if self.snapshot is not None:
            delete_path(self.requests.sparkSession, self.snapshot)
            self.snapshot = None

    def valid(self) -> DataFrame:
        return self.requests.filter(is_valid())

    def invalid(self) -> DataFrame:
        """They have no key to join by; kept apart, they cannot pile up in a join."""
        return self.requests.filter(~is_valid())


def take_requests(requests: DataFrame, path: str | None = None) -> Asked:
    """Read the requests, once, and hold them still.

    Copies collapse on the map side. The distinct requests are written to ``path``, or to
    a new one in the folder all executors share, so that a source that goes on changing
    is seen in one state even if an executor is lost or memory runs short. A snapshot
    at a given ``path`` is the caller's to keep.
    """
    shown = F.when(is_valid(), F.date_format(DAY, "yyyy-MM-dd")).otherwise(F.col("requested_day"))
    counted = (
        requests.withColumn("requested_day", shown)
        .groupBy(*requests.columns)
        .agg(F.count(F.lit(1)).alias("requests"))
    )
    spark = requests.sparkSession
    own = shared_path(spark, "requests") if path is None else None
    counted.write.parquet(own or path)
    held = spark.read.schema(counted.schema).parquet(own or path)
    measured = held.filter(is_valid()).agg(F.count(F.lit(1)), F.min(DAY), F.max(DAY)).first()
    return Asked(held, *measured, own)


def as_asked(requests: DataFrame | Asked) -> Asked:
    """Requests not taken yet are taken here; their snapshot stays until the folder is cleared."""
    return requests if isinstance(requests, Asked) else take_requests(requests)


def for_requests(frame: DataFrame, asked: Asked, max_keys: int = BROADCAST_KEYS) -> DataFrame:
    """The rows of a keyed table, or of the daily averages, that are asked for.

    The same rows however many keys are asked for. The range of days goes to the scan
    as a literal, where it prunes months, row groups or database rows. At most
    ``max_keys`` keys are broadcast, and all other rows are dropped while scanning; for
    averages Catalyst moves that semi-join below the aggregate. More keys are
    shuffled, and for averages joined above the aggregate, by which these are grouped
    by key already; but first a filter of bounded size (``maybe_in``) drops nearly all
    rows of other keys while scanning.
    """
    frame = frame.filter(F.col(DAY).between(F.lit(asked.first), F.lit(asked.last)))
    if MONTH in frame.columns:
        frame = frame.filter(
            F.col(MONTH).between(month_of(F.lit(asked.first)), month_of(F.lit(asked.last)))
        )
    keys = asked.valid().select(*KEYS)
    if asked.keys <= max_keys:
        keys = F.broadcast(keys)
    else:
        frame = maybe_in(frame, keys, filter_bits(asked.keys))
    return frame.join(keys, KEYS, "left_semi")


def request_features(
    requests: DataFrame | Asked,
    daily: DataFrame,
    utilization: DataFrame,
    find_hot: bool = False,
    max_keys: int = BROADCAST_KEYS,
    rows_per_piece: int = ROWS_PER_PIECE,
) -> DataFrame:
    """Every request with its features, as far as they exist, and a status.

    Keys stay attached throughout and no request is lost. A request repeats if
    utilization repeats its key; ``find_hot`` looks for keys that it repeats more than
    ``rows_per_piece`` times, among the rows that are asked for.
    """
    asked = as_asked(requests)
    averages = for_requests(daily, asked, max_keys).select(*KEYS, AVERAGE)
    kpis = for_requests(utilization, asked, max_keys).select(*KEYS, *KPIS)
    hot = hot_keys(kpis, rows_per_piece=rows_per_piece) if find_hot else None
    joined = join_on_keys(asked.valid().join(averages, KEYS, "left"), kpis, "left", hot)
    nothing = {name: F.lit(None).cast("double") for name in FEATURES}
    has_kpis = F.lit(True)
    for name in KPIS:
        has_kpis = has_kpis & F.col(name).isNotNull()
    status = (
        F.when(~is_valid(), INVALID_REQUEST)
        .when(F.col(AVERAGE).isNull(), NO_READINGS)
        .when(~has_kpis, NO_UTILIZATION)
        .otherwise(SCORED)
    )
    return (
        joined.select(*asked.requests.columns, *FEATURES)
        .unionByName(asked.invalid().withColumns(nothing))
        .withColumn("status", status)
    )
