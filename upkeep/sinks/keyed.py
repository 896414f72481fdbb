"""Tables in buckets of (asset, day), joined again and again without a shuffle."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import KEYS
from upkeep.operators.hotkeys import ROWS_PER_PIECE, hot_keys

#: Rows of a bucket, about.
ROWS_PER_BUCKET = 5_000_000


def bucket_count(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets for a table of so many rows: a power of two, so that of two tables one
    count divides the other and Spark can read the finer one by the coarser."""
    return 1 << max(0, -(-rows // per_bucket) - 1).bit_length()


def write_keyed(
    frame: DataFrame, path: str, buckets: int, rows_per_piece: int = ROWS_PER_PIECE
) -> None:
    """Store a table with asset and day for joins by them.

    ``buckets/`` holds the rows in as many buckets, one sorted file each: the one shuffle
    that every later join is spared. A bucket cannot be divided among tasks, so rows of
    keys with more than ``rows_per_piece`` rows, and rows without a full key, which no
    join finds, stay out of them in ``loose/``, and ``hot/`` names those keys.
    ``_layout`` is written last; without it the table cannot be read.
    """
    spark = frame.sparkSession
    hot = hot_keys(frame, rows_per_piece=rows_per_piece)
    known = F.col(KEYS[0]).isNotNull() & F.col(KEYS[1]).isNotNull()
    bucketed, loose = frame.filter(known), frame.filter(~known)
    named = frame.select(*KEYS).limit(0) if hot is None else hot.select(*KEYS)
    if hot is not None:
        loose = loose.unionByName(bucketed.join(named, KEYS, "left_semi").select(*frame.columns))
        bucketed = bucketed.join(named, KEYS, "left_anti").select(*frame.columns)
    loose.write.mode("overwrite").parquet(f"{path}/loose")
    named.write.mode("overwrite").parquet(f"{path}/hot")
    # A hash partition of a shuffle is a bucket, so every bucket gets one file.
    table = f"keyed_{uuid.uuid4().hex}"
    (
        bucketed.repartition(buckets, *KEYS)
        .write.mode("overwrite")
        .option("path", f"{path}/buckets")
        .bucketBy(buckets, *KEYS)
        .sortBy(*KEYS)
        .saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")  # the files stay
    layout = json.dumps(
        {
            "buckets": buckets,
            "hot_keys": 0 if hot is None else spark.read.parquet(f"{path}/hot").count(),
            "schema": frame.schema.jsonValue(),
        }
    )
    spark.createDataFrame([(layout,)], "layout string").coalesce(1).write.mode("overwrite").text(
        f"{path}/_layout"
    )
