"""Global shuffle into shards in two passes.

Pass one scatters rows by a seeded hash over buckets that fit a task's memory. Pass
two loads one bucket at a time, shuffles it by Fisher and Yates and writes it. Buckets follow one
another, so a row's place in the whole is known, and the places are cut into shards of
equal numbers of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.llm.store import MOST_PARTITIONS, free_name, new_path
from upkeep.llm.words import mix

LAW = "rows"
#: Bytes of text in a bucket.
BUCKET = 24 << 20


def fisher_yates(n: int, seed: int) -> np.ndarray:
    """A permutation of 0 to n - 1, the same wherever it is computed."""
    draw = mix(np.arange(n, dtype=np.uint64), seed % (1 << 31)) % np.maximum(1, np.arange(1, n + 1, dtype=np.uint64))
    out = list(range(n))
    for i in range(n - 1, 0, -1):
        j = int(draw[i])
        out[i], out[j] = out[j], out[i]
    return np.array(out, np.int64)


def write_shards(docs: DataFrame, folder: str, shards: int = 16, seed: int = 42, bucket_bytes: int = BUCKET) -> DataFrame:
    """Shuffle all rows and write them under ``folder``; the stored table.

    All columns of docs are kept, and the table gets ``shard`` (0 to shards - 1) and
    ``slot`` (place in the shard, from 0 without gaps). Shards differ by one row at
    most. Where a row goes depends on the seed and on the table's ids and texts, not on
    the order of its rows, so a task that runs again writes the same.

    Null ids and texts are values like others; rows equal in both stand in one bucket.
    An empty table gives an empty one. Columns named shard or slot are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    mark, bucket = free_name(docs, "mark"), free_name(docs, "bucket")
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    total = docs.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-total // bucket_bytes))
    keyed = docs.withColumn(mark, F.xxhash64("doc_id", "text", F.lit(seed)))
    keyed = keyed.withColumn(bucket, F.pmod(F.xxhash64(mark, F.lit(seed)), F.lit(n)))
    places = np.zeros(n + 1, np.int64)  # the driver sees a number per bucket
    for row in keyed.groupBy(F.col(bucket).alias("number")).agg(F.count("*").alias("rows")).toLocalIterator():
        places[row["number"] + 1] = row["rows"]
    places = np.cumsum(places)
    rows = int(places[-1])
    edges = np.array([rows * s // shards for s in range(shards + 1)], np.int64)
    shared = spark.sparkContext.broadcast((places, edges))
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, edges = shared.value
        held: list[pa.RecordBatch] = []
        now: int | None = None

        def shuffled() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            order = fisher_yates(table.num_rows, seed + now)
            place = places[now] + np.arange(len(order))
            shard = np.searchsorted(edges, place, "right") - 1
            for i in range(0, len(order), 2000):
                some = table.take(pa.array(order[i : i + 2000])).combine_chunks().to_batches()[0]
                s = shard[i : i + 2000]
                columns = [some.column(c) for c in names] + [pa.array(s, pa.int32()), pa.array(place[i : i + 2000] - edges[s])]
                yield pa.RecordBatch.from_arrays(columns, [*names, "shard", "slot"])

        for batch in batches:
            number = batch.column(bucket).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if now is not None and number[i] != now:
                    yield from shuffled()
                    held = []
                now = int(number[i])
                held.append(batch.slice(i, j - i))
        if held:
            yield from shuffled()

    schema = docs.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0).cast("long")).schema
    dealt = keyed.repartition(min(n, MOST_PARTITIONS), bucket).sortWithinPartitions(bucket, mark, "doc_id")
    out = dealt.mapInArrow(run, schema)
    out.write.partitionBy("shard").parquet(folder)
    return spark.read.schema(out.schema).parquet(folder)


def sharding(docs: DataFrame, folder: str | None = None, shards: int = 16) -> DataFrame:
    """Write the shards and describe each stored row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    stored = write_shards(docs.select("doc_id", "text"), folder or new_path(docs.sparkSession, "shards"), shards)
    return stored.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(LAW).alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
