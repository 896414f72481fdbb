"""Output of a stream, of which readers see whole batches only."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of files in ``_commits``: first and last batch, and the attempt that counts.
COMMIT = re.compile(r"(\d+)-(\d+)-([0-9a-f]{32})")


class Batches:
    """Batches of one stream under a path, on any file system that Spark reads.

    Each attempt at a batch writes a folder of its own, ``batch_id=N/attempt=A``. Once it
    is whole, an empty file in ``_commits`` makes it count; its name says all, so a
    listing is all that readers need. Attempts without one are never seen, and a batch
    that has one is not written again. Batches can be merged; the merged one counts in
    place of those it covers. One stream writes at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _place(self, *names: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        return place.getFileSystem(conf), place

    def exists(self) -> bool:
        files, place = self._place("_commits")
        return files.exists(place)

    def committed(self) -> dict[tuple[int, int], str]:
        """Attempts that count, by the first and the last batch they hold."""
        files, place = self._place("_commits")
        found: dict[tuple[int, int], str] = {}
        for status in files.listStatus(place) if files.exists(place) else []:
            name = COMMIT.fullmatch(status.getPath().getName())
            if name:
                span = int(name[1]), int(name[2])
                found[span] = min(found.get(span, name[3]), name[3])
        # Longer spans first: what a merged batch covers does not count.
        counted: dict[tuple[int, int], str] = {}
        end = -1
        for first, last in sorted(found, key=lambda span: (span[0], -span[1])):
            if last > end:
                counted[first, last] = found[first, last]
                end = last
        return counted

    def write(self, rows: DataFrame, batch_id: int, *partition: str, first: int | None = None) -> bool:
        """Store a batch, unless one that counts holds it; whether it was stored.

        ``first``: the first of the batches that these rows stand for, if several.
        """
        first = batch_id if first is None else first
        if any(a <= first and batch_id <= b for a, b in self.committed()):
            return False
        attempt = uuid.uuid4().hex
        rows.write.partitionBy(*partition).parquet(
            f"{self.path}/batch_id={batch_id}/attempt={attempt}"
        )
        files, place = self._place("_commits", f"{first}-{batch_id}-{attempt}")
        if not files.createNewFile(place):
            raise OSError(f"cannot commit {place}")
        return True

    def read(self, schema: T.StructType) -> DataFrame:
        """Rows of all batches that count, with their ``batch_id``; as of now."""
        full = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
        paths = [
            f"{self.path}/batch_id={last}/attempt={attempt}"
            for (_, last), attempt in self.committed().items()
        ]
        if not paths:
            return self.spark.createDataFrame([], full)
        read = self.spark.read.schema(full).option("basePath", self.path).parquet(*paths)
        return read.select(*schema.names, F.col("batch_id"))
