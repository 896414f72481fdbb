"""Tables written to the folder that all executors share, and frames in order of id."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder of this machine and
    keeps it for later calls; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="upkeep-llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def free_name(frame: DataFrame, base: str) -> str:
    """A column name that the frame does not have."""
    taken = {c.lower() for c in frame.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(frame: DataFrame, name: str, *partition: str) -> DataFrame:
    """The frame by way of a table in the shared folder, in as many tasks as it has."""
    path = new_path(frame.sparkSession, name)
    frame.write.partitionBy(*partition).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


#: For rows with two texts or more: an executor holds a batch of each task twice.
SMALL_BATCH = 8 << 20


def few(frame: DataFrame) -> DataFrame:
    """The frame in at most four partitions per core of the cluster.

    A shuffle of little data over very many partitions is not written as as many files.
    """
    return frame.coalesce(4 * max(2, frame.sparkSession.sparkContext.defaultParallelism))


def returning(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` of a task, whose worker then gives free memory back to the system.

    Spark keeps Python workers for later tasks, and allocators keep what they once got;
    what one stage has needed would count in an executor through all that follow.
    """

    @functools.wraps(run)  # Spark reads the kind of a function off its annotations
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return whole


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc alone
    if trim:
        trim(0)


class Kept:
    """Intermediate tables of one run of an operator.

    ``keep`` writes a frame as Parquet and reads it back, which cuts its lineage;
    ``drop`` deletes tables that no returned frame reads; ``release`` has the driver
    collect its garbage, for Spark deletes the shuffle files of frames that are gone
    only then.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def keep(self, frame: DataFrame, name: str, batch: int | None = None) -> DataFrame:
        """``batch``: bytes handed to Python at once, if other than the session's."""
        path = new_path(self.spark, name)
        setting = "spark.sql.execution.arrow.maxBytesPerBatch"
        before = self.spark.conf.get(setting)
        try:
            if batch:
                self.spark.conf.set(setting, str(batch))
            few(frame).write.parquet(path)
        finally:
            if batch:
                self.spark.conf.set(setting, before)
        stored = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(stored)] = stored, path
        return stored

    def release(self) -> None:
        for _ in range(2):  # what the first round lets go of holds shuffles itself
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)

    def drop(self, *frames: DataFrame) -> None:
        self._delete([self.paths.pop(id(frame)) for frame in frames])

    def drop_all_but(self, *frames: DataFrame) -> None:
        needed = {id(frame) for frame in frames}
        self._delete([self.paths.pop(key) for key in list(self.paths) if key not in needed])

    def _delete(self, kept: list[tuple[DataFrame, str]]) -> None:
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for _, path in kept:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


#: Ranges of ids that a table is cut into, at most.
MOST_RANGES = 10_000
#: Partitions that a shuffle is asked for, at most; each then holds more.
MOST_PARTITIONS = 20_000


def id_bounds(docs: DataFrame, column: str, rows: int) -> list[int]:
    """Ids that cut the table into ranges of about ``rows`` rows, ascending.

    What reaches the driver is one id per range. Of a table so large that there would
    be more than ``MOST_RANGES`` the ranges are longer; those who use them stream.
    """
    parts = min(MOST_RANGES, max(1, round(docs.count() / rows)))
    if parts == 1:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(column, shares, max(10000, 20 * parts)).alias("q")).first()[0]
    return sorted(set(found or []))


def range_of(column: str, bounds: list[int]):
    """Number of the range an id lies in; null ids lie in the first.

    A range starts at its bound. The bounds are a literal array, searched per row.
    """
    if not bounds:
        return F.lit(0)
    size = 1 + len(bounds) // 64
    heads = bounds[::size]
    code = F.lit(0)
    # Two levels, so that a row is compared with some 64 + size bounds at most.
    coarse = F.array([F.lit(b) for b in heads])
    chunk = F.size(F.filter(coarse, lambda b: b <= F.col(column)))
    if size == 1:
        code = chunk
    else:
        rows = F.array([F.array([F.lit(b) for b in bounds[i : i + size]]) for i in range(0, len(bounds), size)])
        inside = F.size(F.filter(F.get(rows, chunk - 1), lambda b: b <= F.col(column)))
        code = F.when(chunk == 0, 0).otherwise((chunk - 1) * size + inside)
    return F.coalesce(F.when(F.col(column).isNull(), 0).otherwise(code), F.lit(0)).cast("int")
