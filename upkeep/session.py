"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder in ``spark.checkpoint.dir``, which all executors share.

    Where it is unset, a local session gets a temporary folder, once; on a cluster that
    is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="upkeep-"))
        shared = spark.sparkContext.getCheckpointDir()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def build_session(app: str, conf: dict[str, str] | None = None) -> SparkSession:
    """Session for a job. Master, memory and jars are left to spark-submit.

    The time zone is pinned because a reading's day is taken in the session zone.
    Joins of shuffled inputs whose partitions prove small enough are hashed
    rather than sorted; their size is known at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
