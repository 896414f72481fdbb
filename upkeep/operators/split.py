"""Training and validation rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.functions import key_bucket


def split(frame: DataFrame, percent: int = 70) -> tuple[DataFrame, DataFrame]:
    """About ``percent`` % of the keys for training, the others for validation.

    Decided by a hash of the key: no shuffle, the same in every run, each row
    on exactly one side, and all rows of a key on the same side.
    """
    in_training = key_bucket() < F.lit(percent)
    return frame.filter(in_training), frame.filter(~in_training)


def with_side(frame: DataFrame, percent: int = 70) -> DataFrame:
    """The rows with their ``bucket`` and ``side``, in one pass over the frame."""
    bucket = key_bucket()
    side = F.when(bucket < F.lit(percent), "training").otherwise("validation")
    return frame.withColumn("bucket", bucket.cast("bigint")).withColumn("side", side)


def random_split(
    frame: DataFrame, percent: int = 70, seed: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Random split by rows; repeatable only for a fixed seed and row order."""
    train, rest = frame.randomSplit([percent / 100, 1 - percent / 100], seed)
    return train, rest
