"""Sensor files: one scan over whole directories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.fixed import ASSET, READINGS_SCHEMA, READINGS_SEPARATOR
from upkeep.functions import asset_id_from_file


def read_readings(
    spark: SparkSession,
    paths: str | list[str],
    sep: str = READINGS_SEPARATOR,
    reject: str | None = None,
) -> DataFrame:
    """Readings of every ``*.csv`` directly inside the given directories.

    The schema is explicit: a field that does not parse becomes NULL and the
    row stays. ``reject`` names an extra column holding the raw text of such
    rows. All files form one relation, however many there are.
    """
    schema = READINGS_SCHEMA
    reader = (
        spark.read.option("sep", sep).option("header", True).option("pathGlobFilter", "*.csv")
    )
    extra = []
    if reject is not None:
        schema = T.StructType([*schema.fields, T.StructField(reject, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", reject)
        extra = [reject]
    return (
        reader.schema(schema)
        .csv(paths)
        .select(
            asset_id_from_file(F.col("_metadata.file_name")).alias(ASSET),
            "date",
            "series",
            "value",
            *extra,
        )
    )


def stream_readings(
    spark: SparkSession,
    paths: str | list[str],
    files_per_batch: int | None = None,
    sep: str = READINGS_SEPARATOR,
) -> DataFrame:
    """``read_readings`` as a stream of the files that appear in the directories.

    Files count as new whatever their age, which matters for old ones copied in late;
    the stream remembers every name, some hundred bytes on the driver.
    """
    paths = [paths] if isinstance(paths, str) else paths
    reader = (
        spark.readStream.option("sep", sep)
        .option("header", True)
        .option("pathGlobFilter", "*.csv")
        .option("maxFileAge", "36500d")
        .schema(READINGS_SCHEMA)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    asset = asset_id_from_file(F.col("_metadata.file_name")).alias(ASSET)
    return union_readings(
        [reader.csv(path).select(asset, "date", "series", "value") for path in paths]
    )


def union_readings(frames: list[DataFrame]) -> DataFrame:
    """All rows of several reading frames, duplicates kept, matched by name.

    For directories prefer one ``read_readings`` call with a list of paths.
    """
    return reduce(DataFrame.unionByName, frames)
