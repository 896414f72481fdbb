"""The stored matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from upkeep.fixed import MATRIX_CSV_SCHEMA


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Keyed Parquet matrix; a filter on ``month`` prunes directories."""
    return spark.read.parquet(path)


def read_matrix_csv(spark: SparkSession, path: str) -> DataFrame:
    """Keyless CSV matrix, five columns by position."""
    return spark.read.schema(MATRIX_CSV_SCHEMA).option("header", True).csv(path)
