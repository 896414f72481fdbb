"""Matrix sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from upkeep.fixed import DAY, MATRIX_CSV_SCHEMA, MONTH
from upkeep.functions import month_of
from upkeep.session import delete_path


def write_by_month(keyed: DataFrame, path: str, months: Sequence[str] | None = None) -> None:
    """The matrix, or the daily averages, as Parquet partitioned by month of day.

    With ``months`` (``YYYY-MM``) only these are replaced, all others stay as they are;
    rows of other months are an error. A month without rows is emptied too. Readers
    of such a table should list it anew after a run.

    Rebalancing by month first lets AQE merge small months and split large
    ones, so there are few files and no single task writes a whole month.
    """
    rows = keyed.withColumn(MONTH, month_of(F.col(DAY))).hint("rebalance", F.col(MONTH))
    writer = rows.write.mode("overwrite").partitionBy(MONTH)
    if months is None:
        writer.option("partitionOverwriteMode", "static").parquet(path)
        return
    inside = F.col(MONTH).isin(list(months))
    stray = F.raise_error(F.concat(F.lit("row outside the months to be written: "), MONTH))
    rows = rows.withColumn(MONTH, F.when(inside, F.col(MONTH)).otherwise(stray.cast("string")))
    written = Observation()
    rows = rows.observe(written, *[F.count_if(F.col(MONTH) == m).alias(m) for m in months])
    writer = rows.write.mode("overwrite").partitionBy(MONTH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    for month, n in written.get.items():
        if not n:
            delete_path(keyed.sparkSession, f"{path}/{MONTH}={month}")


def write_matrix_csv(matrix: DataFrame, path: str) -> None:
    """Keyless CSV directory with header, columns in stored order."""
    matrix.select(*MATRIX_CSV_SCHEMA.names).write.mode("overwrite").option("header", True).csv(path)
