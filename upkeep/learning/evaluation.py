"""Evaluation of predictions against labels, by counting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(
    predictions: DataFrame, label: str = "indexedLabel", prediction: str = "prediction"
) -> DataFrame:
    """Rows per (label, prediction).

    The only pass over the predictions: one partial sum per pair and map task.
    The measures below are computed from this handful of counts.
    """
    return predictions.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def _hits() -> Column:
    return F.sum(F.when(F.col("label") == F.col("prediction"), F.col("rows")).otherwise(0))


def accuracy(counts: DataFrame) -> DataFrame:
    """Accuracy and test error as (metric, value, rows)."""
    total = counts.agg(_hits().alias("hits"), F.sum("rows").alias("rows"))
    share = F.col("hits") / F.col("rows")
    return total.select(
        F.stack(F.lit(2), F.lit("accuracy"), share, F.lit("test_error"), 1 - share).alias(
            "metric", "value"
        ),
        "rows",
    )


def recall_by_label(counts: DataFrame) -> DataFrame:
    """Recall of every label that occurs, with its hits and rows."""
    return (
        counts.filter(F.col("label").isNotNull())
        .groupBy("label")
        .agg(_hits().alias("hits"), F.sum("rows").alias("rows"))
        .select("label", "hits", "rows", (F.col("hits") / F.col("rows")).alias("recall"))
    )


def metrics(
    predictions: DataFrame, label: str = "indexedLabel", prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, test error and the recall of each label as (metric, label, value, rows)."""
    counts = confusion(predictions, label, prediction)
    overall = accuracy(counts).select(
        "metric", F.lit(None).cast("double").alias("label"), "value", "rows"
    )
    recalls = recall_by_label(counts).select(
        F.lit("recall").alias("metric"), "label", F.col("recall").alias("value"), "rows"
    )
    return overall.unionByName(recalls)
