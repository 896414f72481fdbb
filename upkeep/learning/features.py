"""Stages that prepare labels and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
    VectorIndexerModel,
)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from upkeep.fixed import FEATURES, LABEL, LABELS

MAX_CATEGORIES = 4


def assembler(features: Sequence[str] = FEATURES, incomplete: str = "error") -> VectorAssembler:
    """Features vector.

    A NULL feature fails the job, unless ``incomplete`` says "skip" (such rows
    are left out) or "keep" (it becomes NaN).
    """
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid=incomplete
    )


def label_indexer(
    matrix: DataFrame | None = None, label: str = LABEL, order: str = "fixed"
) -> StringIndexerModel:
    """Label text to index.

    ``order="fixed"`` always gives 0 to "no maintenance" and 1 to "unscheduled
    maintenance", with no pass over the data. Any ``stringOrderType`` of MLlib
    works too and is fitted on ``matrix``; by frequency, the meaning of 0
    depends on which label prevails.
    """
    if order == "fixed":
        return StringIndexerModel.from_labels(LABELS, inputCol=label, outputCol="indexedLabel")
    return StringIndexer(inputCol=label, outputCol="indexedLabel", stringOrderType=order).fit(
        matrix
    )


def label_index(matrix: DataFrame, label: str = LABEL, order: str = "frequencyDesc") -> DataFrame:
    """Each label with its row count and the index that ``label_indexer`` gives it.

    One pass over the matrix; the index is the rank of a label's count, or of its text.
    """
    counted = matrix.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("rows"))
    if order == "fixed":
        known = F.array_position(F.array(*map(F.lit, LABELS)), F.col("label"))
        return counted.withColumn("label_index", (known - 1).cast("double"))
    first = F.col("rows") if order.startswith("frequency") else F.col("label")
    first = first.desc() if order.endswith("Desc") else first.asc()
    ranked = Window.orderBy(first, F.col("label").asc())  # one row per label
    return counted.withColumn("label_index", (F.row_number().over(ranked) - 1).cast("double"))


def feature_indexer(max_categories: int = MAX_CATEGORIES) -> VectorIndexer:
    """Features with few distinct values become categorical.

    A category first seen after fitting gets an index of its own.
    """
    return VectorIndexer(
        inputCol="features",
        outputCol="indexedFeatures",
        maxCategories=max_categories,
        handleInvalid="keep",
    )


def category_map(
    frame: DataFrame, features: Sequence[str], max_categories: int = MAX_CATEGORIES
) -> DataFrame:
    """Feature, value and index of every categorical feature."""
    vectors = assembler(features).transform(frame.select(*features))
    model: VectorIndexerModel = feature_indexer(max_categories).fit(vectors)
    # At most max_categories entries per feature.
    rows = [
        (features[position], float(value), int(index))
        for position, values in model.categoryMaps.items()
        for value, index in values.items()
    ]
    return frame.sparkSession.createDataFrame(
        rows, "feature string, value double, category_index int"
    )
