"""Decision tree: training, prediction and summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
)
from pyspark.ml.feature import IndexToString
from pyspark.sql import DataFrame, SparkSession

from upkeep.fixed import FEATURES, KEYS, LABEL
from upkeep.learning.features import (
    MAX_CATEGORIES,
    assembler,
    feature_indexer,
    label_indexer,
)
from upkeep.operators.copies import spread
from upkeep.operators.split import random_split, split

SEED = 17
ROWS_PER_PARTITION = 200_000


@dataclass
class Training:
    """A fitted pipeline with the two sides of its split."""

    model: PipelineModel
    training: DataFrame
    validation: DataFrame


def sides(
    matrix: DataFrame, percent: int, random: bool, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows; a matrix without keys is split by chance."""
    if random or not set(KEYS) <= set(matrix.columns):
        return random_split(matrix, percent, seed)
    return split(matrix, percent)


def laid_out(rows: DataFrame, columns: Sequence[str], partitions: int) -> DataFrame:
    """The columns of the rows, partitioned and ordered by nothing but content."""
    if not set(KEYS) <= set(rows.columns):
        return spread(rows.select(*columns), partitions)
    by = [*KEYS, *columns]
    return rows.select(*by).repartition(partitions, *by).sortWithinPartitions(*by).select(*columns)


def planned_partitions(matrix: DataFrame, percent: int) -> int:
    """Partitions for the training rows of a matrix, from its number of rows alone.

    Of a stored Parquet matrix that number stands in the footers: no column is read.
    """
    return max(1, ceil(matrix.count() * percent / 100 / ROWS_PER_PARTITION))


def train(
    matrix: DataFrame,
    percent: int = 70,
    random: bool = False,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    label_order: str = "fixed",
    max_categories: int = MAX_CATEGORIES,
    fit_indexers_on: str = "training",
    incomplete: str = "error",
    partitions: int | None = None,
    seed: int = SEED,
    **tree: Any,
) -> Training:
    """Split the matrix and fit assembler, indexers, tree and decoder.

    The split goes by key, or with ``random`` by a seeded draw.

    Let the matrix be a stored one: its rows are then the same to the last bit
    whenever a lost part of them is computed again.

    Above some 10 000 rows MLlib samples its split candidates by partition, so
    a tree repeats only for the same rows in the same partitions. The training
    rows are therefore laid out by content, in one shuffle, over a fixed number of
    ``partitions``, which by default follows from the number of rows of the matrix and
    from nothing else. They are cached while fitting, as every level of the tree
    reads them. Rows of a matrix without keys may be alike in large groups, which
    are divided first; with keys, only a repeated utilization row gives like rows.

    ``incomplete`` is for rows with a NULL feature, as in ``assembler``.
    ``fit_indexers_on="all"`` lets the indexers see the validation rows too.
    Further keywords go to ``DecisionTreeClassifier``.
    """
    if fit_indexers_on not in ("training", "all"):
        raise ValueError(f"unknown fit_indexers_on: {fit_indexers_on}")
    training, validation = sides(matrix, percent, random, seed)
    if partitions is None:
        partitions = planned_partitions(matrix, percent)
    stored = laid_out(training, [*features, label], partitions).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        seen = matrix if fit_indexers_on == "all" else stored
        vectors = assembler(features, incomplete)
        labels = label_indexer(seen, label, label_order)
        indexer = feature_indexer(max_categories)
        if fit_indexers_on == "all":
            indexer = indexer.fit(vectors.transform(seen))
        classifier = DecisionTreeClassifier(
            labelCol="indexedLabel", featuresCol="indexedFeatures", seed=seed, **tree
        )
        decoder = IndexToString(
            inputCol="prediction", outputCol="verdict", labels=list(labels.labels)
        )
        model = Pipeline(stages=[vectors, labels, indexer, classifier, decoder]).fit(stored)
    finally:
        stored.unpersist()
    return Training(model, training, validation)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """All columns of ``rows`` with prediction, verdict and, if labelled, its index."""
    return model.transform(rows).drop("features", "indexedFeatures")


def preview(predictions: DataFrame, rows: int = 5) -> DataFrame:
    """The first few predictions by key."""
    return predictions.orderBy(*KEYS, *FEATURES).limit(rows)


def tree_summary(
    spark: SparkSession, model: PipelineModel, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Depth and size of the tree, and the importance of each feature."""
    tree = next(s for s in model.stages if isinstance(s, DecisionTreeClassificationModel))
    rows = [
        (name, float(importance), tree.depth, tree.numNodes)
        for name, importance in zip(features, tree.featureImportances.toArray(), strict=True)
    ]
    return spark.createDataFrame(
        rows, "feature string, importance double, depth int, nodes int"
    )
