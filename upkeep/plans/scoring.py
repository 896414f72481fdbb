"""Scoring job: requests -> one keyed verdict each."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import ASSET, DAY, FEATURES, SCORED
from upkeep.operators import Asked, request_features
from upkeep.operators.requests import BROADCAST_KEYS


def score(
    requests: DataFrame | Asked,
    daily: DataFrame,
    utilization: DataFrame,
    model: PipelineModel,
    find_hot: bool = False,
    max_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Every request with status, features, prediction and verdict.

    Requests without complete features keep their row: prediction and verdict
    are NULL and the status says why. One pass scores all rows; gaps are
    filled for the model only and the results for them dropped. ``find_hot`` as in
    ``request_features``.
    """
    known = request_features(requests, daily, utilization, find_hot, max_keys)
    filled = known.withColumn("_given", F.struct(*FEATURES)).withColumns(
        {name: F.coalesce(name, F.lit(0.0)) for name in FEATURES}
    )
    scored = F.col("status") == SCORED
    return model.transform(filled).select(
        *[c for c in known.columns if c not in FEATURES],
        *[F.col(f"_given.{name}").alias(name) for name in FEATURES],
        F.when(scored, F.col("prediction")).alias("prediction"),
        F.when(scored, F.col("verdict")).alias("verdict"),
    )


def report(scores: DataFrame) -> DataFrame:
    """The scores for reading: day as text, status, prediction and verdict.

    A malformed day shows as it was requested.
    """
    return scores.select(
        ASSET,
        F.coalesce(F.date_format(DAY, "yyyy-MM-dd"), "requested_day").alias(DAY),
        "requests",
        "status",
        "prediction",
        "verdict",
    )
