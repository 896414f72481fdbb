"""The three jobs."""

from upkeep.plans.matrix import build_matrix, build_stored_matrix, in_months, score_features
from upkeep.plans.scoring import report, score
from upkeep.plans.training import train_and_evaluate

__all__ = [
    "build_matrix",
    "build_stored_matrix",
    "in_months",
    "report",
    "score",
    "score_features",
    "train_and_evaluate",
]
