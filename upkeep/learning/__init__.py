"""Feature preparation, training and evaluation with MLlib."""

from upkeep.learning.evaluation import accuracy, confusion, metrics, recall_by_label
from upkeep.learning.features import (
    assembler,
    category_map,
    feature_indexer,
    label_index,
    label_indexer,
)
from upkeep.learning.tree import SEED, Training, predict, preview, train, tree_summary

__all__ = [
    "SEED",
    "Training",
    "accuracy",
    "assembler",
    "category_map",
    "confusion",
    "feature_indexer",
    "label_index",
    "label_indexer",
    "metrics",
    "predict",
    "preview",
    "recall_by_label",
    "train",
    "tree_summary",
]
