"""Sinks."""

from upkeep.sinks.batches import Batches
from upkeep.sinks.keyed import bucket_count, write_keyed
from upkeep.sinks.matrix import write_by_month, write_matrix_csv
from upkeep.sinks.model import read_model, write_model

__all__ = [
    "Batches",
    "bucket_count",
    "read_model",
    "write_by_month",
    "write_keyed",
    "write_matrix_csv",
    "write_model",
]
