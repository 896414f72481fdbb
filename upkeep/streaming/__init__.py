"""Streaming jobs."""

from upkeep.streaming.averages import compact_averages, read_averages, update_averages
from upkeep.streaming.scoring import read_scores, score_stream

__all__ = [
    "compact_averages",
    "read_averages",
    "read_scores",
    "score_stream",
    "update_averages",
]
