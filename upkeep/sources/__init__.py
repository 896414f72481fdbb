"""Sources."""

from upkeep.sources.keyed import read_keyed
from upkeep.sources.matrix import read_matrix, read_matrix_csv
from upkeep.sources.readings import read_readings, stream_readings, union_readings
from upkeep.sources.requests import read_requests
from upkeep.sources.tables import (
    day_predicates,
    interruptions_from,
    jdbc_options,
    read_jdbc,
    read_jdbc_by_day,
    read_source,
    utilization_from,
)

__all__ = [
    "day_predicates",
    "interruptions_from",
    "jdbc_options",
    "read_jdbc",
    "read_jdbc_by_day",
    "read_keyed",
    "read_matrix",
    "read_matrix_csv",
    "read_readings",
    "read_requests",
    "read_source",
    "stream_readings",
    "union_readings",
    "utilization_from",
]
