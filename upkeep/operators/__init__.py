"""Relational operators."""

from upkeep.operators.averages import daily_average
from upkeep.operators.copies import pack_copies, spread, unpack_copies
from upkeep.operators.hotkeys import hot_keys, join_on_keys
from upkeep.operators.keyed import Keyed, join_keyed
from upkeep.operators.keyfilter import filter_bits, key_filter, maybe_in
from upkeep.operators.labels import horizon_label, interruption_days, interruption_spans
from upkeep.operators.requests import (
    Asked,
    as_asked,
    for_requests,
    is_valid,
    request_features,
    take_requests,
)
from upkeep.operators.split import random_split, split, with_side

__all__ = [
    "Asked",
    "Keyed",
    "as_asked",
    "daily_average",
    "filter_bits",
    "for_requests",
    "horizon_label",
    "hot_keys",
    "interruption_days",
    "interruption_spans",
    "is_valid",
    "join_keyed",
    "join_on_keys",
    "key_filter",
    "maybe_in",
    "pack_copies",
    "random_split",
    "request_features",
    "split",
    "spread",
    "take_requests",
    "unpack_copies",
    "with_side",
]
