"""Joins of tables that are stored in buckets of (asset, day)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import KEYS
from upkeep.operators.hotkeys import LITERAL_KEYS


@dataclass
class Keyed:
    """A stored table.

    ``bucketed`` holds most rows; ``loose`` those of the keys in ``hot``, of which there are
    ``hot_keys``, and those without a full key.
    """

    bucketed: DataFrame
    loose: DataFrame
    hot: DataFrame
    buckets: int
    hot_keys: int

    def rows(self) -> DataFrame:
        return self.bucketed.unionByName(self.loose)


def join_keyed(left: DataFrame, right: Keyed) -> DataFrame:
    """Inner join by (asset, day) with a stored table that may repeat keys very often.

    ``left`` has one row per key; if it comes from as many buckets, neither side is
    shuffled. The rows of hot keys stay where they are read: the one row that each of
    these keys has on the left is broadcast to them, up to ``LITERAL_KEYS`` rows by the
    count that was stored; for more keys Spark chooses.
    """
    joined = left.join(right.bucketed, KEYS)
    if not right.hot_keys:
        return joined
    few = right.hot_keys <= LITERAL_KEYS
    hot = F.broadcast(right.hot) if few else right.hot
    named = left.join(hot, KEYS, "left_semi")
    return joined.unionByName((F.broadcast(named) if few else named).join(right.loose, KEYS))
