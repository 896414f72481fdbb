"""Matrix job: readings + utilization + interruptions -> labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import AVERAGE, DAY, FEATURES, HORIZON_DAYS, KEYS, KPIS, LABEL
from upkeep.operators import (
    Asked,
    Keyed,
    as_asked,
    for_requests,
    horizon_label,
    hot_keys,
    join_keyed,
    join_on_keys,
)
from upkeep.operators.requests import BROADCAST_KEYS


def build_matrix(
    daily: DataFrame,
    utilization: DataFrame,
    interruptions: DataFrame,
    before: int = HORIZON_DAYS,
    after: int = 0,
    match: str = "pair",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Keyed matrix rows: averages, KPIs and label.

    The averages have one row per key and are grouped by it already, so they
    are labelled first. Utilization, the only input that may repeat a key, is
    joined last; pass ``hot=hot_keys(utilization)`` unless its keys are unique.
    """
    labelled = horizon_label(daily.select(*KEYS, AVERAGE), interruptions, before, after, match)
    return join_on_keys(labelled, utilization, "inner", hot).select(*KEYS, AVERAGE, *KPIS, LABEL)


def build_stored_matrix(
    daily: Keyed,
    utilization: Keyed,
    interruptions: DataFrame,
    before: int = HORIZON_DAYS,
    after: int = 0,
    match: str = "pair",
) -> DataFrame:
    """``build_matrix`` over averages and utilization stored in as many buckets.

    Only the interruption days are shuffled. The label ``match="independent"`` looks up
    assets too, for which the averages are shuffled once more.
    """
    labelled = horizon_label(
        daily.bucketed.select(*KEYS, AVERAGE), interruptions, before, after, match, daily.buckets
    )
    return join_keyed(labelled, utilization).select(*KEYS, AVERAGE, *KPIS, LABEL)


def in_months(keyed: DataFrame, months: Sequence[str]) -> DataFrame:
    """The rows of some months (``YYYY-MM``), by their days, which scans can be asked for."""
    wanted = F.lit(False)
    for month in months:
        first = F.to_date(F.lit(f"{month}-01"))
        wanted = wanted | F.col(DAY).between(first, F.last_day(first))
    return keyed.filter(wanted)


def score_features(
    requests: DataFrame | Asked,
    daily: DataFrame,
    utilization: DataFrame,
    find_hot: bool = False,
    max_keys: int = BROADCAST_KEYS,
) -> DataFrame:
    """Features of the requested keys that have both readings and utilization."""
    asked = as_asked(requests)
    averages = for_requests(daily, asked, max_keys).select(*KEYS, AVERAGE)
    kpis = for_requests(utilization, asked, max_keys)
    hot = hot_keys(kpis) if find_hot else None
    return join_on_keys(averages, kpis, "inner", hot).select(*KEYS, *FEATURES)
