"""The maintenance label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from upkeep.fixed import ASSET, DAY, HORIZON_DAYS, KEYS, LABEL, NEGATIVE, POSITIVE


def check_window(before: int, after: int) -> None:
    """A window that ends before it begins would be expanded backwards."""
    if before + after < 0:
        raise ValueError(f"the window from {-before} to {after} days ends before it begins")


def _known(interruptions: DataFrame) -> DataFrame:
    return interruptions.filter(F.col(ASSET).isNotNull() & F.col("start_day").isNotNull())


def _window(before: int, after: int) -> Column:
    return F.explode(
        F.sequence(F.date_sub("start_day", before), F.date_add("start_day", after))
    ).alias(DAY)


def interruption_days(
    interruptions: DataFrame, before: int = HORIZON_DAYS, after: int = 0
) -> DataFrame:
    """Distinct (asset, day) pairs within the window around some interruption.

    The window is [start - before, start + after], both ends included. Rows
    without an asset or a start are ignored. Overlapping windows collapse,
    partly on the map side, so a much-interrupted asset stays small.
    """
    check_window(before, after)
    return _known(interruptions).select(ASSET, _window(before, after)).distinct()


#: Days of a window from which on it is not expanded any more.
WIDE = 62


def interruption_spans(
    interruptions: DataFrame, before: int = HORIZON_DAYS, after: int = 0
) -> DataFrame:
    """The same days as disjoint spans: asset_id, first, last; overlapping and touching
    windows of an asset are one. There are no more spans than interruptions.

    Only distinct starts are sorted, of which an asset has at most one per calendar day.
    """
    check_window(before, after)
    starts = _known(interruptions).select(ASSET, "start_day").distinct()
    first, last = F.date_sub("start_day", before), F.date_add("start_day", after)
    windows = starts.select(ASSET, first.alias("first"), last.alias("last"))
    by_day = Window.partitionBy(ASSET).orderBy("first")
    # All windows are of one length, so the one before reaches furthest.
    apart = F.coalesce(F.lag("last").over(by_day) < F.date_sub("first", 1), F.lit(True))
    numbered = windows.withColumn("_apart", apart.cast("int"))
    numbered = numbered.withColumn("_span", F.sum("_apart").over(by_day))
    spans = numbered.groupBy(ASSET, "_span").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return spans.drop("_span")


def _flag_by_span(base: DataFrame, spans: DataFrame) -> DataFrame:
    """base with ``_hit``: does the last span that began by a row's day reach it?

    Rows and span starts of an asset are put in one order by day, instead of a row per
    day of each span. An asset has a row per day at most, averages being keyed so. Rows
    without asset or day hit nothing and are kept out of the sort.
    """
    known = F.col(ASSET).isNotNull() & F.col(DAY).isNotNull()
    nothing = base.filter(~known).withColumn("_hit", F.lit(None).cast("boolean"))
    rows = base.filter(known).withColumns({"_last": F.lit(None).cast("date"), "_row": F.lit(1)})
    starts = spans.select(
        ASSET, F.col("first").alias(DAY), F.col("last").alias("_last"), F.lit(0).alias("_row")
    )
    so_far = Window.partitionBy(ASSET).orderBy(DAY, "_row").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.last("_last", ignorenulls=True).over(so_far)
    placed = rows.unionByName(starts, allowMissingColumns=True).withColumn("_reach", reach)
    hit = F.when(F.col("_reach") >= F.col(DAY), True)
    flagged = placed.filter("_row = 1").withColumn("_hit", hit)
    return flagged.select(*base.columns, "_hit").unionByName(nothing)


def horizon_label(
    base: DataFrame,
    interruptions: DataFrame,
    before: int = HORIZON_DAYS,
    after: int = 0,
    match: str = "pair",
    buckets: int | None = None,
) -> DataFrame:
    """Add the label: does a row's day lie in the window of an interruption?

    ``match="pair"``: of an interruption of the same asset. With the defaults,
    a row is positive if its asset is interrupted that day or in the 7 days
    that follow. One equi-join on (asset, day), with a row per day of the windows; from
    ``WIDE`` days on spans are looked up instead, and rows do not grow with the windows.

    ``match="independent"``: the day lies in the window of any interruption and
    the asset has any interruption; the two need not belong together.

    Rows are neither lost nor repeated. Label the daily averages, which have
    one row per key, before joining tables that repeat keys: they arrive
    partitioned by key, so the paired join only shuffles the interruptions. For averages
    stored in ``buckets`` the interruption days are dealt out as these are, whatever the
    session's number of shuffle partitions.
    """
    check_window(before, after)
    if match == "pair" and before + after >= WIDE:
        flagged = _flag_by_span(base, interruption_spans(interruptions, before, after))
        hit = F.col("_hit")
    elif match == "pair":
        hits = interruption_days(interruptions, before, after)
        if buckets is not None:
            hits = hits.repartition(buckets, *KEYS)
        flagged = base.join(hits.withColumn("_hit", F.lit(True)), KEYS, "left")
        hit = F.col("_hit")
    elif match == "independent":
        known = _known(interruptions)
        # Averages have at most one row per asset and day, so none is a hot asset.
        assets = known.select(ASSET).distinct().withColumn("_asset_hit", F.lit(True))
        # One row per calendar day: a DATE has some 3.7 million values in all,
        # which bounds what is broadcast however many interruptions there are.
        starts = known.select("start_day").distinct()
        days = starts.select(_window(before, after)).distinct().withColumn("_day_hit", F.lit(True))
        flagged = base.join(F.broadcast(days), DAY, "left").join(assets, ASSET, "left")
        hit = F.col("_day_hit") & F.col("_asset_hit")
    else:
        raise ValueError(f"unknown match: {match}")
    label = F.when(hit, POSITIVE).otherwise(NEGATIVE).alias(LABEL)
    return flagged.select(*base.columns, label)
