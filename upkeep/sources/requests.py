"""Scoring requests from any batch or streaming frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upkeep.fixed import ASSET, DAY
from upkeep.functions import parse_day


def read_requests(frame: DataFrame, day: str = "timeid", asset: str = "aircraftid") -> DataFrame:
    """Requests as (asset_id, day, requested_day text).

    A text day must read ``YYYY-MM-DD``, otherwise ``day`` is NULL and
    ``requested_day`` keeps the text; a date or timestamp column is taken as it
    is. Works row by row, so ``frame`` may be a stream.
    """
    if isinstance(frame.schema[day].dataType, T.StringType):
        parsed, given = parse_day(F.col(day)), F.col(day)
    else:
        parsed, given = F.to_date(day), F.lit(None)
    return frame.select(
        F.col(asset).cast("string").alias(ASSET),
        parsed.alias(DAY),
        F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), given).alias("requested_day"),
    )
