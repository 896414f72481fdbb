"""Column expressions, all built-in and inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from upkeep.fixed import ASSET, DAY


def asset_id_from_file(file_name: Column) -> Column:
    """Up to six characters before the four-character suffix of a file name.

    ``_metadata.file_name`` is percent-encoded, so names holding a ``%`` are
    decoded first; a bare ``+`` stands for itself there. This runs once per
    reading, hence plain substrings rather than a regular expression.
    """
    decoded = F.url_decode(F.replace(file_name, F.lit("+"), F.lit("%2B")))
    name = F.when(file_name.contains("%"), decoded).otherwise(file_name)
    stem_length = F.char_length(name) - 4
    return F.substring(name, F.greatest(stem_length - 5, F.lit(1)), F.least(stem_length, F.lit(6)))


def parse_day(text: Column) -> Column:
    """Day from ``YYYY-MM-DD`` text; NULL for anything else.

    A bare cast would also take '2024', '2024-01' or a trailing time of day.
    """
    well_formed = text.rlike(r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z")
    return F.when(well_formed, text.try_cast("date"))


def month_of(day: Column) -> Column:
    """Month text, the partition column of the stored matrix."""
    return F.date_format(day, "yyyy-MM")


def key_bucket(asset: str = ASSET, day: str = DAY) -> Column:
    """Bucket 0..99 of an (asset, day) key.

    It depends on nothing but the key, so a row falls on the same side of a
    split in every run, on every cluster, and all rows of one key stay together.
    """
    key = F.concat_ws("|", F.col(asset), F.col(day).cast("string"))
    head = F.conv(F.substring(F.md5(key), 1, 8), 16, 10)
    return (head.cast("bigint") % 100).cast("int")
