"""Column expressions."""

from upkeep.functions.columns import (
    asset_id_from_file,
    key_bucket,
    month_of,
    parse_day,
)

__all__ = ["asset_id_from_file", "key_bucket", "month_of", "parse_day"]
