"""Joins by (asset, day) that survive one key holding a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import KEYS
from upkeep.operators.copies import CHUNK, pack_copies, unpack_copies


#: Rows of one key that one task may receive.
ROWS_PER_PIECE = 1_000_000
#: Hot keys handed on as a literal table, at most.
LITERAL_KEYS = 100_000


def hot_keys(
    frame: DataFrame, keys: list[str] = KEYS, rows_per_piece: int = ROWS_PER_PIECE
) -> DataFrame | None:
    """Keys with more than ``rows_per_piece`` rows and the number of pieces to deal them to.

    None if there are none. The limit does not grow with the data, so no piece does.
    Up to ``LITERAL_KEYS`` such keys become a literal table, of which Catalyst knows
    the size; more stay a plan, joined as Catalyst sees fit. One pass over the key
    columns of ``frame``, with partial counts.
    """
    counts = frame.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.filter(F.col("_n") > rows_per_piece).select(
        *keys, F.ceil(F.col("_n") / rows_per_piece).cast("int").alias("_pieces")
    )
    found = hot.limit(LITERAL_KEYS + 1).collect()
    if not found:
        return None
    if len(found) > LITERAL_KEYS:
        return hot
    return frame.sparkSession.createDataFrame(found, hot.schema)


def join_on_keys(
    left: DataFrame,
    right: DataFrame,
    how: str = "inner",
    hot: DataFrame | None = None,
    keys: list[str] = KEYS,
    chunk: int = CHUNK,
) -> DataFrame:
    """Inner or left join where ``right`` may repeat keys.

    ``left`` should hold few rows per key. Without hot keys this is the plain
    join. With them (``hot_keys(right)``) the right rows of a hot key are dealt
    out to numbered pieces by their content and the few left rows of that key
    are repeated once per piece; every other key has the single piece 0.
    Nothing depends on row order, so a task that is run again deals alike.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if hot is None:
        return left.join(right, keys, how)

    packed = pack_copies(right.join(hot, keys, "left_semi"), chunk)
    if how == "left":
        # Deal out only keys that right holds now; a key found hot in an earlier
        # state of it may be gone. The packed rows are shuffled once for both uses.
        hot = hot.join(packed.select(*keys).distinct(), keys, "left_semi")
    cold_rows = right.join(hot, keys, "left_anti").select(
        "*",
        F.lit(0).cast("bigint").alias("_chunk"),
        F.lit(1).cast("bigint").alias("_copies"),
        F.lit(0).alias("_piece"),
    )
    hash_of_row = F.xxhash64(*[c for c in packed.columns if c != "_copies"])
    hot_rows = (
        packed.withColumn("_hash", hash_of_row)
        .join(hot, keys)
        .withColumn("_piece", F.pmod("_hash", F.col("_pieces")).cast("int"))
        .drop("_hash", "_pieces")
    )
    pieces = F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1)
    repeated = left.join(hot, keys, "left").withColumn("_piece", F.explode(pieces))
    joined = repeated.join(cold_rows.unionByName(hot_rows), [*keys, "_piece"], how)
    if how == "left":
        # Some piece of a hot key has right rows; the pieces without are no result.
        joined = joined.filter(F.col("_copies").isNotNull() | F.col("_pieces").isNull())
        joined = joined.withColumn("_copies", F.coalesce("_copies", F.lit(1)))
    return unpack_copies(joined).drop("_piece", "_pieces")
