"""A filter of fixed size for keys that are too many to broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from upkeep.fixed import KEYS

#: Bits for each key, up to a number of bits that take 32 MB.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
#: Words of 64 bits that travel as one row.
WORDS = 256


def filter_bits(keys: int) -> int:
    """Size of the filter for so many keys: a power of two, ``MOST_BITS`` at most."""
    return min(MOST_BITS, 1 << (max(64 * WORDS, keys * BITS_PER_KEY) - 1).bit_length())


def bit_of(bits: int, keys: list[str] = KEYS) -> Column:
    """The number of a key's bit."""
    return F.pmod(F.xxhash64(*keys), F.lit(bits))


def whole(number: Column, by: int) -> Column:
    return F.floor(number / by).cast("bigint")


def key_filter(keys: DataFrame, bits: int, names: list[str] = KEYS) -> DataFrame:
    """The bits of all keys, as rows of ``_block`` and ``_words``, an array of longs.

    However many keys there are, there are ``bits / 64 / WORDS`` rows at most. Words are
    put together on the map side, and a block gets ``WORDS`` of them at most.
    """
    words = (
        keys.select(bit_of(bits, names).alias("_bit"))
        .groupBy(whole(F.col("_bit"), 64).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(_bit % 64 AS INT))")).alias("_set"))
    )
    held = F.map_from_entries(F.collect_list(F.struct(F.col("_word") % WORDS, "_set")))
    places = F.sequence(F.lit(0).cast("bigint"), F.lit(WORDS - 1).cast("bigint"))
    filled = F.transform(
        places, lambda i: F.coalesce(F.try_element_at("_held", i), F.lit(0).cast("bigint"))
    )
    return (
        words.groupBy(whole(F.col("_word"), WORDS).alias("_block"))
        .agg(held.alias("_held"))
        .select("_block", filled.alias("_words"))
    )


def maybe_in(
    frame: DataFrame, keys: DataFrame, bits: int, names: list[str] = KEYS
) -> DataFrame:
    """The rows whose key's bit is set by some row of ``keys``: all that have one of these
    keys, and of ``n`` keys in ``bits`` bits up to ``n / bits`` of the others.

    The filter is broadcast; its size does not depend on the data. Being a semi-join by
    the key columns alone, it is taken below an aggregate by these: of averages, the
    readings are filtered before they are summed and shuffled.
    """
    bit = bit_of(bits, names)
    word = F.get("_words", (whole(bit, 64) % WORDS).cast("int"))
    is_set = F.getbit(word, (bit % 64).cast("int"))
    match = (whole(bit, 64 * WORDS) == F.col("_block")) & (is_set == 1)
    return frame.join(F.broadcast(key_filter(keys, bits, names)), match, "left_semi")
