"""A bounded filter of keys: which rows can have a partner, told without moving them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The filter has 2^BITS bits in at most 2^(BITS - 6) rows of two longs, whatever it is built from.
BITS = 22


def _bit(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits)


def key_bits(keys: DataFrame, hashed: Column, bits: int = BITS) -> DataFrame:
    """The filter of 64-bit hashes: rows (_word, _mask), one for each 64 bits of which one is set."""
    at = _bit(hashed, bits)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int"))
    return (
        keys.select(F.shiftright(at, 6).alias("_word"), one.alias("_one")).groupBy("_word").agg(F.bit_or("_one").alias("_mask"))
    )


def with_maybe(rows: DataFrame, hashed: Column, key_filter: DataFrame, name: str, bits: int = BITS) -> DataFrame:
    """Add a flag: whether a row's hash may be among the filter's keys. True for all that are, and for a share of the
    others that grows with the filter's load, up to all of them; never true for a null hash.

    The filter is broadcast: at most 2^(bits - 6) rows of 16 bytes, 1 MB for 22 bits.
    """
    found = (
        rows.withColumn("_at", _bit(hashed, bits))
        .withColumn("_word", F.shiftright("_at", 6))
        .join(F.broadcast(key_filter), "_word", "left")
    )
    hit = F.expr("shiftright(_mask, cast(_at & 63 as int)) & 1") == 1
    return found.withColumn(name, F.coalesce(hit, F.lit(False))).drop("_at", "_word", "_mask")


def maybe_in(rows: DataFrame, hashed: Column, key_filter: DataFrame, bits: int = BITS) -> DataFrame:
    """The rows that may have a partner among the filter's keys. It saves moving rows and never loses one; the exact
    join follows."""
    return with_maybe(rows, hashed, key_filter, "_maybe", bits).filter("_maybe").drop("_maybe")
