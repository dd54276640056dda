"""A bounded bit array of keys, by which a scan drops rows before they are shuffled.

Spark adds such filters by itself only where one side of a join has a selective condition. Here the
keys come out of an aggregation, so the array is built and tested with ordinary columns. It lets some
other keys pass, never drops one of its own, and so only comes before an exact join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of an array: 512 KB, whatever the number of keys. A million keys let 14 % of other ones pass.
BITS = 1 << 22
_HASHES = 2


def _place(key: Column, seed: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(bits))


def _mask(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def key_bits(keys: DataFrame, key: str, bits: int = BITS) -> Column:
    """The bit array of all values of ``key`` as a subquery, found when the query runs."""
    places = F.array(*(_place(F.col(key), seed, bits) for seed in range(_HASHES)))
    marked = keys.select(F.explode(places).alias("place")).select(
        F.shiftright("place", 6).alias("slot"), _mask(F.col("place")).alias("mask")
    )
    blank = keys.sparkSession.range(bits // 64).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("mask"))
    dense = marked.unionAll(blank).groupBy("slot").agg(F.bit_or("mask").alias("mask"))
    # One row per slot of the array, a fixed number.
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("slot", "mask"))), lambda s: s["mask"])
    return dense.agg(in_order.alias("bits")).scalar()


def may_hold(array: Column, key: Column, bits: int = BITS) -> Column:
    """Whether a value may be among the keys of a bit array; true for each of them."""

    def is_set(seed: int) -> Column:
        place = _place(key, seed, bits)
        slot = F.get(array, F.shiftright(place, 6).cast("int"))
        return slot.bitwiseAND(_mask(place)) != 0

    held = is_set(0)
    for seed in range(1, _HASHES):
        held = held & is_set(seed)
    return held


def only_keys_of(rows: DataFrame, keys: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The ``rows`` whose ``key`` may be among those of ``keys``, to be joined with these."""
    return rows.where(may_hold(key_bits(keys.select(key), key, bits), F.col(key), bits))
