"""Keys that occur more than once, found without moving every key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from promolens.operators.key_filter import key_bits, may_hold

#: Bits of the array of groups that hold a repeated key.
BITS = 1 << 20


def _suspects(df: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """Groups of key values that hold a repeated one, as a column ``group``, and the group of a row.

    Whole numbers are taken 64 in a row: there are fewer different ones than rows only if one
    repeats, and numbers that lie together in a file are one row of the shuffle. Other keys are
    told apart by 48 bits of hash.
    """
    value = F.col(key)
    present = df.where(value.isNotNull())
    if isinstance(df.schema[key].dataType, IntegralType):
        group = F.shiftright(value.cast("long"), 6)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), value.cast("long").bitwiseAND(F.lit(63)).cast("int"))
        groups = present.groupBy(group.alias("group")).agg(F.count("*").alias("n"), F.bit_or(bit).alias("seen"))
        return groups.where(F.col("n") > F.bit_count("seen")).select("group"), group
    group = F.shiftrightunsigned(F.xxhash64(value), 16)
    groups = present.groupBy(group.alias("group")).agg(F.count("*").alias("n"))
    return groups.where("n > 1").select("group"), group


def may_repeat(df: DataFrame, key: str, bits: int = BITS) -> Column:
    """Whether a row's key may occur in another row as well: true for all that do, false for NULL."""
    groups, group = _suspects(df, key)
    return F.col(key).isNotNull() & may_hold(key_bits(groups, "group", bits), group, bits)


def repeated_keys(df: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """(key, copies) of the values of ``key`` that occur more than once, and of NULL.

    The rows are read twice. What is shuffled are groups of key values, and the keys of the few groups that a
    bit array lets pass.
    """
    few = df.select(key).where(F.col(key).isNull() | may_repeat(df.select(key), key, bits))
    return few.groupBy(key).agg(F.count("*").alias("copies")).where((F.col("copies") > 1) | F.col(key).isNull())


def one_row_per_key(df: DataFrame, key: str, bits: int = BITS) -> DataFrame:
    """The rows of ``df`` with one row for each key; rows without a key are left out.

    Of several rows with a key the largest one stays, compared column by column in their order, NULL being the
    smallest. Only rows whose key may repeat are grouped; all others stay where they are.
    """
    others = [c for c in df.columns if c != key]
    again = may_repeat(df, key, bits)
    alone = df.where(F.col(key).isNotNull() & ~again)
    chosen = df.where(again).groupBy(key).agg(F.max(F.struct(*others)).alias("row"))
    return alone.unionByName(chosen.select(key, "row.*"))
