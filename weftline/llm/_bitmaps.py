"""Bloom filters as tables of bitmaps, and joins that bear hot keys, in DataFrame functions alone.

A filter of `bits` slots is a table (_bucket, _bits) of bitmaps of 2 ** 15 slots
each; buckets without a slot have no row.  A row is tested in a projection after
a join on the bucket: broadcast where the filter's written size is under Spark's
threshold, or always for a filter whose size is bounded by `MOST`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_BITS = 15
#: Slots of a filter that is broadcast whatever it holds: 32 MB.
MOST = 1 << 28
#: A group with more than this part of all rows is hot; there are at most 1 / HOT of them.
HOT = 1 / 1000


def filter_bits(keys: int, per_key: int, most: int | None = None) -> int:
    bits = 1 << max(BUCKET_BITS, math.ceil(math.log2(max(1, keys) * per_key)))
    return min(bits, most) if most else bits


def slot(key: Column, bits: int) -> Column:
    return key.bitwiseAND(F.lit(bits - 1))


def bitmaps(slots: DataFrame) -> DataFrame:
    """The filter whose set slots are those of column `_slot`."""
    return slots.groupBy(F.shiftright("_slot", BUCKET_BITS).alias("_bucket")).agg(F.bitmap_construct_agg(F.col("_slot").bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))).alias("_bits"))


def tested(rows: DataFrame, key: str, bits: int, filled: DataFrame, name: str = "_maybe") -> DataFrame:
    """`rows` with a boolean column `name`: whether the slot of the long column `key` is set."""
    at = slot(F.col(key), bits)
    place = at.bitwiseAND(F.lit((1 << BUCKET_BITS) - 1))
    byte = F.ascii(F.decode(F.substring("_bits", (F.shiftright(place, 3) + 1).cast("int"), F.lit(1)), "ISO-8859-1"))
    one = F.call_function("shiftright", byte, place.bitwiseAND(F.lit(7)).cast("int")).bitwiseAND(F.lit(1)) == 1
    joined = rows.join(filled, F.shiftright(at, BUCKET_BITS) == F.col("_bucket"), "left")
    return joined.select(*rows.columns, F.coalesce(one, F.lit(False)).alias(name))


def sifted(rows: DataFrame, key: str, keys: DataFrame, count: int, per_key: int = 64) -> DataFrame:
    """`rows` with `_maybe`: false only if the long column `key` is surely not in the column of that name of `keys`.

    The filter is at most 32 MB and so is broadcast; past its capacity more
    rows are marked, which costs a shuffle of them and loses nothing.
    """
    bits = filter_bits(count, per_key, MOST)
    return tested(rows, key, bits, F.broadcast(bitmaps(keys.select(slot(F.col(key), bits).alias("_slot")))))


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Joins rows with one row a group, whose column `_size` counts the group's rows among all `n`.

    Rows of hot groups stay where they are: their groups, at most 1 / HOT, are
    broadcast.  No key of what is left holds more than that part of the rows.
    """
    is_hot = F.col("_size") > n * HOT
    hot, cold = F.broadcast(groups.filter(is_hot)), groups.filter(~is_hot)
    return rows.join(hot, keys).unionByName(rows.join(hot.select(*keys), keys, "left_anti").join(cold, keys))
