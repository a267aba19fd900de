"""Membership by a broadcast bit map of fixed size, so that rows without a match need no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a membership map: 2048 rows of 4 KiB, 8 MiB in all, whatever the number of keys.
MAP_BITS = 1 << 26
BITS_PER_ROW = 1 << 15


def with_membership(rows: DataFrame, key: Column, members: DataFrame, member: Column, name: str) -> DataFrame:
    """A boolean column: false means that the row's key is surely not among the members.

    The members set bits in a map of fixed size, which is broadcast; its size does not grow with
    them. Different keys may share a bit, so true only means "perhaps": an exact join follows.
    """

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(MAP_BITS))

    def of_row(bit: Column) -> Column:
        return F.floor(bit / BITS_PER_ROW).cast("int")

    bits = members.select(place(member).alias("bit")).select(
        of_row(F.col("bit")).alias(f"{name}_row"), (F.col("bit") % BITS_PER_ROW).alias("bit")
    )
    maps = bits.groupBy(f"{name}_row").agg(F.bitmap_construct_agg("bit").alias(f"{name}_map"))
    placed = rows.withColumn(f"{name}_bit", place(key))
    placed = placed.withColumn(f"{name}_row", of_row(F.col(f"{name}_bit")))
    joined = placed.join(F.broadcast(maps), f"{name}_row", "left")
    byte = f"substring({name}_map, cast({name}_bit % {BITS_PER_ROW} div 8 as int) + 1, 1)"
    is_set = F.expr(f"shiftright(cast(conv(hex({byte}), 16, 10) as int), cast({name}_bit % 8 as int)) & 1 = 1")
    found = joined.withColumn(name, F.coalesce(is_set, F.lit(False)))
    return found.drop(f"{name}_bit", f"{name}_row", f"{name}_map")
