"""Sets of ids as bitmaps: a row for each run of 32768 ids, made before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.stored import stored

#: Bitmaps of 4 KiB that are broadcast at most.
BROADCAST_BITMAPS = 8192


def _run(value: str) -> Column:
    return F.bitmap_bucket_number(F.col(value))


def _bit(value: str) -> Column:
    return F.bitmap_bit_position(F.col(value))


def registered(ids: DataFrame, column: str, *keys: str) -> DataFrame:
    """(keys, run, bits): the distinct numbers of `column` by keys, repeated or not. Nulls are none.

    A task or-s its ids into bitmaps first, so what is shuffled grows with the numbers' range
    that a task has, not with how often they occur.
    """
    there = ids.filter(F.col(column).isNotNull())
    return there.groupBy(*keys, _run(column).alias("run")).agg(F.bitmap_construct_agg(_bit(column)).alias("bits"))


def counted(registry: DataFrame, *keys: str) -> DataFrame:
    """(keys, n): how many distinct numbers a registry has."""
    return registry.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n"))


def kept(df: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """The rows of `df` whose number is registered; a registry that fits is broadcast, so they stay."""
    held = stored(registry.select(F.col("run").alias("_run"), F.col("bits").alias("_bits")), "registry")
    few = held.count() <= BROADCAST_BITMAPS
    # the row travels as one value, so columns of any name do
    rows = df.select(F.struct(*map(_quoted, df.columns)).alias("row"), _run(column).alias("_run"), F.col(column).alias("number"))
    met = rows.join(F.broadcast(held) if few else held, "_run")
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(_bit("number"), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    power = F.call_function("shiftleft", F.lit(1), _bit("number").bitwiseAND(F.lit(7)).cast("int"))
    return met.filter(byte.bitwiseAND(power) != 0).select("row.*")


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")
