"""A blocked Bloom filter made of DataFrame columns.

A block is one 64-bit word, and a key sets PROBES bits of one block.  The
filter is a table (block, word) whose number of rows is capped, so
broadcasting it is bounded whatever the list's size: beyond the cap it only
passes more keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 5
BITS_PER_KEY = 16
#: Rows of the filter at most: 12 MB of numbers are broadcast.
MAX_BLOCKS = 1 << 19


def blocks_for(keys: int) -> int:
    """A power of two with BITS_PER_KEY bits for each key, up to MAX_BLOCKS blocks."""
    wanted = max(1, -(-keys * BITS_PER_KEY // 64))
    return min(MAX_BLOCKS, 1 << (wanted - 1).bit_length())


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(bits: Column) -> Column:
    """A key's bits in its block: each probe takes six bits of a second hash."""
    ones = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(bits, 6 * p).bitwiseAND(F.lit(63)).cast("int")) for p in range(PROBES)]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def _second(key: Column) -> Column:
    return F.xxhash64(key, F.lit(7))


def build(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of the non-null values of ``key``: at most ``blocks`` rows, made with a map-side OR."""
    marked = keys.filter(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), _second(F.col(key)).alias("bits"))
    return marked.groupBy("block").agg(F.bit_or(_mask(F.col("bits"))).alias("word"))


def maybe(df: DataFrame, key: Column, filt: DataFrame, blocks: int, name: str) -> DataFrame:
    """``df`` with the boolean ``name``: false if ``key`` is surely not in the filter (null keys are not)."""
    block, bits, word = f"{name}_block", f"{name}_bits", f"{name}_word"
    side = filt.select(F.col("block").alias(block), F.col("word").alias(word))
    probed = df.select("*", F.when(key.isNotNull(), _block(key, blocks)).alias(block), F.when(key.isNotNull(), _second(key)).alias(bits))
    joined = probed.join(F.broadcast(side), block, "left")
    inside = F.col(word).bitwiseAND(_mask(F.col(bits))) == _mask(F.col(bits))
    return joined.select(*df.columns, F.coalesce(inside, F.lit(False)).alias(name))


def shortlist(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose ``column`` may occur in ``keys.key``: what a join with the keys need shuffle.  ``keys`` is counted."""
    blocks = blocks_for(keys.count())
    return maybe(df, F.col(column), build(keys, key, blocks), blocks, "maybe_in_list").filter("maybe_in_list").drop("maybe_in_list")
