"""Blocked Bloom filters as DataFrames, small enough to broadcast whatever their keys number.

A filter has up to ``MOST_BLOCKS`` blocks of eight 64-bit words. A key has one
block and one bit in each of its words, so a test reads one row. More keys than
the filter has room for make more false hits, never a false miss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
BITS_PER_KEY = 16
# 131,072 blocks of 8 words: 9.4 MB with their numbers
MOST_BLOCKS = 1 << 17


def block_count(n: int) -> int:
    blocks = 1
    while blocks * 64 * WORDS < n * BITS_PER_KEY and blocks < MOST_BLOCKS:
        blocks *= 2
    return blocks


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """The key's bit in each word of its block."""
    mixed = F.xxhash64(key, F.lit(1))
    return [
        F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(mixed, 6 * j).bitwiseAND(F.lit(63)).cast("int"))
        for j in range(WORDS)
    ]


def blocked_bloom(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """``block, w0 .. w7`` over the keys in ``column``; one partial ``bit_or`` per block."""
    key = F.col(column)
    bits = keys.select(_block(key, blocks).alias("block"), *(b.alias(f"w{j}") for j, b in enumerate(_bits(key))))
    return bits.groupBy("block").agg(*(F.bit_or(f"w{j}").alias(f"w{j}") for j in range(WORDS)))


def with_possible(rows: DataFrame, column: str, keys: DataFrame, key_column: str, flag: str = "possible") -> DataFrame:
    """Adds ``flag``: false where ``column`` surely is none of ``keys`` (a stored table), as for null."""
    blocks = block_count(keys.count())
    bloom = F.broadcast(blocked_bloom(keys, key_column, blocks).withColumnRenamed("block", "_block"))
    hit = F.lit(True)
    for j, bit in enumerate(_bits(F.col(column))):
        hit = hit & (F.col(f"w{j}").bitwiseAND(bit) != 0)
    return (
        rows.withColumn("_block", _block(F.col(column), blocks))
        .join(bloom, "_block", "left")
        .withColumn(flag, F.col(column).isNotNull() & F.coalesce(hit, F.lit(False)))
        .drop("_block", *(f"w{j}" for j in range(WORDS)))
    )
