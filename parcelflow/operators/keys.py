"""Keys: deterministic dedupe, sequential surrogate keys, joins with group values.

All three avoid funnelling one group or the whole input into a single task:
dedupe is an aggregate with map-side partial results, key numbering works
on range-partitioned slices with per-slice offsets, and group values are
joined back on the key and a salt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.session import ensure_checkpoint_dir

# Tasks that share the rows of one key in ``join_group_values``.
HOT_KEY_SALTS = 16
# A key with more than one part in so many of all rows is joined without moving its rows.
HEAVY_KEYS = 32
# 64-bit words of the largest lookup filter.
FILTER_WORDS = 1 << 20


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row that sorts first by ``order_by``.

    Ties on ``order_by`` are broken by the remaining columns, so the result
    never depends on partitioning. Written as ``min(struct)`` per key: an
    aggregate Spark computes partially on the map side, so a key holding a
    third of all rows is reduced before the shuffle instead of being sorted
    in one task (as ``row_number()`` over the key would).
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    picked = F.min(F.struct(*[F.col(c) for c in order_by + rest])).alias("_first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest]).select(
        *df.columns
    )


def assign_sequential_keys(
    df: DataFrame,
    order_by: Sequence[str],
    start: int | Column,
    key_col: str,
    slices: int | None = None,
) -> DataFrame:
    """Number rows ``start, start+1, ...`` in ``order_by`` order, without a global window.

    1. Range-partition on ``order_by`` into balanced slices and record each
       row's slice id; checkpoint so the slice ids are fixed (the reliable
       checkpoint lives in the cluster's shared checkpoint folder).
    2. Count rows per slice (one row per slice) and turn the counts into
       offsets; this tiny table is broadcast (its size is the slice count).
    3. key = start + offset(slice) + row_number() within the slice.
    ``order_by`` must identify rows uniquely for the numbering to be stable.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = slices or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    sliced = (
        df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order_by])
        .withColumn("_slice", F.spark_partition_id())
        .checkpoint(eager=True)
    )
    counts = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_slice", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_slice").orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(key_col, (first + F.col("_offset") + F.row_number().over(within) - 1).cast("bigint"))
        .drop("_slice", "_offset")
    )


def join_group_values(df: DataFrame, groups: DataFrame, key: str, salts: int = HOT_KEY_SALTS) -> DataFrame:
    """Left-join one narrow row per ``key`` to ``df``, a hot key spread over ``salts`` tasks.

    AQE splits a skewed partition only where both sides of the join are
    plain shuffles, and ``groups`` is an aggregate on the key. So its rows
    are repeated once per salt and ``df`` is dealt out by key and salt.
    """
    other = [F.col(c) for c in df.columns if c != key]
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*other), F.lit(salts)).cast("int"))
    right = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def heavy_hitters(counts: DataFrame, key: str, count: str = "n", most: int = HEAVY_KEYS) -> list:
    """Keys that hold more than one part in ``most`` of all rows; at most ``most`` keys do."""
    total = counts.agg(F.sum(count)).first()[0] or 0
    return [r[0] for r in counts.where(F.col(count) * most > F.lit(total)).select(key).collect()]


def join_heavy_hitters(left: DataFrame, right: DataFrame, key: str, heavy: list) -> DataFrame:
    """Inner join in which the rows of ``heavy`` keys stay where they are.

    ``right`` has one row per key, so its heavy part has ``len(heavy)`` rows and
    is broadcast; all other keys are shuffled, and none of them holds much.
    """
    if not heavy:
        return left.join(right, key)
    is_heavy = F.col(key).isin(heavy)
    spread = left.where(is_heavy).join(F.broadcast(right.where(is_heavy)), key)
    return spread.unionByName(left.where(~is_heavy).join(right.where(~is_heavy), key))


def _filter_word(key: str, words: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words)).cast("int")


def _filter_bits(key: str) -> Column:
    """Three of 64 bits by the key's second hash."""
    h = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("long")
    places = [F.shiftrightunsigned(h, 6 * k).bitwiseAND(63).cast("int") for k in range(3)]
    bits = [F.call_function("shiftleft", one, place) for place in places]
    return bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])


def probably_among(df: DataFrame, key: str, wanted: DataFrame, expected: int) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``wanted``: all that are, and a few others.

    A Bloom filter of the wanted keys, 64-bit words with about four keys each,
    is broadcast (``FILTER_WORDS`` words at most, 16 MB) and tested where ``df``
    is scanned, so an exact join behind it shuffles about as many rows as match.
    With many more keys than the filter has room for, more rows pass.
    """
    words = 1
    while words < FILTER_WORDS and 4 * words < expected:
        words *= 2
    table = wanted.where(F.col(key).isNotNull()).groupBy(_filter_word(key, words).alias("_word")).agg(
        F.bit_or(_filter_bits(key)).alias("_bits")
    )
    tested = df.withColumn("_word", _filter_word(key, words)).join(F.broadcast(table), "_word")
    return tested.where(F.col("_bits").bitwiseAND(_filter_bits(key)) == _filter_bits(key)).select(*df.columns)


def lookup_symmetric_default(
    df: DataFrame,
    a: str,
    b: str,
    pairs: DataFrame,
    value_col: str,
    default: object,
    pair_a: str = "a",
    pair_b: str = "b",
) -> DataFrame:
    """Look up a value for the unordered pair (``a``, ``b``), with a default.

    Both sides are normalised to (least, greatest), so (B, A) finds a value
    stored as (A, B). A pair stored twice keeps its smallest value. The
    pair table is a small lookup; it joins by size.
    """
    norm_pairs = (
        pairs.select(
            F.least(pair_a, pair_b).alias("_lo"),
            F.greatest(pair_a, pair_b).alias("_hi"),
            F.col(value_col).alias("_v"),
        )
        .groupBy("_lo", "_hi")
        .agg(F.min("_v").alias("_v"))
    )
    keyed = df.withColumn("_lo", F.least(a, b)).withColumn("_hi", F.greatest(a, b))
    return (
        keyed.join(norm_pairs, ["_lo", "_hi"], "left")
        .withColumn(value_col, F.coalesce(F.col("_v"), F.lit(default)).cast(pairs.schema[value_col].dataType))
        .drop("_lo", "_hi", "_v")
    )
