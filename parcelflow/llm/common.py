"""Shared pieces of the text operators: scratch tables, chunking, words, shingles."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.session import ensure_checkpoint_dir

# Text bytes that a Python worker handles at once. A longer text is a chunk of its own.
CHUNK_BYTES = 8 << 20
BATCH_ROWS = 2000
SHINGLE_WORDS = 5


def share_package(spark: SparkSession) -> None:
    """Lets Python workers on this machine import this package wherever the session was started from.

    On a cluster the package comes with the job (``--py-files``) or is installed.
    """
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``)."""
    share_package(spark)
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    Cuts the lineage: later steps reread files that outlive an executor. The
    scan knows its size, and its joins are plain shuffles that AQE can split.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: list[str], spread: str, salts: int = 16, how: str = "left"
) -> DataFrame:
    """Join whose hot left keys are spread over ``salts`` tasks.

    ``right`` holds few rows per key; each is repeated once per salt.
    ``spread`` is a left column that differs among the rows of a key.
    """
    a = left.withColumn("_salt", F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int"))
    b = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return a.join(b, [*keys, "_salt"], how).drop("_salt")


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of record batches that hold about ``most`` bytes of ``column`` at most (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size.astype(np.int64))
        lo = 0
        while lo < len(ends):
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def short_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches at ``BATCH_ROWS`` rows where nobody has set them.

    Spark's default of 10,000 rows holds too many texts for a worker.
    """
    share_package(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(BATCH_ROWS))
    return df


def released(out: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``out``, after which Arrow's pool gives back what it holds free: workers live on into later stages."""
    yield from out
    pa.default_memory_pool().release_unused()


def mapped(
    df: DataFrame,
    fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    column: str = "text",
    most: int = CHUNK_BYTES,
) -> DataFrame:
    """``mapInArrow`` over bounded chunks; ``fn`` turns one chunk into one batch (or none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, column, most):
            out = fn(part)
            if out is not None and out.num_rows:
                yield out

    return short_batches(df).mapInArrow(lambda batches: released(run(batches)), schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> pa.Array:
    """The column with nulls as empty texts."""
    return pc.fill_null(batch.column(column), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text, A-Z in lower case.

    Returns offsets (one more than texts), a code per word and the distinct words.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    codes = encoded.indices.to_numpy()
    return drop_words(offsets - offsets[0], codes, encoded.dictionary, pc.equal(encoded.dictionary, ""))


def drop_words(offsets, codes, words, unwanted) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Take the words for which ``unwanted`` is true out of every text."""
    bad = unwanted.to_numpy(zero_copy_only=False)
    if not bad.any():
        return offsets, codes, words
    keep = ~bad[codes]
    seen = np.concatenate(([0], np.cumsum(keep)))
    return seen[offsets], codes[keep], words


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    return x * np.uint64(0xD6E8FEB86659FD93)


def word_hashes(words: pa.Array) -> np.ndarray:
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(w) for w in words.to_pylist()), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, n: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit hash of every run of ``n`` consecutive words."""
    out = hashes[: len(hashes) - n + 1].copy()
    for j in range(1, n):
        out = mix(out) + hashes[j : len(hashes) - n + 1 + j]
    return mix(out)


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Per text, its sorted distinct shingle hashes.

    With fewer words than a shingle the whole sequence counts as one; a text
    without words has the empty set.
    """
    offsets, codes, words = split_words(texts)
    hashes = word_hashes(words)[codes] if len(codes) else np.empty(0, np.uint64)
    runs = shingle_hashes(hashes) if len(hashes) >= SHINGLE_WORDS else np.empty(0, np.uint64)
    for lo, hi in zip(offsets[:-1], offsets[1:], strict=True):
        if hi - lo >= SHINGLE_WORDS:
            found = np.sort(runs[lo : hi - SHINGLE_WORDS + 1])
            yield found[np.concatenate(([True], found[1:] != found[:-1]))]
        elif hi > lo:
            yield shingle_hashes(hashes[lo:hi], int(hi - lo))
        else:
            yield np.empty(0, np.uint64)
