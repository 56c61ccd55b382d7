"""Quartile bucket digests of texts, and how alike they are to an edited text and to the next document.

Method: every window of five bytes gives six byte triplets; each is hashed
into one of 256 buckets. The digest holds the length on a
logarithmic scale, two ratios of the buckets' quartiles, and for every bucket
the quartile (0 to 3) that its count falls into. Digests are compared bucket
by bucket with a difference that is bounded, so likeness is 1 minus the
difference over its maximum.

A document's edited text needs the beginning of the next document. Documents
are range-partitioned and sorted by id; a task goes through its range once and
holds two chunks of texts at most. The first and last row of each range travel
on with their texts, and each last row meets the first row of the next range
in a join of two rows per range.

Cases: a null text is empty; an empty text has the digest of no triplet and
length 0; with one or two bytes there is no triplet either. Rows with a null
id come first. Rows of one id follow each other by the hash of their texts,
so repeated rows are each other's next. One document is its own next. An empty
table gives no rows. Other columns are left alone, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import CHUNK_BYTES, chunks, mapped, short_batches, stored, table, texts_of

BUCKETS = 256
WINDOW = 5
# Places of the triplets in a window of five bytes; the first byte is in each, so no triplet counts twice.
TRIPLETS = [(0, i, j) for i in range(1, WINDOW) for j in range(i + 1, WINDOW)]
# Shares of the largest difference that the length and the two ratios can make; the rest are the buckets.
LENGTH_MOST = 12
RATIO_MOST = 15
STEP_COST = np.array([0, 1, 2, 4])  # of a bucket that is 0, 1, 2, 3 quartiles away
MOST = STEP_COST[3] * BUCKETS + LENGTH_MOST + 2 * RATIO_MOST

RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


# Odd multipliers of the three bytes of a triplet and of their sum.
FACTORS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
SPREAD = np.uint32(0x2C1B3C6D)
BLOCK = 1 << 18  # bytes counted at once, so that they stay in the processor's cache


def _counted(texts: list[bytes]) -> np.ndarray:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    dummy = len(texts) * BUCKETS
    row = np.repeat(np.arange(len(texts)) * BUCKETS, lengths)
    ends = np.cumsum(lengths)
    a, b, c = (data * f for f in FACTORS)
    counts = np.zeros(dummy + 1, np.int64)
    for salt, (_, i, j) in enumerate(TRIPLETS):
        n = len(data) - j
        if n <= 0:
            continue
        x = a[:n] + b[i : n + i]
        x += c[j:]
        x += np.uint32(salt << 8)
        x ^= x >> np.uint32(15)
        x *= SPREAD
        x >>= np.uint32(24)
        at = row[:n] + x
        for back in range(1, j + 1):  # triplets that would reach into the next text
            last = ends - back
            at[last[(last >= 0) & (last < n) & (lengths >= back)]] = dummy
        counts += np.bincount(at, minlength=dummy + 1)
    return counts[:dummy].reshape(-1, BUCKETS)


def _long(text: bytes) -> np.ndarray:
    """Counts of one text, a block at a time; the few triplets inside a block's overlap are the next block's."""
    counts = np.zeros(BUCKETS, np.int64)
    for lo in range(0, len(text), BLOCK):
        hi = lo + BLOCK
        counts += _counted([text[lo : hi + WINDOW - 1]])[0] - _counted([text[hi : hi + WINDOW - 1]])[0]
    return counts


def bucket_counts(texts: list[bytes]) -> np.ndarray:
    """A row of ``BUCKETS`` counts per text. Triplets never cross texts; a last short window counts what fits."""
    counts = np.zeros((len(texts), BUCKETS), np.int64)
    block, size = [], 0
    for at, text in enumerate(texts):
        if len(text) > BLOCK:
            counts[at] = _long(text)
            continue
        if size + len(text) > BLOCK:
            counts[block] = _counted([texts[i] for i in block])
            block, size = [], 0
        block.append(at)
        size += len(text)
    if block:
        counts[block] = _counted([texts[i] for i in block])
    return counts


def digests(texts: list[bytes]) -> np.ndarray:
    """Per text: length code, two ratio codes, a quartile code per bucket."""
    counts = bucket_counts(texts)
    ranked = np.sort(counts, axis=1)
    q1, q2, q3 = (ranked[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    out = np.zeros((len(texts), 3 + BUCKETS), np.uint8)
    lengths = np.fromiter(map(len, texts), np.float64, len(texts))
    out[:, 0] = np.minimum(np.floor(8 * np.log2(1 + lengths)), 255)
    out[:, 1:2] = np.minimum(16 * q1 // np.maximum(q3, 1), 15)
    out[:, 2:3] = np.minimum(16 * q2 // np.maximum(q3, 1), 15)
    out[:, 3:] = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 for the largest difference there can be."""
    apart = np.abs(a.astype(np.int16) - b.astype(np.int16))
    body = STEP_COST[apart[:, 3:]].sum(axis=1)
    head = np.minimum(apart[:, 0], LENGTH_MOST) + apart[:, 1] + apart[:, 2]
    return 1.0 - (body + head) / MOST


def as_text(digest: np.ndarray) -> list[str]:
    """Hexadecimal: length (2 digits), ratios (1 and 1), then four buckets a byte."""
    quads = digest[:, 3:].reshape(len(digest), -1, 4)
    body = (quads * np.array([64, 16, 4, 1], np.uint8)).sum(axis=2).astype(np.uint8)
    return [f"{d[0]:02x}{d[1]:x}{d[2]:x}{b.tobytes().hex()}" for d, b in zip(digest, body, strict=True)]


def edited(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many characters of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compared(ids: list, texts: list[str], following: list[str], own: np.ndarray, after: np.ndarray) -> pa.RecordBatch:
    """Result rows of texts, each with the text after it; ``own`` and ``after`` are their digests."""
    other = [edited(t, f).encode() for t, f in zip(texts, following, strict=True)]
    changed = digests(other)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(x).hexdigest() for x in other], pa.string()),
            pa.array(as_text(own), pa.string()),
            pa.array(as_text(changed), pa.string()),
            pa.array(likeness(own, changed)),
            pa.array(likeness(own, after)),
        ],
        [c.split()[0] for c in RESULT.split(", ")],
    )


def _end(batch: pa.RecordBatch | None, place: int, text: str, doc_id, first: bool) -> pa.RecordBatch:
    """Result rows of a range as they are, or its first or last document with the text in place of results."""
    if batch is None:
        names = [c.split()[0] for c in RESULT.split(", ")]
        empty = [pa.array([doc_id], pa.int64())] + [pa.nulls(1, t) for t in (pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2)]
        batch = pa.RecordBatch.from_arrays(empty, names)
        more = [pa.array([place], pa.int32()), pa.array([first]), pa.array([text], pa.string())]
    else:
        more = [pa.nulls(len(batch), t) for t in (pa.int32(), pa.bool_(), pa.string())]
    return pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "place", "first", "text"])


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Goes through one sorted range; what has its next document in the range is done, the two ends are passed on."""
    last = place = None
    for part in chunks(batches, "text", CHUNK_BYTES // 2):
        ids, texts = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
        if last is None:
            place = part.column("place")[0].as_py()
            yield _end(None, place, texts[0], ids[0], True)
        else:
            ids, texts = [last[0], *ids], [last[1], *texts]
        if len(texts) > 1:
            all_of = digests([t.encode() for t in texts])
            yield _end(compared(ids[:-1], texts[:-1], texts[1:], all_of[:-1], all_of[1:]), place, "", None, False)
        last = ids[-1], texts[-1]
    if last is not None:
        yield _end(None, place, last[1], last[0], False)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``RESULT`` per document."""
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # copies of one row may be many: where they lie in the input deals them over ranges
    keyed = texts.withColumn("_hash", F.xxhash64("text")).withColumn("_at", F.monotonically_increasing_id())
    ranges = keyed.repartitionByRange("doc_id", "_hash", "_at").sortWithinPartitions("doc_id", "_hash", "_at")
    placed = ranges.select("doc_id", "text", F.spark_partition_id().alias("place"))
    done = stored(short_batches(placed).mapInArrow(_in_order, f"{RESULT}, place int, first boolean, text string"), "fingerprints")

    ends = done.where("place is not null").select("doc_id", "text", "place", "first")
    places = ends.where("first").select("place")  # one row per range
    following = F.coalesce(F.lead("place").over(Window.orderBy("place")), F.min("place").over(Window.partitionBy()))
    ahead = places.select("place", following.alias("next_place"))
    heads = ends.where("first").select(F.col("place").alias("next_place"), F.col("text").alias("following"))
    tails = ends.where("not first").join(ahead, "place").join(heads, "next_place").select("doc_id", "text", "following")

    def across(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, after = texts_of(batch).to_pylist(), texts_of(batch, "following").to_pylist()
        return compared(
            batch.column("doc_id").to_pylist(), own, after,
            digests([t.encode() for t in own]), digests([t.encode() for t in after]),
        )

    names = [c.split()[0] for c in RESULT.split(", ")]
    return done.where("place is null").select(*names).union(mapped(tails, across, RESULT, most=CHUNK_BYTES // 2))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
