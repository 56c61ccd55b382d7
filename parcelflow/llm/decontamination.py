"""Benchmark passages inside documents, by SimHash windows and exact similarity.

Words are lower-cased and stripped of marks at their ends. For every item, the
windows of a document are as long as the item. A window that shares too few
five-word shingles with all items together cannot reach the threshold with any
of them and is passed over; that bound loses nothing. The others get a 64-bit
SimHash of their weighted shingles (a shingle weighs as often as it occurs).
The multi-index cuts fingerprints into four blocks of 16 bits: two fingerprints
at most ``RADIUS`` apart differ in ``BLOCK_RADIUS`` bits or fewer in one block
at least, so looking up each block finds every item within the radius. Exact
weighted Jaccard similarity of the shingles then decides.

At the threshold two fingerprints differ in 11 bits on average, with a standard
deviation of 3; more than ``RADIUS`` = 23 bits, four of those above, happen to
about one such passage in ten thousand, and to clearer ones far less.

Items are handled in blocks of ``ITEMS_AT_ONCE`` (a bounded index in each
worker), each block in one pass over the documents; nothing is shuffled.

Cases: null, empty and wordless documents or items match nothing; items of
fewer than five words are one shingle; a document shorter than an item is one
window; repeated rows are judged each; of equal windows the first is reported;
other columns are ignored (``without_items`` keeps them); empty tables give no
matches.
"""

from __future__ import annotations

import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import SHINGLE_WORDS, chunks, drop_words, mapped, shingle_hashes, short_batches, split_words, table, texts_of, word_hashes

PERCENT = 75
BLOCKS = 4
BLOCK_BITS = 16
BLOCK_RADIUS = 5
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
ITEMS_AT_ONCE = 512
SPAN = 1 << 14
MARKS = string.punctuation + "«»„“”‚‘’…–—¿¡"

MATCHES = "doc_id long, item_id long, similarity double, word_start long, n_words long"


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and a hash for every word, without marks at its ends."""
    offsets, codes, words = split_words(texts)
    bare = pa.array([w.strip(MARKS).lower() for w in words.to_pylist()], pa.string())
    offsets, codes, bare = drop_words(offsets, codes, bare, pc.equal(bare, ""))
    return offsets, word_hashes(bare)[codes] if len(codes) else np.empty(0, np.uint64)


def fingerprints(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """SimHash of the runs of ``n`` shingles that begin at ``starts``."""
    bits = np.unpackbits(shingles.view(np.uint8).reshape(-1, 8), axis=1)
    ones = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    majority = 2 * (ones[starts + n] - ones[starts]) > n
    return np.packbits(majority, axis=1).view(np.uint64).reshape(-1)


def similarity(a: Counter, b: Counter) -> tuple[int, int]:
    """Weighted intersection and union."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common, sum(a.values()) + sum(b.values()) - common


@dataclass
class Index:
    """Items by window size, all their shingles, and the multi-index over their fingerprints."""

    items: list[tuple[int, np.ndarray]]  # id and word hashes
    sizes: dict[int, np.ndarray] = field(default_factory=dict)
    shingles: dict[int, np.ndarray] = field(default_factory=dict)
    counts: list[Counter] = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    blocks: list[np.ndarray] = field(default_factory=list)

    def __post_init__(self) -> None:
        prints, by_size, by_length = [], {}, {}
        for i, (_, words) in enumerate(self.items):
            k = min(SHINGLE_WORDS, len(words))
            own = shingle_hashes(words, k)
            self.counts.append(Counter(own.tolist()))
            prints.append(fingerprints(own, np.array([0]), len(own))[0])
            by_size.setdefault(len(words), []).append(i)
            by_length.setdefault(k, []).append(own)
        self.prints = np.array(prints, np.uint64)
        self.sizes = {n: np.array(x) for n, x in sorted(by_size.items())}
        self.shingles = {k: np.unique(np.concatenate(x)) for k, x in by_length.items()}
        values = np.arange(1 << BLOCK_BITS, dtype=np.uint64)
        words = -(-len(self.items) // 64)
        for b in range(BLOCKS):
            near = np.zeros((1 << BLOCK_BITS, words), np.uint64)
            for i, own in enumerate(self._block(self.prints, b)):
                close = np.bitwise_count(values ^ own) <= BLOCK_RADIUS
                near[close, i // 64] |= np.uint64(1 << (i % 64))
            self.blocks.append(near)

    @staticmethod
    def _block(prints: np.ndarray, b: int) -> np.ndarray:
        return (prints >> np.uint64(b * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)

    def near(self, prints: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``prints``, place in ``items``) that the multi-index brings together within the radius."""
        bits = self.blocks[0][self._block(prints, 0).astype(np.int64)]
        for b in range(1, BLOCKS):
            bits = bits | self.blocks[b][self._block(prints, b).astype(np.int64)]
        member = (bits[:, items // 64] >> (items % 64).astype(np.uint64)) & np.uint64(1)
        row, at = np.nonzero(member)
        close = np.bitwise_count(prints[row] ^ self.prints[items[at]]) <= RADIUS
        return row[close], at[close]

    def matches(self, words: np.ndarray) -> dict[int, tuple[float, int, int]]:
        """Best similarity, word and length of window per item found in one document."""
        found: dict[int, tuple[float, int, int]] = {}
        n_doc = len(words)
        runs, hits = {}, {}
        for k, known in self.shingles.items():
            if n_doc >= k:
                runs[k] = shingle_hashes(words, k)
                at = np.minimum(np.searchsorted(known, runs[k]), len(known) - 1)
                hits[k] = np.concatenate(([0], np.cumsum(known[at] == runs[k])))
        if not any(h[-1] for h in hits.values()):
            return found
        for size, items in self.sizes.items():
            n = min(size, n_doc)
            k = min(SHINGLE_WORDS, size)
            if n < k or not hits[k][-1]:
                continue
            windows, of_item = n - k + 1, size - k + 1
            # similarity >= PERCENT needs an intersection of at least PERCENT / (100 + PERCENT) of both sizes together
            least = -(-PERCENT * (windows + of_item) // (100 + PERCENT))
            starts = np.flatnonzero(hits[k][windows:] - hits[k][: len(hits[k]) - windows] >= least)
            lo = 0
            while lo < len(starts):  # windows that begin within SPAN of each other: the bits unpacked stay bounded in long texts
                hi = int(np.searchsorted(starts, starts[lo] + SPAN))
                self._check(runs[k], starts[lo:hi], windows, n, items, found)
                lo = hi
        return found

    def _check(self, run: np.ndarray, starts: np.ndarray, windows: int, n: int, items: np.ndarray, found: dict) -> None:
        base = int(starts[0])
        part = run[base : int(starts[-1]) + windows]
        row, at = self.near(fingerprints(part, starts - base, windows), items)
        for r, i in zip(row.tolist(), items[at].tolist(), strict=True):
            start = int(starts[r])
            common, union = similarity(Counter(run[start : start + windows].tolist()), self.counts[i])
            if 100 * common >= PERCENT * union:
                best = found.get(i)
                if best is None or common / union > best[0]:
                    found[i] = (common / union, start, n)


def item_blocks(benchmark: DataFrame, most: int = ITEMS_AT_ONCE) -> Iterator[list[tuple[int, str]]]:
    """Items with a text, some at a time."""
    held: list[tuple[int, str]] = []
    for row in benchmark.select("item_id", "text").where("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


class Finder:
    """Builds the index of a block of items once per worker."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        self._index: Index | None = None

    def __getstate__(self) -> dict:
        return {"items": self.items, "_index": None}

    @property
    def index(self) -> Index:
        if self._index is None:
            offsets, hashes = plain_words(pa.array([t for _, t in self.items], pa.string()))
            spans = zip(offsets[:-1], offsets[1:], strict=True)
            self._index = Index([(i, hashes[lo:hi]) for (i, _), (lo, hi) in zip(self.items, spans, strict=True) if hi > lo])
        return self._index

    def __call__(self, texts: pa.Array) -> list[dict[int, tuple[float, int, int]]]:
        offsets, hashes = plain_words(texts)
        return [self.index.matches(hashes[lo:hi]) for lo, hi in zip(offsets[:-1], offsets[1:], strict=True)]


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, similarity, word_start, n_words``."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = None
    for items in item_blocks(benchmark):
        finder = Finder(items)

        def find(batch: pa.RecordBatch, finder: Finder = finder) -> pa.RecordBatch | None:
            hits = [(i, finder.index.items[k][0], *m) for i, doc in enumerate(finder(texts_of(batch))) for k, m in sorted(doc.items())]
            if not hits:
                return None
            row, item, score, start, n = zip(*hits, strict=True)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), pa.array(item, pa.int64()), pa.array(score, pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "item_id", "similarity", "word_start", "n_words"],
            )

        part = mapped(rows, find, MATCHES)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], MATCHES)


def without_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows pass through the workers, none is shuffled."""
    for items in item_blocks(benchmark):
        finder = Finder(items)

        def keep(batches: Iterator[pa.RecordBatch], finder: Finder = finder) -> Iterator[pa.RecordBatch]:
            for part in chunks(batches, "text"):
                clean = part.filter(pa.array([not m for m in finder(texts_of(part))], pa.bool_()))
                if clean.num_rows:
                    yield clean

        docs = short_batches(docs).mapInArrow(keep, docs.schema)
    return docs


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
