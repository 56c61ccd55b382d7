"""Removal of bytes that belong to a 400-byte string found elsewhere too.

A column-wise construction of the whole collection's Burrows-Wheeler transform
needs a round per symbol of the longest document, and every round reads all
that was built so far; README gives the figures. So the collection is first cut
into small ones that can't share a repeated string, and each of those is built
column by column:

1. *Anchors.* Every 400-byte string has an anchor, the leftmost minimum among
   the hashes of its ``GRAM``-byte substrings. Equal strings have equal anchors
   at the same place, so only strings whose anchor hash occurs twice matter.
   Neighbouring strings share anchors; a *context* is all strings of one anchor
   occurrence, one after the other.
2. Contexts are counted by (anchor hash, context hash). If all contexts of a
   hash are equal and there are several, all their strings are repeated.
3. Other hashes have each distinct context's bytes gathered, aligned at the
   anchor. Blocks of them get one symbol per context and round, from the last
   column to the first: a stable sort by the new symbol updates the order of all
   suffixes, and minima over the old common prefixes give the new ones. A string
   is repeated where its common prefix with a neighbour reaches 400.
4. A hash with more than ``BIG`` distinct contexts (near copies by the million)
   isn't gathered in one task: its strings are hashed and counted by shuffle.

Cases: null and empty texts, and those under 400 bytes, keep every byte; exact
copies of a long text lose all bytes; positions are UTF-8 bytes and may cut
characters; repeated rows count as copies; other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.bloom import with_possible
from parcelflow.llm.common import chunks, mix, short_batches, stored, table, texts_of

LENGTH = 400
GRAM = 100
SPAN = LENGTH - GRAM  # an anchor lies 0 .. SPAN bytes behind the start of its string
WIDTH = LENGTH + SPAN  # bytes that the strings of one anchor cover at most
SEGMENT_BITS = 20
SEGMENT = 1 << SEGMENT_BITS
BIG = 4000
BLOCK_CONTEXTS = 16_384

ANCHORS = "k1 long, k2 long, h long, r long, lo long, n int, a int"
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    """Powers 0 .. n - 1 of ``base`` modulo 2^64."""
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, 1 << 64))
        size *= 2
    return out


class Anchors:
    """Anchors of all 400-byte strings in a buffer of several texts."""

    def __init__(self):
        self.symbols = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.powers = _powers(_BASE, SEGMENT + 1)
        self.inverse = _powers(pow(_BASE, -1, 1 << 64), SEGMENT + 1)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
        """``(text, h, r, lo, n, a)`` per anchor: ``n`` strings from ``lo`` on, the anchor ``a`` behind ``lo``."""
        n = len(data)
        if n < LENGTH:
            return
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.symbols[data] * self.powers[:n], out=total[1:])
        grams = mix((total[GRAM:] - total[:-GRAM]) * self.inverse[: n - GRAM + 1])
        low = np.uint64(SEGMENT - 1)
        packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        least = self._sliding_min(packed, SPAN + 1) & low  # the anchor of the string at each place
        texts = np.searchsorted(ends, np.arange(len(least)), "right")
        inside = np.arange(len(least)) + LENGTH <= ends[np.minimum(texts, len(ends) - 1)]
        at = np.flatnonzero(inside)
        if not len(at):
            return
        anchor, text = least[at].astype(np.int64), texts[at]
        new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        view = memoryview(data)
        digest = xxhash.xxh3_64_intdigest
        for lo, hi, p, t in zip(at[first].tolist(), at[last].tolist(), anchor[first].tolist(), text[first].tolist(), strict=True):
            yield t, int(grams[p]), digest(view[lo : hi + LENGTH], seed=p - lo), lo - int(starts[t]), hi - lo + 1, p - lo

    @staticmethod
    def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
        blocks = -(-len(x) // w)
        padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
        padded[: len(x)] = x
        grid = padded.reshape(blocks, w)
        ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        n = len(x) - w + 1
        return np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and a 128-bit key of the two."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    return rows.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "doc_id", "text")})


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One buffer with all texts, and their offsets in it."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if texts.buffers()[2] is None:
        return np.empty(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def anchor_rows(rows: DataFrame) -> DataFrame:
    """``k1, k2, h, r, lo, n, a`` of every anchor; texts above a segment are read in overlapping segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Anchors()
        for part in chunks(batches, "text", SEGMENT):
            data, offsets = _bytes_of(texts_of(part))
            out: list[tuple] = []
            if len(data) <= SEGMENT:
                out = list(find(data, offsets[:-1], offsets[1:]))
            else:  # a single long text
                for lo in range(0, len(data) - LENGTH + 1, SEGMENT - LENGTH + 1):
                    piece = data[lo : lo + SEGMENT]
                    found = find(piece, np.array([0]), np.array([len(piece)]))
                    out += [(0, h, r, at + lo, n, a) for _, h, r, at, n, a in found]
            if out:
                # types are named: from hashes on both sides of 2^63 numpy would make floats
                kinds = (np.int64, np.uint64, np.uint64, np.int64, np.int32, np.int32)
                text, h, r, at, n, a = (np.array(x, t) for x, t in zip(zip(*out, strict=True), kinds, strict=True))
                text = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [part.column("k1").take(text), part.column("k2").take(text), pa.array(h.view(np.int64)),
                     pa.array(r.view(np.int64)), pa.array(at), pa.array(n), pa.array(a)],
                    ["k1", "k2", "h", "r", "lo", "n", "a"],
                )

    return rows.where(F.octet_length("text") >= LENGTH).select("k1", "k2", "text").transform(short_batches).mapInArrow(run, ANCHORS)


# ---- contexts of one anchor hash against each other --------------------------------------------------------------


def repeated_columns(contexts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Where a 400-byte string of an aligned collection occurs in two of its rows at the same column.

    ``contexts`` is rows x ``WIDTH`` bytes, of which ``begin .. end`` are filled.
    The result is rows x (``SPAN`` + 1) booleans. One symbol of each row is
    inserted per round, last column first; ``order`` is the sorted order of the
    rows' suffixes, ``common`` their common prefix with the one before.
    """
    rows = len(contexts)
    order = np.arange(rows)
    common = np.zeros(rows + 1, np.int32)
    found = np.zeros((rows, SPAN + 1), bool)
    symbols = contexts.astype(np.int16) + 1
    columns = np.arange(WIDTH)
    symbols[(columns < begin[:, None]) | (columns >= end[:, None])] = 0
    for c in range(WIDTH - 1, -1, -1):
        symbol = symbols[order, c]
        into = np.argsort(symbol, kind="stable")
        now = symbol[into]
        fresh = np.zeros(rows + 1, np.int32)
        same = np.flatnonzero((now[1:] == now[:-1]) & (now[1:] != 0)) + 1
        if len(same):
            between = np.column_stack([into[same - 1] + 1, into[same] + 1]).reshape(-1)
            fresh[same] = np.minimum.reduceat(common, between)[::2] + 1
        order, common = order[into], fresh
        if c <= SPAN:
            long = common >= LENGTH
            found[order, c] = long[:rows] | long[1:]
    return found


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))


RUNS = "h long, r long, at int, size int"


def compare_blocks(contexts: DataFrame) -> DataFrame:
    """Runs of repeated strings (``h, r, at, size``) of contexts ``h, r, n, a, bytes`` in groups of up to ``BIG``."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        h, r, a = (t.column(x).to_numpy() for x in ("h", "r", "a"))
        data = t.column("bytes").to_pylist()
        begin = SPAN - a.astype(np.int64)
        end = begin + np.array([len(x) for x in data])
        grid = np.zeros((len(data), WIDTH), np.uint8)
        for i, x in enumerate(data):
            grid[i, begin[i] : end[i]] = np.frombuffer(x, np.uint8)
        found = repeated_columns(grid, begin, end)
        out = [(i, at, size) for i in range(len(data)) for at, size in _runs(found[i, begin[i] : end[i] - LENGTH + 1])]
        row, at, size = (np.array([x[k] for x in out], np.int64) for k in range(3))
        return pa.RecordBatch.from_arrays(
            [pa.array(h[row]), pa.array(r[row]), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32))], ["h", "r", "at", "size"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                held.append(batch.slice(lo, 2048))
                rows += held[-1].num_rows
                if rows >= BLOCK_CONTEXTS:  # cut before the last hash, which may go on
                    t = pa.Table.from_batches(held).combine_chunks()
                    h = t.column("h").to_numpy()
                    cut = int(np.flatnonzero(h != h[-1])[-1]) + 1 if h[0] != h[-1] else 0
                    if cut:
                        yield block(t.slice(0, cut).to_batches())
                        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
        if held:
            yield block(held)

    few = contexts.repartition("h").sortWithinPartitions("h")
    return few.select("h", "r", "n", "a", "bytes").mapInArrow(run, RUNS)


def compare_shuffled(contexts: DataFrame) -> DataFrame:
    """The same for groups of any size: every string's 128-bit hash, counted."""
    schema = "h long, r long, at int, w1 long, w2 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, r, n, a, data in zip(*(batch.column(x).to_pylist() for x in ("h", "r", "n", "a", "bytes")), strict=True):
                hashes = np.frombuffer(
                    b"".join(xxhash.xxh3_128_digest(data[i : i + LENGTH], seed=a - i) for i in range(n)), np.int64
                ).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, h)), pa.array(np.full(n, r)), pa.array(np.arange(n, dtype=np.int32)), pa.array(hashes[:, 0].copy()), pa.array(hashes[:, 1].copy())],
                    ["h", "r", "at", "w1", "w2"],
                )

    strings = stored(contexts.mapInArrow(run, schema), "strings")
    twice = stored(strings.groupBy("w1", "w2").count().where("count > 1").drop("count"), "repeated-strings")
    return strings.join(twice, ["w1", "w2"]).select("h", "r", "at", F.lit(1).alias("size"))


# ---- the whole --------------------------------------------------------------------------------------------------


def repeated_spans(rows: DataFrame) -> DataFrame:
    """``k1, k2, spans``: the repeated strings of each text (array of first start and number of starts)."""
    anchors = stored(anchor_rows(rows), "anchors")
    hashes = anchors.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.min("r").alias("_least"), F.max("r").alias("_most"))
    hashes = stored(hashes.where("m > 1").select("h", (F.col("_least") != F.col("_most")).alias("mixed")), "anchor-hashes")
    common = with_possible(anchors, "h", hashes, "h").where("possible").drop("possible").join(hashes, "h")
    common = stored(common, "common-anchors")

    distinct = common.where("mixed").groupBy("h", "r").agg(
        F.count(F.lit(1)).alias("m"), *(F.first(c).alias(c) for c in ("k1", "k2", "lo", "n", "a"))
    )
    distinct = stored(distinct, "contexts")
    wanted = distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct("h", "r", "lo", "n", "a")).alias("wanted"))
    wanted = stored(wanted, "wanted-contexts")
    texts = with_possible(rows, "k1", wanted.select("k1"), "k1").where("possible").select("k1", "k2", "text")
    contexts = stored(_context_bytes(texts.join(wanted, ["k1", "k2"])), "context-bytes")
    sizes = stored(distinct.groupBy("h").count().where(F.col("count") > BIG).select("h"), "big-groups")
    found = compare_blocks(contexts.join(sizes, "h", "left_anti"))
    if not sizes.isEmpty():
        found = found.union(compare_shuffled(contexts.join(F.broadcast(sizes) if sizes.count() <= 100_000 else sizes, "h")))
    found = stored(found, "repeated-runs")
    # contexts that occur twice are repeated from end to end
    whole = distinct.where("m > 1").select("h", "r", F.lit(0).alias("at"), F.col("n").alias("size"))
    per_context = found.join(whole.select("h", "r"), ["h", "r"], "left_anti").union(whole)
    per_context = stored(
        per_context.groupBy("h", "r").agg(F.collect_list(F.struct("at", "size")).alias("runs")), "context-runs"
    )
    mixed = (
        common.where("mixed").join(per_context, ["h", "r"])
        .select("k1", "k2", "lo", F.explode("runs").alias("run"))
        .select("k1", "k2", (F.col("lo") + F.col("run.at")).alias("start"), F.col("run.size").cast("long").alias("size"))
    )
    spans = common.where("NOT mixed").select("k1", "k2", F.col("lo").alias("start"), F.col("n").cast("long").alias("size"))
    return spans.union(mixed).groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "size")).alias("spans"))


def _context_bytes(rows: DataFrame) -> DataFrame:
    """``h, r, n, a, bytes`` from ``text`` and its wanted contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", SEGMENT):
            out = [
                (w["h"], w["r"], w["n"], w["a"], text[w["lo"] : w["lo"] + w["n"] + LENGTH - 1])
                for text, wanted in zip((t.encode() for t in part.column("text").to_pylist()), part.column("wanted").to_pylist(), strict=True)
                for w in wanted
            ]
            h, r, n, a, data = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h, pa.int64()), pa.array(r, pa.int64()), pa.array(n, pa.int32()), pa.array(a, pa.int32()), pa.array(data, pa.binary())],
                ["h", "r", "n", "a", "bytes"],
            )

    return rows.select("text", "wanted").mapInArrow(run, "h long, r long, n int, a int, bytes binary")


def removed_runs(spans: list[tuple[int, int]], length: int = LENGTH) -> list[tuple[int, int]]:
    """Maximal runs of bytes ``[start, end)`` under strings given as (first start, number of starts)."""
    out: list[list[int]] = []
    for start, size in sorted(spans):
        end = start + size - 1 + length
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` and the bytes ``kept`` of every document."""
    rows = keyed(docs)
    spans = stored(repeated_spans(rows), "spans")
    flagged = with_possible(rows, "k1", spans.select("k1"), "k1")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", SEGMENT):
            out = []
            for text, spans_ in zip((t.encode() for t in part.column("text").to_pylist()), part.column("spans").to_pylist(), strict=True):
                gone = removed_runs([(s["start"], s["size"]) for s in spans_ or []])
                edges = [0, *(x for run_ in gone for x in run_), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                out.append((len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    touched = flagged.where("possible").join(spans, ["k1", "k2"], "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
    whole = flagged.where("NOT possible").select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
        F.encode("text", "UTF-8").alias("kept"),
    )
    return touched.union(whole)


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
