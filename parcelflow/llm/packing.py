"""Best-fit packing of tokenised documents into fixed-length sequences.

Method (bulk-synchronous best-fit): documents and gaps are range-sorted and
held as *runs* - all pieces of one length, all open sequences with one free
size. A round cuts the sorted runs into slices; in every slice a sweep walks
from large to small and gives each piece its successor, the smallest gap that
still holds it. Pieces that want the same gap are served in rank order. The
gaps shrink, what is left meets in wider slices, and the round repeats for
the next band of lengths. Pieces without any gap open new sequences.

There is at most one piece run per length, a match uses up a piece run or a
gap run, and it leaves at most two smaller gaps. So the runs and the
placements are bounded by the sequence length, not by the corpus, and only
they travel through the driver or a broadcast. Ranking the pieces and looking
up their places are shuffles over all pieces, salted within a length.

Cases: null and empty texts are one piece holding the end id alone; longer
documents are cut at multiples of the sequence length; repeated rows are
packed once each; equal lengths are ranked by document, piece and content, so
ties hold identical rows; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import bisect
import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import mapped, stored, table, texts_of

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
END_ID = 0
RANK_SALTS = 64
SLICES = (8, 1)
# Distinct runs of letters, and other words, whose ids a worker keeps between chunks; beyond it the memory starts anew.
KEPT_WORDS = 400_000
CHUNK = 2 << 20  # text bytes a worker tokenises at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
RUNS = "band int, slice int, last boolean, kind string, size long, first long, n long"
SWEPT = "kind string, size long, first long, n long, bin long, offset long, per_bin long"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# The normaliser and pre-tokeniser under which words can be encoded apart (see ``WordIds``).
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
# composed Latin letters, then marks; an apostrophe may start a contraction and is left out
LETTERS, MARKS = "[A-Za-zÀ-ÖØ-öø-ÿ]+", r"[!#$%&*+,./:;=?@^_~()\[\]-]*"


def is_wordwise(definition: dict) -> bool:
    """Whether a tokenizer's own definition (its JSON) lets words be encoded apart."""
    model = definition["model"]
    added = [t["content"] for t in definition["added_tokens"]]
    return (
        all(definition[k] == v for k, v in WORDWISE.items())
        and model["type"] == "BPE"
        and not model["dropout"]
        and definition["truncation"] is None
        and definition["padding"] is None
        and not any(re.search(r"\s", t) or re.search(f"{LETTERS}{MARKS}", t)[0] == t for t in added)
    )


class WordIds:
    """Token ids of texts, merged once per distinct word.

    The tokenizer drops white space and no token crosses it, so the ids of a
    text are those of its ASCII-space separated words, one after the other. Its
    pre-tokenizer also parts a run of letters from the marks that follow, and it
    lower-cases, so ``Word``, ``word`` and ``word,`` share the ids of ``word``.
    Words of any other make go through the library as they are. All this is read
    off the tokenizer's definition; under another one whole texts are encoded.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.wordwise = is_wordwise(json.load(f))
        self.letters: dict[str, bytes] = {}  # runs of letters in lower case
        self.others: dict[str, bytes] = {"": b""}  # runs of marks, and whole words of another make

    def _learn_letters(self, words: list[str]) -> None:
        """Runs of letters, many in one call: each is one pre-token."""
        for lo in range(0, len(words), 2000):
            part = words[lo : lo + 2000]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(found.ids, "<u4")
            ends = (4 * np.searchsorted(np.array(found.word_ids), np.arange(len(part) + 1))).tolist()
            held = ids.tobytes()
            for w, a, b in zip(part, ends[:-1], ends[1:], strict=True):
                self.letters[w] = held[a:b]

    def _learn_others(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.others[w] = np.array(e.ids, "<u4").tobytes()

    def _vocabulary(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of the ids of distinct words, and all those ids."""
        if len(self.letters) > KEPT_WORDS:
            self.letters = {}
        if len(self.others) > KEPT_WORDS:
            self.others = {"": b""}
        split = pc.extract_regex(words, f"^(?P<letters>{LETTERS})(?P<marks>{MARKS})$")
        plain = split.is_valid()
        first = pc.if_else(plain, pc.utf8_lower(pc.struct_field(split, "letters")), None).dictionary_encode()
        second = pc.if_else(plain, pc.struct_field(split, "marks"), words).dictionary_encode()
        letters, others = first.dictionary.to_pylist(), second.dictionary.to_pylist()
        self._learn_letters([w for w in letters if w not in self.letters])
        self._learn_others([w for w in others if w not in self.others])
        ids = [b"", *(self.letters[w] for w in letters), *(self.others[w] for w in others)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        # a word has two parts, the first of them empty where it isn't plain
        parts = np.empty(2 * len(words), np.int64)
        parts[0::2] = pc.fill_null(first.indices, -1).to_numpy() + 1
        parts[1::2] = second.indices.to_numpy().astype(np.int64) + 1 + len(letters)
        return size[parts].reshape(-1, 2).sum(1), _joined(np.frombuffer(b"".join(ids), "<u4"), size, parts)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts."""
        if not self.wordwise:
            found = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.cumsum([0, *map(len, found)]), np.concatenate([np.empty(0, "<u4"), *found])
        lists = pc.ascii_split_whitespace(texts)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        codes = flat.indices.to_numpy()
        size, vocab = self._vocabulary(flat.dictionary)
        ends = np.concatenate(([0], np.cumsum(size[codes])))
        return ends[offsets - offsets[0]], _joined(vocab, size, codes)


def _joined(vocab: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of the entries ``codes`` one after the other; ``vocab`` holds those of entry 0, 1, .., ``size`` many each."""
    per_code = size[codes]
    ends = np.cumsum(per_code)
    # the k-th id of the result is that many places behind the vocabulary's id of the same entry
    shift = (np.cumsum(size) - size)[codes] - (ends - per_code)
    pick = np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
    pick += np.repeat(shift.astype(np.int32), per_code)
    return vocab[pick]


@functools.lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """A worker's reader, which keeps what it has learned from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordIds(path)


def document_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and an end id, cut into pieces of at most ``capacity`` tokens."""
    path = path or tokenizer_path()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        offsets, ids = word_ids(path)(texts_of(batch))
        rows: list[tuple[int, int, int, int, int]] = []
        for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            own = np.append(ids[lo:hi], np.array(END_ID, "<u4"))
            for k, start in enumerate(range(0, len(own), capacity)):
                part = own[start : start + capacity]
                rows.append((i, k, start, len(part), zlib.crc32(part.tobytes())))
        row, piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)],
            ["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), cut, PIECES, most=CHUNK)


def ranked(pieces: DataFrame) -> DataFrame:
    """``rank`` (from 0, gapless) of every piece among those of its length; no task holds a whole length."""
    salted = pieces.withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(RANK_SALTS)).cast("int")
    )
    cells = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = cells.withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    ).drop("_n")
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    rows = salted.withColumn("_row", F.row_number().over(within) - 1)
    # at most capacity * RANK_SALTS rows
    return rows.join(F.broadcast(before), ["length", "_salt"]).withColumn(
        "rank", F.col("_before") + F.col("_row")
    ).drop("_salt", "_row", "_before")


def _sweeper(capacity: int, first_new_bin: int):
    """The sweep of one slice, from large to small."""

    def sweep(runs: pd.DataFrame) -> pd.DataFrame:
        opens = bool(runs["last"].iloc[0])
        gaps = sorted((int(s), int(f), int(n)) for k, s, f, n in zip(runs["kind"], runs["size"], runs["first"], runs["n"], strict=True) if k == "gap")
        docs = sorted(((int(s), int(f), int(n)) for k, s, f, n in zip(runs["kind"], runs["size"], runs["first"], runs["n"], strict=True) if k == "doc"), reverse=True)
        out: list[tuple] = []
        new_bin = first_new_bin
        for length, first, n in docs:
            while n:
                at = bisect.bisect_left(gaps, (length, -1, -1))
                if at < len(gaps):
                    size, bin_, bins = gaps.pop(at)
                elif opens:
                    bins = -(-n // (capacity // length))
                    size, bin_ = capacity, new_bin
                    new_bin += bins
                else:
                    break
                per_bin = size // length
                placed = min(n, bins * per_bin)
                full, over = divmod(placed, per_bin)
                out.append(("place", length, first, placed, bin_, capacity - size, per_bin))
                used = full + (over > 0)
                for left, b, m in (
                    (size - per_bin * length, bin_, full),
                    (size - over * length, bin_ + full, used - full),
                    (size, bin_ + used, bins - used),
                ):
                    if left and m:
                        bisect.insort(gaps, (left, b, m))
                first, n = first + placed, n - placed
            if n:
                out.append(("doc", length, first, n, 0, 0, 0))
        out += [("gap", size, bin_, n, 0, 0, 0) for size, bin_, n in gaps]
        return pd.DataFrame(out, columns=["kind", "size", "first", "n", "bin", "offset", "per_bin"])

    return sweep


def bands(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """``(low, high]`` from the longest length downwards, each half as long as the one before."""
    high = max(lengths, default=0)
    while high:
        yield high // 2, high
        high //= 2


def best_fit(spark: SparkSession, lengths: list[tuple[int, int]], capacity: int = CAPACITY) -> list[tuple]:
    """Rounds of sweeps over ``(length, count)``.

    Returns placements ``(length, first rank, n, bin, offset, per_bin)``: ranks
    ``first + k`` lie in sequence ``bin + k // per_bin`` at ``offset + (k %
    per_bin) * length``.
    """
    waiting = {length: n for length, n in lengths}
    gaps: list[tuple[int, int, int]] = []
    places: list[tuple] = []
    next_bin = 0
    for low, high in bands(list(waiting)):
        docs = [(length, 0, n) for length, n in waiting.items() if low < length <= high]
        for slices in SLICES:
            if not docs:
                break
            # gaps too small for this band stay out; slice bounds follow the size
            rows = [("doc", *d) for d in docs] + [("gap", *g) for g in gaps if g[0] > low]
            small = [g for g in gaps if g[0] <= low]
            runs = spark.createDataFrame(
                [(high, size * slices // (capacity + 1), slices == 1, kind, size, first, n) for kind, size, first, n in rows], RUNS
            )
            swept = runs.groupBy("band", "slice").applyInPandas(_sweeper(capacity, next_bin), SWEPT).collect()
            docs = [(r["size"], r["first"], r["n"]) for r in swept if r["kind"] == "doc"]
            gaps = small + [(r["size"], r["first"], r["n"]) for r in swept if r["kind"] == "gap"]
            new = [(r["size"], r["first"], r["n"], r["bin"], r["offset"], r["per_bin"]) for r in swept if r["kind"] == "place"]
            places += new
            next_bin = max([next_bin, *(b + -(-n // per) for _, _, n, b, _, per in new)])
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces of ``1 .. capacity`` tokens.

    ``pieces`` is read three times, so hand in a stored table.
    """
    spark = pieces.sparkSession
    # at most one row per length
    lengths = [(r["length"], r["n"]) for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()]
    places = spark.createDataFrame(
        best_fit(spark, lengths, capacity), "length long, _first long, _n long, _bin long, _offset long, _per_bin long"
    )
    k = F.col("rank") - F.col("_first")
    items = ranked(pieces)
    fits = (items["length"] == places["length"]) & (k >= 0) & (k < F.col("_n"))
    return (
        items.join(F.broadcast(places), fits)
        .select(
            *(items[c] for c in pieces.columns),
            (F.col("_bin") + F.floor(k / F.col("_per_bin"))).cast("long").alias("sequence_id"),
            (F.col("_offset") + k % F.col("_per_bin") * items["length"]).cast("long").alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack whole documents."""
    return pack(stored(document_pieces(docs, path, capacity), "pieces"), capacity)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
