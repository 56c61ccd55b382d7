"""Token counts of a sentencepiece model with a whole-token shortcut.

Offline, every vocabulary string that is a word with its leading space mark
is encoded alone; those that come back as one token are *proven*. A text is
cut into pre-tokens; proven ones count one token each without merging, and
only the rest goes through the library's merges (each distinct pre-token
once per chunk, not once per use).

The cut is safe only when no merge can join two pre-tokens. That too is
proven from the vocabulary: no piece holds a space mark after another
character, and none holds a line break. A model for which this fails is
merged whole text by whole text.

Cases: null and empty texts count 0 tokens; texts with runs of spaces, the
space mark itself or NUL go to the library whole; repeated rows are counted
row by row; columns beyond ``doc_id`` and ``text`` are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import mapped, table, texts_of

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE_MARK = "▁"
# Merged pre-tokens that a worker keeps between chunks; beyond it the memory starts anew.
KEPT_WORDS = 400_000


@dataclass(frozen=True)
class Proof:
    """What the vocabulary proves: whole-token words, and whether texts may be cut."""

    whole: frozenset[str]
    separable: bool


@lru_cache(maxsize=4)
def _model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def prove(path: str) -> Proof:
    """Encode every vocabulary word alone; bounded by the vocabulary, whatever the corpus."""
    model = _model(path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i)]
    separable = not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)
    # the cut also needs a model that leaves spaces alone and turns a line break into one token
    separable = separable and len(model.encode("a  b")) == 1 + len(model.encode("a")) + len(model.encode("b")) and len(
        model.encode("a\nb")
    ) == len(model.encode("a")) + 1 + len(model.encode("\nb")) - len(model.encode("\n"))
    words = [p[1:] for p in pieces if p.startswith(SPACE_MARK) and len(p) > 1 and SPACE_MARK not in p[1:]]
    whole = [w for w, ids in zip(words, model.encode(words), strict=True) if len(ids) == 1]
    return Proof(frozenset(whole), separable)


class _Counter:
    """Token counts of distinct pre-tokens, after a space (or at the start) and after a line break."""

    def __init__(self, path: str, proof: Proof):
        self.model, self.whole = _model(path), proof.whole
        self.after_space: dict[str, int] = {}
        self.after_break: dict[str, int] = {}
        self.breaks = len(self.model.encode("\n"))

    def _merged(self, words: list[str], known: dict[str, int], prefix: str, less: int) -> None:
        if len(known) > KEPT_WORDS:
            known.clear()
        new = [w for w in words if w not in known]
        if new:
            ids = self.model.encode([prefix + w for w in new], num_threads=1)
            known.update((w, len(x) - less) for w, x in zip(new, ids, strict=True))

    def spaced(self, words: pa.Array) -> np.ndarray:
        listed = words.to_pylist()
        whole = self.whole
        self._merged([w for w in listed if w not in whole], self.after_space, "", 0)
        known = self.after_space
        return np.fromiter((1 if w in whole else known[w] for w in listed), np.int64, len(listed))

    def broken(self, words: pa.Array) -> np.ndarray:
        listed = words.to_pylist()
        self._merged(listed, self.after_break, "\n", self.breaks)
        return np.fromiter((self.after_break[w] for w in listed), np.int64, len(listed))

    def plain_texts(self, texts: pa.Array) -> np.ndarray:
        """Counts of non-empty texts with single spaces only."""
        lines = pc.split_pattern(texts, "\n")
        per_text = np.diff(lines.offsets.to_numpy())
        words = pc.split_pattern(lines.flatten(), " ")
        per_line = np.diff(words.offsets.to_numpy())
        flat = words.flatten().dictionary_encode()
        codes = flat.indices.to_numpy()
        # the first word of every line but a text's first has no space before it
        line_starts = np.concatenate(([0], np.cumsum(per_line)[:-1]))
        text_starts = np.concatenate(([0], np.cumsum(per_text)[:-1]))
        after_break = np.ones(len(per_line), bool)
        after_break[text_starts] = False
        at = line_starts[after_break]
        counts = self.spaced(flat.dictionary)[codes]
        if len(at):
            used, inverse = np.unique(codes[at], return_inverse=True)
            counts[at] = self.broken(flat.dictionary.take(pa.array(used)))[inverse] + 1
        firsts = line_starts[text_starts]
        return np.add.reduceat(counts, firsts)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text (no begin, end or added special tokens)."""
    path = path or model_path()
    proof = docs.sparkSession.sparkContext.broadcast(prove(path))  # bounded by the vocabulary
    counters: dict[str, _Counter] = {}

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        if path not in counters:
            counters[path] = _Counter(path, proof.value)
        counter, texts = counters[path], texts_of(batch)
        n = np.zeros(len(texts), np.int64)
        filled = pc.greater(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        # first lines may not start, and no line may start or end, with a space: a run of marks is merged whole
        odd = pc.match_substring_regex(texts, f"  |^ | $|\n | \n|\n\\z|{SPACE_MARK}|\\x00|^\n").to_numpy(zero_copy_only=False)
        whole = filled & (odd | (not proof.value.separable))
        plain = filled & ~whole
        if whole.any():
            ids = counter.model.encode(texts.filter(pa.array(whole)).to_pylist(), num_threads=1)
            n[whole] = [len(x) for x in ids]
        if plain.any():
            n[plain] = counter.plain_texts(texts.filter(pa.array(plain)))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return mapped(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        count,
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean",
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
