"""Quality scores from a generalised additive model with pairwise interactions.

Each text becomes ``FEATURES``, numbers about its words, marks and lines. The
model has one lookup table per feature and one per chosen pair. Boosting goes
round the features: each turn fits a shallow tree on one binned feature to the
current residuals and adds a small step to that table. Then the pairs whose
grids explain most of what is left are boosted in the same way. A score is the
sum of the tables' entries at the text's bins, as a probability.

It is trained on up to ``SAMPLE`` labelled documents outside the held-out fold,
those with the smallest hashes of their ids (a bounded, repeatable sample);
every document is scored. Labels, language, source and id are no inputs.

Cases: null and empty texts have all features 0 and are scored like any other;
a null id is in the learning fold but has no label; labels other than 0 and 1
are ignored, and repeated ones count again; without labels every score is 0.5;
repeated rows are scored each; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import mapped, split_words, stored, table, texts_of

FEATURES = (
    "log_words", "word_chars", "symbols", "marks", "digits", "short_words", "upper", "distinct_words", "top_word",
    "duplicate_lines", "line_words", "odd_words",
)
SAMPLE = 20_000
SPARE = 1.25
FOLDS, HELD_OUT = 3, 1
BINS = 48
PAIR_BINS = 12
ROUNDS, PAIR_ROUNDS, PAIRS = 120, 60, 8
RATE = 0.12
LEAVES = 4
RIDGE = 5.0


def held_out(doc_id: str = "doc_id") -> Column:
    remainder = F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def _per_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values, dtype=float)))
    return total[offsets[1:]] - total[offsets[:-1]]


def text_features(texts: pa.Array) -> np.ndarray:
    """texts x ``FEATURES``."""
    offsets, codes, words = split_words(texts)
    n = np.diff(offsets)
    some = np.maximum(n, 1)

    def of_words(values: pa.Array) -> np.ndarray:
        known = values.to_numpy(zero_copy_only=False).astype(float)
        return _per_text(known[codes], offsets) if len(codes) else np.zeros(len(n))

    size = pc.utf8_length(words)
    count = lambda pattern: pc.count_substring_regex(words, pattern)
    letters = count(r"\p{L}")
    chars = of_words(size)
    distinct, top = np.zeros(len(n)), np.zeros(len(n))
    for i, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        if hi > lo:
            _, repeats = np.unique(codes[lo:hi], return_counts=True)
            distinct[i], top[i] = len(repeats), repeats.max()
    lines, repeated = np.ones(len(n)), np.zeros(len(n))
    for i, text in enumerate(texts.to_pylist()):
        filled = [x for x in text.split("\n") if x.strip()]
        lines[i], repeated[i] = max(1, len(filled)), len(filled) - len(set(filled))
    upper = pc.count_substring_regex(texts, r"\p{Lu}").to_numpy(zero_copy_only=False)
    out = np.column_stack([
        np.log1p(n), chars / some, of_words(count(r"[#*$%&|<>]")) / some, of_words(count(r"[!?.,;:]")) / some,
        of_words(count(r"[0-9]")) / some, of_words(pc.less_equal(size, 3)) / some, upper / np.maximum(chars, 1),
        distinct / some, top / some, repeated / lines, np.log1p(n / lines), of_words(pc.less(letters, pc.subtract(size, 1))) / some,
    ])
    out[n == 0] = 0
    return out


def feature_rows(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features (array of double) of every document."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = text_features(texts_of(batch))
        ends = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.ListArray.from_arrays(ends, pa.array(x.reshape(-1)))], ["doc_id", "features"])

    return mapped(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), read, "doc_id long, features array<double>")


# ---- the model ------------------------------------------------------------------------------------------------


def _probability(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def shallow_tree(pull: np.ndarray, weight: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Step per bin: a regression tree on ordered bins with ``leaves`` leaves at most (Newton leaf values)."""

    def best_cut(lo: int, hi: int) -> tuple[float, int]:
        g, h = np.cumsum(pull[lo:hi]), np.cumsum(weight[lo:hi])
        if hi - lo < 2:
            return 0.0, lo
        left = g[:-1] ** 2 / (h[:-1] + RIDGE)
        right = (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + RIDGE)
        gain = left + right - g[-1] ** 2 / (h[-1] + RIDGE)
        at = int(np.argmax(gain))
        return float(gain[at]), lo + at + 1

    parts = [(0, len(pull))]
    while len(parts) < leaves:
        gain, cut, part = max((*best_cut(*p), p) for p in parts)
        if gain <= 1e-9:
            break
        parts.remove(part)
        parts += [(part[0], cut), (cut, part[1])]
    step = np.zeros(len(pull))
    for lo, hi in parts:
        step[lo:hi] = pull[lo:hi].sum() / (weight[lo:hi].sum() + RIDGE)
    return step


def pair_tree(pull: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Step per cell of a grid: one cut of the first feature, then one of the second on either side."""
    best, step = -1.0, np.zeros_like(pull)
    for cut in range(1, len(pull)):
        sides = [shallow_tree(pull[s].sum(0), weight[s].sum(0), 2) for s in (slice(0, cut), slice(cut, None))]
        gain = sum(float((side * pull[s].sum(0)).sum()) for side, s in zip(sides, (slice(0, cut), slice(cut, None)), strict=True))
        if gain > best:
            best = gain
            step = np.vstack([np.repeat(sides[0][None], cut, 0), np.repeat(sides[1][None], len(pull) - cut, 0)])
    return step


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


@dataclass
class AdditiveModel:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities: bins looked up in the tables and added."""
        total = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            total += t[np.searchsorted(self.edges[j], x[:, j], "right")]
        for a, b, t in self.pairs:
            total += t[np.searchsorted(self.pair_edges[a], x[:, a], "right"), np.searchsorted(self.pair_edges[b], x[:, b], "right")]
        return _probability(total)


def train(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of single features, then of the strongest pairs."""
    if not len(y):
        return AdditiveModel()
    rate = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(intercept=float(np.log(rate / (1 - rate))))
    model.edges = [_edges(x[:, j], BINS) for j in range(x.shape[1])]
    model.pair_edges = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for j, b in enumerate(bins):
            p = _probability(total)
            k = len(model.tables[j])
            step = RATE * shallow_tree(np.bincount(b, y - p, k), np.bincount(b, p * (1 - p), k))
            model.tables[j] += step
            total += step[b]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.pair_edges)]
    width = [len(e) + 1 for e in model.pair_edges]
    p = _probability(total)

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(coarse[a] * width[b] + coarse[b], values, width[a] * width[b]).reshape(width[a], width[b])

    def strength(pair: tuple[int, int]) -> float:
        pull = grid(*pair, y - p)
        return float((pair_tree(pull, grid(*pair, p * (1 - p))) * pull).sum())

    chosen = sorted(combinations(range(x.shape[1]), 2), key=lambda pair: (-strength(pair), pair))[:PAIRS]
    model.pairs = [(a, b, np.zeros((width[a], width[b]))) for a, b in chosen]
    for _ in range(PAIR_ROUNDS):
        for a, b, t in model.pairs:
            p = _probability(total)
            step = RATE * pair_tree(grid(a, b, y - p), grid(a, b, p * (1 - p)))
            t += step
            total += step[coarse[a], coarse[b]]
    return model


def sample_rows(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of at most ``sample`` labelled rows outside the held-out fold, the first by hash of their ids.

    Equal rows travel once, with their number. With more than ``sample``
    distinct rows only hashes under a threshold, set from that number, go to the
    driver: ``SPARE`` times the sample on average, whatever the table holds.
    """
    marks = labels.where("quality IN (0, 1)").select(F.col("doc_id").alias("_id"), "quality")
    rows = features.where(~held_out()).join(marks, F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "quality", "features").agg(F.count(F.lit(1)).alias("copies"))
    rows = stored(rows.select(F.xxhash64("doc_id").alias("at"), "*"), "labelled")
    n = rows.count()
    if n > sample:
        rows = rows.where(F.col("at") < int(-(1 << 63) + (1 << 64) * min(1.0, SPARE * sample / n) - 1))
    got = sorted(rows.collect(), key=lambda r: (r["at"], r["doc_id"], r["quality"], r["features"]))
    copies = np.array([r["copies"] for r in got], np.int64)
    taken = np.clip(sample - (np.cumsum(copies) - copies), 0, copies)
    x = np.array([r["features"] for r in got], float).reshape(len(got), len(FEATURES))
    return np.repeat(x, taken, axis=0), np.repeat(np.array([r["quality"] for r in got], float), taken)


def learn(features: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """Trains on at most ``sample`` labelled rows outside the held-out fold."""
    return train(*sample_rows(features, labels, sample))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    features = stored(feature_rows(docs), "features")
    model = learn(features, labels)

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column("features").flatten().to_numpy().reshape(-1, len(FEATURES))
        score = model.score(x)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    rows = features.select("doc_id", held_out().alias("held_out"), "features")
    return rows.mapInArrow(
        lambda batches: (judge(b) for b in batches if b.num_rows), "doc_id long, held_out boolean, score double, predicted int"
    )


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
