import math
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from parcelflow.llm import quality_model as qm


def test_held_out_fold_and_accuracy(spark, frame, words):
    rows, labels = [], []
    for i in range(900):
        w = words(40, i)
        bad = i % 4 == 0
        rows.append((i, " ".join(x.upper() + "!!" if i % 8 == 0 else "spam" if j % 2 and bad else x for j, x in enumerate(w))))
        labels.append((i, int(not bad), 0))
    rows += [(2000, None), (2001, ""), (None, "a b"), (3, rows[3][1])]
    labels += [(5, None, None), (None, 1, 0), (6, 1, 0)]
    got = qm.quality_scores(frame(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    held = [r for r in got if r.held_out and r.doc_id < 900]
    assert np.mean([r.predicted == (r.doc_id % 4 != 0) for r in held]) > 0.97


def test_only_the_learning_fold_is_read(spark, frame, words):
    rows = [(i, " ".join(words(20, i))) for i in range(60)]
    labels = [(i, int(zlib.crc32(str(i).encode()) % 3 != 1), 0) for i in range(60)]
    flipped = [(i, 1, 0) for i in range(60)]
    schema = "doc_id long, quality int, toxic int"
    one, two = (sorted((r.doc_id, r.score) for r in qm.quality_scores(frame(rows), spark.createDataFrame(x, schema)).collect()) for x in (labels, flipped))
    assert one == two


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = qm.train(x, y)
    assert ((model.score(x) >= 0.5) == y).mean() > 0.95


def test_features_and_empty_tables(spark, frame):
    x = qm.text_features(pa.array(["", " \n", "Ab cd, ab\nAb cd, ab\nx9 #"]))
    assert (x[:2] == 0).all() and x[2][qm.FEATURES.index("duplicate_lines")] == 1 / 3
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert qm.quality_scores(frame([]), none).count() == 0
    assert [r.score for r in qm.quality_scores(frame([(1, "a")]), none).collect()] == [0.5]


def plain_model(x, y):
    """The same boosting by loops over rows and bins: tables as dicts, residuals row by row."""
    chance = lambda t: 1 / (1 + math.exp(-min(30, max(-30, t))))
    bin_of = lambda edges, v: sum(v >= e for e in edges)
    rate = (sum(y) + 1) / (len(y) + 2)
    first = math.log(rate / (1 - rate))
    total = [first] * len(y)

    def edges(j, bins):
        return sorted({float(np.quantile([r[j] for r in x], k / bins)) for k in range(1, bins)})

    def sums(keys):
        pull, weight = Counter(), Counter()
        for key, t, label in zip(keys, total, y, strict=True):
            pull[key] += label - chance(t)
            weight[key] += chance(t) * (1 - chance(t))
        return pull, weight

    def leaf(pull, weight, cells):
        return sum(pull[c] for c in cells) / (sum(weight[c] for c in cells) + qm.RIDGE)

    def worth(pull, weight, cells):
        return sum(pull[c] for c in cells) ** 2 / (sum(weight[c] for c in cells) + qm.RIDGE)

    def tree(pull, weight, cells, leaves):
        parts = [cells]
        while len(parts) < leaves:
            cuts = [
                (worth(pull, weight, p[:k]) + worth(pull, weight, p[k:]) - worth(pull, weight, p), -k, i)
                for i, p in enumerate(parts) for k in range(1, len(p))
            ]
            if not cuts or max(cuts)[0] <= 1e-9:
                break
            _, k, i = max(cuts)
            parts[i : i + 1] = [parts[i][:-k], parts[i][-k:]]
        return {c: leaf(pull, weight, p) for p in parts for c in p}

    fine = [edges(j, qm.BINS) for j in range(len(x[0]))]
    tables = [[0.0] * (len(e) + 1) for e in fine]
    for _ in range(qm.ROUNDS):
        for j, e in enumerate(fine):
            keys = [bin_of(e, r[j]) for r in x]
            step = tree(*sums(keys), list(range(len(e) + 1)), qm.LEAVES)
            for b, v in step.items():
                tables[j][b] += qm.RATE * v
            total = [t + qm.RATE * step[k] for t, k in zip(total, keys, strict=True)]
    coarse = [edges(j, qm.PAIR_BINS) for j in range(len(x[0]))]

    def grid_step(a, b):
        pull, weight = sums([(bin_of(coarse[a], r[a]), bin_of(coarse[b], r[b])) for r in x])
        rows, cols = range(len(coarse[a]) + 1), list(range(len(coarse[b]) + 1))
        best = (-1.0, None)
        for cut in rows[1:]:
            step, gain = {}, 0.0
            for side in (rows[:cut], rows[cut:]):
                p = Counter({c: sum(pull[r, c] for r in side) for c in cols})
                w = Counter({c: sum(weight[r, c] for r in side) for c in cols})
                cells = tree(p, w, cols, 2)
                gain += sum(cells[c] * p[c] for c in cols)
                step |= {(r, c): cells[c] for r in side for c in cols}
            if gain > best[0] + 1e-12:
                best = (gain, step)
        return best

    pairs = sorted(combinations(range(len(x[0])), 2), key=lambda p: (-grid_step(*p)[0], p))[: qm.PAIRS]
    for _ in range(qm.PAIR_ROUNDS):
        for a, b in pairs:
            _, step = grid_step(a, b)
            total = [t + qm.RATE * step[bin_of(coarse[a], r[a]), bin_of(coarse[b], r[b])] for t, r in zip(total, x, strict=True)]
    return tables, set(pairs), [chance(t) for t in total]


def test_tables_and_scores_equal_a_plain_trainer(monkeypatch):
    for name, value in {"BINS": 6, "PAIR_BINS": 4, "ROUNDS": 4, "PAIR_ROUNDS": 3, "PAIRS": 2}.items():
        monkeypatch.setattr(qm, name, value)
    rng = np.random.default_rng(3)
    x = rng.random((240, 4))
    x[:, 3] = np.round(x[:, 3] * 2)  # ties
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | ((x[:, 2] > 0.4) & (x[:, 3] == 1))).astype(float)
    model = qm.train(x, y)
    tables, pairs, scores = plain_model(x.tolist(), y.tolist())
    for got, expected in zip(model.tables, tables, strict=True):
        assert np.allclose(got, expected, atol=1e-9)
    assert {p[:2] for p in model.pairs} == pairs
    assert np.allclose(model.score(x), scores, atol=1e-9)


def test_the_sample_is_the_first_by_hash_and_bounded(spark, monkeypatch):
    ids = [i for i in range(3000) for _ in range(400 if i == 7 else 1)]  # one id repeats
    rows = [(i, [float(i)] * len(qm.FEATURES)) for i in ids]
    features = spark.createDataFrame(rows, "doc_id long, features array<double>")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(3000)], "doc_id long, quality int, toxic int")
    order = {r.doc_id: r.h for r in spark.range(3000).select(F.col("id").alias("doc_id"), F.xxhash64("id").alias("h")).collect()}
    learning = sorted((i for i in ids if zlib.crc32(str(i).encode()) % 3 != 1), key=order.get)
    for sample in (100, 5000):
        x, y = qm.sample_rows(features, labels, sample)
        assert x[:, 0].tolist() == learning[:sample] and y.tolist() == [i % 2 for i in learning[:sample]]
    monkeypatch.setattr(qm, "SPARE", 0.5)  # the threshold, not the sample, bounds what is collected
    assert 20 < len(qm.sample_rows(features, labels, 100)[0]) < 100 or order[7] < min(order[i] for i in learning[100:])
