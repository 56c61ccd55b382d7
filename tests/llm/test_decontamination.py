from collections import Counter

import numpy as np
import pyarrow as pa

from parcelflow.llm import decontamination as dc


def _plain(text):
    return [x for w in (text or "").split() if (x := w.strip(dc.MARKS).lower())]


def _shingles(w):
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def test_finds_exactly_what_brute_force_finds(spark, frame, words):
    items = [(i, " ".join(words(30 + i, 300 + i))) for i in range(12)] + [(90, None), (91, ""), (92, "Two words")]
    docs = []
    for i in range(40):
        filler = words(120, 700 + i)
        item = words(30 + i % 12, 300 + i % 12)
        if i % 3 == 1:
            item[2] = "changed"
        if i % 3 == 2:
            item[len(item) // 2] = "changed"
        docs.append((i, " ".join([*filler[: 3 * i], "(" + item[0].upper(), *item[1:], *filler[3 * i :]])))
    docs += [(100, items[0][1]), (101, " ".join(items[1][1].split()[1:])), (102, "has two words, here"), (103, None), (104, ""), (None, items[2][1])]
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in dc.contaminated(frame(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    expected = {}
    for d, text in docs:
        w = _plain(text)
        for i, t in items:
            own = _plain(t)
            if not own or not w or len(w) < min(5, len(own)):
                continue
            n, k, a = min(len(own), len(w)), min(5, len(own)), _shingles(own)
            best = 0
            for s in range(len(w) - n + 1):
                b = Counter(tuple(w[s + j : s + j + k]) for j in range(n - k + 1))
                common = sum((a & b).values())
                best = max(best, common / (sum(a.values()) + sum(b.values()) - common))
            if best >= 0.75:
                expected[d, i] = round(best, 9)
    assert got == expected and len(got) > 25
    clean = dc.without_items(frame(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if not any(x == d for x, _ in expected))


def test_multi_index_finds_all_within_radius():
    rng = np.random.default_rng(2)
    index = dc.Index([(i, rng.integers(0, 2**63, 20).astype(np.uint64)) for i in range(70)])
    items = np.arange(70)
    probes = []
    for p in index.prints:
        for n in range(dc.RADIUS + 3):
            flips = rng.choice(64, n, replace=False)
            probes.append(int(p) ^ sum(1 << int(f) for f in flips))
    probes = np.array(probes, np.uint64)
    row, at = index.near(probes, items)
    near = np.bitwise_count(probes[:, None] ^ index.prints[None, :]) <= dc.RADIUS
    assert set(zip(row.tolist(), at.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_blocks_of_items_and_empty_tables(spark, frame, words, monkeypatch):
    monkeypatch.setattr(dc, "ITEMS_AT_ONCE", 2)
    assert [len(b) for b in dc.item_blocks(spark.createDataFrame([(i, "t") for i in range(5)], "item_id long, text string"), 2)] == [2, 2, 1]
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(frame([(1, "a b c d e f")]), none).count() == 0
    assert dc.without_items(frame([(1, "a b")]), none).count() == 1
    assert dc.contaminated(frame([]), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")).count() == 0


def test_distant_passages_of_a_long_text(spark, frame, words, monkeypatch):
    """Two items far apart, and one of them again: the first of equal windows is reported whatever the span."""
    items = [(1, " ".join(words(30, 1))), (2, " ".join(words(40, 2)))]
    filler = words(3000, 3)
    text = " ".join([*filler, items[1][1], *filler, items[0][1], *filler, items[1][1], *filler])
    found = []
    for span in (1, 50, 1 << 14):
        monkeypatch.setattr(dc, "SPAN", span)
        offsets, hashes = dc.plain_words(pa.array([text]))
        index = dc.Finder(items).index
        found.append(index.matches(hashes))
    assert found[0] == found[1] == found[2] == {1: (1.0, 3000, 40), 0: (1.0, 6040, 30)}
