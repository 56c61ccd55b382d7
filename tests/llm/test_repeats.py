import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from parcelflow.llm import repeats


def brute(rows):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    out = []
    for (doc_id, _), t in zip(rows, texts, strict=True):
        gone = repeats.removed_runs([(i, 1) for i in range(len(t) - 399) if seen[t[i : i + 400]] > 1])
        kept, at = b"", 0
        for a, b in gone:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        out.append((str(doc_id), len(t), len(t) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _rows():
    source = random.Random(3)
    base = "".join(source.choice("abcdefgh é") for _ in range(3000))
    texts = [base, base[:1500] + "X" + base[1501:], base[200:900], "z" * 1500, "z" * 900, None, "", base[:399], base[:330], "ab" * 1000,
             base[1000:1400] + "q" * 300 + base[1000:1400], base, "w" * 400, "😀" * 250]
    texts += [base[:600] + chr(0x4E00 + i) + base[600:1200] for i in range(40)]
    return [*enumerate(texts), (None, "only " * 30), (3, "z" * 1500)]


@pytest.mark.parametrize("big", [4000, 12])
def test_matches_brute_force(frame, monkeypatch, big):
    monkeypatch.setattr(repeats, "BIG", big)
    rows = _rows()
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(frame(rows)).collect())
    assert got == brute(rows)


def test_segments_of_long_texts(frame, monkeypatch):
    monkeypatch.setattr(repeats, "SEGMENT_BITS", 11)
    monkeypatch.setattr(repeats, "SEGMENT", 2048)
    source = random.Random(4)
    part = "".join(source.choice("abcdef") for _ in range(900))
    long = "".join(source.choice("abcdef") for _ in range(20_000))
    rows = [(1, long[:5000] + part + long[5000:]), (2, long[15_000:] + part), (3, part)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(frame(rows)).collect())
    assert got == brute(rows)


def test_hashes_do_not_depend_on_their_chunk(frame):
    find, size = repeats.Anchors(), np.array([500])
    high = next(c for c in "abcdefghijklmnopqrstuvwxyz" if next(find(np.full(500, ord(c), np.uint8), size - 500, size))[1] >= 1 << 63)
    source = random.Random(5)
    base = "".join(source.choice("abcdefgh") for _ in range(1500))
    rows, alone = [(1, base), (2, high * 500)], [(3, base)]
    docs = frame(rows).coalesce(1).union(frame(alone).repartition(2))  # in two partitions: Spark merges unions of single ones
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.remove_repeats(docs).collect())
    assert got == brute(rows + alone)


def test_columns_of_an_aligned_collection():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 3, repeats.WIDTH).astype(np.uint8)
    grid = np.tile(base, (30, 1))
    for row in grid:
        row[rng.integers(0, repeats.WIDTH, 2)] = 9
    begin, end = rng.integers(0, 200, 30), rng.integers(500, repeats.WIDTH + 1, 30)
    found = repeats.repeated_columns(grid, begin, end)
    for c in range(repeats.SPAN + 1):
        inside = [i for i in range(30) if begin[i] <= c and c + 400 <= end[i]]
        seen = Counter(grid[i, c : c + 400].tobytes() for i in inside)
        for i in range(30):
            assert found[i, c] == (i in inside and seen[grid[i, c : c + 400].tobytes()] > 1)


def test_empty_table(frame):
    assert repeats.remove_repeats(frame([])).count() == 0
