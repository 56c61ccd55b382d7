import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm import fingerprints as fp


def plain_digest(text: str) -> tuple[int, int, int, list[int]]:
    """Byte by byte, with Python's integers."""
    data, counts = text.encode(), [0] * fp.BUCKETS
    for start in range(len(data)):
        for salt, (_, i, j) in enumerate(fp.TRIPLETS):
            if start + j < len(data):
                x = data[start] * 0x9E3779B1 + data[start + i] * 0x85EBCA77 + data[start + j] * 0xC2B2AE3D + salt * 256
                x %= 1 << 32
                x ^= x >> 15
                counts[x * 0x2C1B3C6D % (1 << 32) >> 24] += 1
    ranked = sorted(counts)
    q1, q2, q3 = ranked[63], ranked[127], ranked[191]
    codes = [(c > q1) + (c > q2) + (c > q3) for c in counts]
    return min(int(np.floor(8 * np.log2(1 + len(data)))), 255), min(16 * q1 // max(q3, 1), 15), min(16 * q2 // max(q3, 1), 15), codes


def plain_text(digest) -> str:
    length, first, second, codes = digest
    body = "".join(f"{64 * codes[k] + 16 * codes[k + 1] + 4 * codes[k + 2] + codes[k + 3]:02x}" for k in range(0, len(codes), 4))
    return f"{length:02x}{first:x}{second:x}{body}"


def plain_likeness(a, b) -> float:
    cost = [0, 1, 2, 4]
    apart = sum(cost[abs(x - y)] for x, y in zip(a[3], b[3], strict=True))
    apart += min(abs(a[0] - b[0]), 12) + abs(a[1] - b[1]) + abs(a[2] - b[2])
    return 1 - apart / (4 * 256 + 12 + 30)


def brute(rows):
    """Rows in order, by the definition."""
    texts = [t or "" for _, t in rows]
    out = []
    for k, (i, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        half = len(text) // 2
        other = (text[:-half] if half else text) + after[:half]
        a, b, c = plain_digest(text), plain_digest(other), plain_digest(after)
        digest = hashlib.sha256(other.encode()).hexdigest()
        out.append((i, len(text), digest, plain_text(a), plain_text(b), plain_likeness(a, b), plain_likeness(a, c)))
    return out


def texts_of(words):
    odd = [None, "", "a", "ab", "äöü", "😀😀😀 x", "same text here", "same text here", " \n\t "]
    return odd + [" ".join(words(n, n)) for n in (3, 40, 400, 7, 90)] + ["long " * 70_000]


def test_equals_brute_force_over_many_ranges(spark, frame, words):
    rows = [(7 * k % 101, t) for k, t in enumerate(texts_of(words))]
    got = [tuple(r) for r in fp.fingerprints(frame(rows).repartition(5)).orderBy("doc_id").collect()]
    expected = brute(sorted(rows))
    assert [r[:5] for r in got] == [r[:5] for r in expected]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in expected], rtol=0, atol=1e-12)


def test_null_ids_repeated_rows_and_one_row(frame):
    rows = [(None, "no id"), (3, "three"), (3, "three"), (9, "nine nine")]
    got = fp.fingerprints(frame(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == [(False, 3, 5), (False, 3, 5), (False, 9, 9), (True, 0, 5)]
    assert max(r.near_next for r in got if r.doc_id == 3) == 1.0  # a copy comes first, then document 9
    only = fp.fingerprints(frame([(1, "abcdef")])).first()
    assert only.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and only.near_next == 1.0
    assert fp.fingerprints(frame([])).count() == 0


def test_edited_texts_are_nearer_than_other_documents(frame, words):
    vocabulary = words(300, 1)
    rows = [(k, " ".join(vocabulary[7 * k % 290 : 7 * k % 290 + 10] + words(200, k))) for k in range(40)]
    got = fp.fingerprints(frame(rows)).collect()
    assert all(0 <= r.near_next < r.near_edited <= 1 for r in got)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=6))
def test_counts_do_not_depend_on_neighbours_or_blocks(texts):
    data = [t.encode() for t in texts]
    alone = np.concatenate([fp.bucket_counts([t]) for t in data])
    assert (fp.bucket_counts(data) == alone).all()
    whole = sum(max(0, len(data[0]) - j) for _, _, j in fp.TRIPLETS)
    assert alone[0].sum() == whole


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = bytes(np.random.default_rng(3).integers(0, 256, 1000, np.uint8))
    whole = fp.bucket_counts([text])
    monkeypatch.setattr(fp, "BLOCK", 64)
    assert (fp.bucket_counts([text]) == whole).all()
