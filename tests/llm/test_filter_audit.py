import re
from collections import Counter
from itertools import permutations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm import filter_audit as fa

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, n int"


def fails(text: str, copy: bool) -> str:
    words = WORD.findall(text)
    tests = [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
        copy,
    ]
    return "".join(f for f, t in zip("ABCDE", tests, strict=True) if t)


def brute(rows, labels):
    """Filter by filter, document by document, over all orders. ``rows``: doc_id, lang, text."""
    docs = []
    for i, lang, text in rows:
        t = text or ""
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, _, u in rows)
        good, toxic = (int(any(x is not None and x == i and v[k] == 1 for x, *v in labels)) for k in (0, 1))
        docs.append((lang or "", fails(t, copy), good, toxic))
    out = {}
    for part in {d[0] for d in docs}:
        shapley = Counter()
        for order in permutations("ABCDE"):
            kept = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                lost = [d for d in kept if f in d[1]]
                kept = [d for d in kept if f not in d[1]]
                shapley[f] += len(lost)
                out[part, "".join(order), step] = [
                    len(kept), len(lost), sum(f in d[1] for d in gone), sum(d[0] == part and d[1] == f for d in docs),
                    sum(d[2] for d in lost), sum(d[3] for d in lost),
                ]
                gone += lost
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_equals_brute_force(spark, words):
    many = lambda n, seed: " ".join(words(n, seed))
    texts = ["", None, "A B C", "x # y", many(300, 1), many(300, 1), many(120, 2) + " $", "Z" * 50 + many(150, 3), "same " * 200, "same " * 200,
             many(99, 4), many(100, 5), "é ñ 😀 " * 40, "a\x0bb\x1cc d　e", "100% | & *", "A" * 11 + "b" * 99, "A" * 10 + "b" * 90]
    rows = [(k // 2 * 3, ["en", None, "de", ""][k % 4], t) for k, t in enumerate(texts + texts[4:7])]
    rows += [(None, "en", many(300, 1)), (None, "en", "A B C"), (6, "en", "x # y"), (6, "en", "x # y")]
    labels = [(k, k % 2, k % 3 == 0, 0) for k in range(0, 30, 2)] + [(6, 1, None, 0), (6, 0, 1, 0), (None, 1, 1, 0), (9, None, None, 0)]
    labels = [(i, q, None if t is None else int(t), n) for i, q, t, n in labels]
    docs = spark.createDataFrame(
        [(i, lang, t, "x", 1, b"x") for i, lang, t in rows], "doc_id long, lang string, text string, part string, n int, digest binary"
    )
    got = fa.audit(docs.repartition(3), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 600 * len({r[1] or "" for r in rows})
    assert {tuple(r)[:3]: tuple(r)[3:] for r in got} == brute(rows, [x[:3] for x in labels])


def test_empty_tables(spark, frame):
    labels = spark.createDataFrame([], LABELS)
    assert fa.audit(frame([]), labels).count() == 0
    only = fa.audit(frame([(1, "a few words")]), labels).collect()
    assert len(only) == 600 and {(r.part, r.good_lost, r.toxic_lost) for r in only} == {("en", 0, 0)}
    assert {r.shapley for r in only if r.filter_order[r.step - 1] == "A"} == {120}


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(" \t\n\x0b\x1c aAbé😀#$Z"), max_size=60), min_size=1, max_size=6))
def test_one_pass_equals_regular_expressions(texts):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "part": ["en"] * len(texts), "text": texts})
    got = fa.measured(batch).to_pylist()
    for r, t in zip(got, texts, strict=True):
        found = WORD.findall(t)
        assert (r["n_words"], r["n_distinct"]) == (len(found), len(set(found)))
        assert (r["n_points"], r["n_capitals"], r["n_symbols"]) == (
            len(t), len(re.findall("[A-Z]", t)), len(re.findall(r"[#$%&*|]", t))
        )


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    text = b"aa ab aa abc ab xyz aa"
    data = np.frombuffer(text, np.uint8)
    begins = np.array([m.start() for m in re.finditer(rb"\S+", text)])
    stops = np.array([m.end() for m in re.finditer(rb"\S+", text)])
    monkeypatch.setattr(fa, "span_hashes", lambda data, begins, stops, owner: np.full(len(begins), 5, np.uint64))
    assert fa.distinct_per_owner(data, begins, stops, np.zeros(len(begins), np.int64), 1).tolist() == [4]
    owner = np.array([0, 0, 0, 1, 1, 1, 1])
    assert fa.distinct_per_owner(data, begins, stops, owner, 2).tolist() == [2, 4]
