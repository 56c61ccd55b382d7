import json
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from parcelflow.llm import packing


def _check(got, capacity):
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places)


def test_pieces_and_packing(frame):
    texts = ["", None, "Hello, WORLD's end... it’s", "a\u0301 é É <|endoftext|> x<|startoftext|>y", "\x1c\x85\u2003wide\tspaces\n",
             "Straße, naïve; (bracketed) foo's we'll 'tis", "word " * 5000, "don't. DON'T! ñandú,", "日本語 テスト 😀"]
    rows = list(enumerate(texts)) + [(3, texts[3]), (None, "x")]
    got = packing.pack_documents(frame(rows)).collect()
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    expected = []
    for i, t in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], "<u4")
            expected.append((i, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=key) == sorted(expected, key=key)
    assert _check(got, 2048) == -(-sum(e[3] for e in expected) // 2048)


def test_words_are_encoded_apart_only_where_the_definition_allows(tmp_path):
    with open(packing.tokenizer_path(), encoding="utf-8") as f:
        definition = json.load(f)
    assert packing.is_wordwise(definition)
    definition["normalizer"]["normalizers"].pop()  # no lower case
    assert not packing.is_wordwise(definition)
    other = tmp_path / "cased.json"
    other.write_text(json.dumps(definition))
    texts = pa.array(["Word word, WORD", "", "a  b"])
    ends, ids = packing.WordIds(str(other))(texts)
    tokenizer = Tokenizer.from_file(str(other))
    assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [tokenizer.encode(t).ids for t in texts.to_pylist()]


def test_ids_of_all_words_are_those_of_the_library():
    marks = "!#$%&*+,./:;=?@^_~()[]-'\"<>|{}`\\"
    words = [a + m + b for a in ("Ab", "ÀÉß", "Ωx", "i\u0307", "I\u0130", "e\u0301", "7a", "") for m in (*marks, "...", "'s", "'LL", "") for b in ("", "z", "\u0301", "9")]
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    for kept in (400_000, 0):
        reader = packing.WordIds(packing.tokenizer_path())
        packing.KEPT_WORDS, before = kept, packing.KEPT_WORDS
        try:
            for texts in ([*words, " ".join(words)], [" ".join(words[::-1])]):
                ends, ids = reader(pa.array(texts))
                assert [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        finally:
            packing.KEPT_WORDS = before


def test_as_good_as_sequential_best_fit(spark):
    lengths = [int(x) for x in np.random.default_rng(5).integers(1, 101, 3000)] + [1] * 900 + [51] * 300
    rows = [(i, 0, 0, n, i) for i, n in enumerate(lengths)]
    got = packing.pack(spark.createDataFrame(rows, packing.PIECES), 100).collect()
    assert len(got) == len(lengths) and {r.doc_id for r in got} == set(range(len(lengths)))
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [(free, i) for i, free in enumerate(bins) if free >= n]
        if fits:
            bins[min(fits)[1]] -= n
        else:
            bins.append(100 - n)
    assert _check(got, 100) <= len(bins) * 1.01


def test_empty_table(frame):
    assert packing.pack_documents(frame([])).count() == 0
