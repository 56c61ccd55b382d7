import sentencepiece

from parcelflow.llm import token_counts


def test_counts_match_the_library(frame, words):
    texts = [None, "", " ", "\n", "\n\n", "a", "a\n", "\na", "a\nb c", "two  spaces", " lead", "trail ", "a \nb", "a\n b", "tab\tx\r\ny", "▁a a▁b",
             "<s> </s> <unk>\n<0x0A>", "é à\nÉ ñ 😀", "a\x00b", "﻿x  y", " ".join(words(400, 1)), "x" * 5000, "日本語 テスト\n日本", "The the THE\nThe"]
    rows = [*enumerate(texts), (None, "a b"), (4, "\n\n"), (99, "word " * 5000)]
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    key = lambda x: tuple(str(v) for v in x)
    got = sorted([tuple(r) for r in token_counts.token_counts(frame(rows)).collect()], key=key)
    expected = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in rows]
    assert got == sorted(expected, key=key)


def test_proof():
    proof = token_counts.prove(token_counts.model_path())
    model = sentencepiece.SentencePieceProcessor(model_file=token_counts.model_path())
    assert proof.separable and len(proof.whole) > 10_000
    assert all(len(model.encode(w)) == 1 for w in list(proof.whole)[:500])


def test_empty_table(frame):
    assert token_counts.token_counts(frame([])).count() == 0
