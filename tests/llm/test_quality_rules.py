import re
from collections import Counter
from math import comb

import pytest

from parcelflow.llm import quality_rules as qr


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    twice, covered = Counter(runs), set()
    for i, r in enumerate(runs):
        if twice[r] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts(spark, frame, words):
    texts = [None, "", " \t\n\x0b\f\r", "one", "a b c d e a b c d e a b", "😀 é #$% |<>& *", "l\nl\n\nm\nl \nl", " lead trail ",
             "\x1c\x85   x", " ".join(words(200, 1) * 2), "x " * 300, "p q r s t u p q r s t v p q r s t"]
    rows = [*enumerate(texts), (None, "a b"), (3, "one")]
    got = qr.quality_verdicts(frame(rows), _labels(spark, [])).collect()
    key = lambda x: tuple(str(v) for v in x)
    assert sorted([(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got], key=key) == sorted(
        [(i, *brute(t)) for i, t in rows], key=key
    )
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)


@pytest.mark.parametrize(("k", "n", "p"), [(0, 10, 0.1), (3, 40, 0.05), (7, 30, 0.5), (30, 30, 0.2)])
def test_binomial_tail(k, n, p):
    assert qr.binomial_tail(k, n, p) == pytest.approx(sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)))


@pytest.mark.parametrize(("k", "n"), [(0, 300), (4, 900), (40, 60)])
def test_upper_bound(k, n):
    assert qr.binomial_tail(k, n, qr.upper_bound(k, n, 0.01)) == pytest.approx(0.01, rel=1e-6)


def test_additions_gain_most_within_the_risk():
    rule = (qr.Rule("r", "a / b", (1.0, 2.0, 3.0)),)
    row = {"good": 5000, "lost": 0, "good_r_0": 49, "bad_r_0": 900, "good_r_1": 10, "bad_r_1": 800, "good_r_2": 0, "bad_r_2": 100}
    assert qr.best_addition(row, set(), rule, 0.01, 0.05) == ("r", 2.0)  # the first would gain more, but endangers the risk
    assert qr.best_addition(row | {"lost": 32}, set(), rule, 0.01, 0.05) == ("r", 3.0)  # what is lost already counts
    assert qr.best_addition(row, {"r"}, rule, 0.01, 0.05) is None


def test_only_prefixes_that_pass_jointly_are_used():
    policy = qr.Policy("en", (("x", 1.0), ("y", 2.0), ("z", 3.0)))
    got = qr.longest_safe(policy, 5000, [10, 20, 49], tests=6, risk=0.01, level=0.05)
    assert got.cutoffs == policy.cutoffs[:2] and (got.good, got.rejected) == (5000, 20) and 0.004 < got.bound <= 0.01
    assert qr.longest_safe(policy, 200, [0, 0, 0], tests=6).cutoffs == ()


def test_joint_rejection_is_bounded_where_each_rule_is_safe(spark):
    """Four rules that each reject 0.5 % of the good documents, all of them others, may not be used together."""
    rules = tuple(qr.Rule(f"r{k}", "a / b", (0.5,)) for k in range(4))
    rows = []
    for lang in ("en", None):
        for i in range(24000):
            good, hit = i % 4 > 0, i // 8 % 200
            rows.append((lang, good, i % 8 >= 4, *(float(hit == k if good else i // 8 % 4 == k or i % 3 == 0) for k in range(4))))
    data = spark.createDataFrame(rows, "_lang string, _good boolean, _aside boolean, r0 double, r1 double, r2 double, r3 double")
    picked = qr.pick_policies(data.where("NOT _aside"), rules, risk=0.012)
    assert {p.lang for p in picked} == {"en", None}
    for p in picked:
        aside = [r for r in rows if r[0] == p.lang and r[1] and not r[2]]
        names = [int(name[1:]) for name, _ in p.cutoffs]
        lost = sum(any(r[3 + k] for k in names) for r in aside)
        assert 1 <= len(names) <= 2 and lost < 0.012 * len(aside)


def test_learned_cutoff_drops_junk_and_keeps_good(spark, frame, words):
    rows, labels = [], []
    for i in range(5200):
        w = words(30, i % 50)
        if i % 13 == 0:
            w = [x + "###" for x in w]
        rows.append((i, " ".join(w)))
        if i % 2 or i % 13:
            labels.append((i, int(i % 13 != 0), 0))
    labels += [(1, None, None), (None, 1, 0), (7, 1, 0)]
    docs = frame(rows)
    got = {r.doc_id: r.kept for r in qr.quality_verdicts(docs, _labels(spark, labels)).collect()}
    assert all(kept == (i % 13 != 0) for i, kept in got.items())
    policies = qr.safe_policies(qr.with_counts(docs.select("doc_id", "lang", "text")), _labels(spark, labels))
    assert policies and all(p.cutoffs and p.rejected == 0 and p.bound <= qr.RISK for p in policies)
    kept = qr.keep_good(docs, _labels(spark, labels))
    assert "SortMergeJoin" not in kept._jdf.queryExecution().sparkPlan().toString()  # texts are not shuffled
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, k in got.items() if k}


def test_empty_tables(spark, frame):
    assert qr.quality_verdicts(frame([]), _labels(spark, [])).count() == 0
    assert qr.keep_good(frame([]), _labels(spark, [(1, 1, 0)])).count() == 0
