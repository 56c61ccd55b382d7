"""Quality rules: fixed base rules and thresholds whose false rejections are bounded.

The base counts come from each text with column functions alone. On top, each
rule of ``RULES`` compares one ratio with a cutoff. Cutoffs are chosen per
language from labelled documents, which a hash of the id deals into two halves.
On the picking half a policy grows rule by rule: the rule and cutoff that gain
most beyond what the policy rejects already. On the half set aside each prefix
of the policy is tested as a whole: the good documents that any of its rules
rejects, against ``RISK`` with the exact binomial tail, at ``LEVEL`` divided by
the number of all prefixes of all languages (Bonferroni), which the picking
half alone decides. The longest prefix that passes is used. So with probability
``1 - LEVEL`` all rules together reject at most ``RISK`` of each language's good
documents (of those that pass the base rules, which are fixed). Languages with
too few labels pass no test and get no cutoff.

Cases: a null text has no words and fails the base rules, as an empty one does;
a null language is a stratum of its own; several labels of a document count one
by one, null labels not at all; repeated rows are judged each; ratios without a
denominator are 0; columns beyond ``doc_id, text, lang`` are ignored (and kept
by ``keep_good``); empty tables give empty results and no cutoffs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import SHINGLE_WORDS, salted_left_join, stored, table

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

RISK = 0.01  # per language, of all rules together
LEVEL = 0.05  # of all tests together
FALSE_REJECTION_COST = 5  # good documents weigh so many times a bad one


@dataclass(frozen=True)
class Rule:
    """Rejects where ``sql`` (over the counts) is above the cutoff."""

    name: str
    sql: str
    cutoffs: tuple[float, ...]


# Candidate cutoffs: a coarse grid that doesn't depend on the data.
RULES = (
    Rule("symbols_per_word", "n_symbols / n_words", (0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5)),
    Rule("word_chars_mean", "word_chars / n_words", (5.5, 6.0, 6.5, 7.0, 7.5, 8.0, 9.0, 10.0, 12.0)),
    Rule("duplicate_lines", "n_dup_lines / n_lines", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7)),
    Rule("repeated_words", "n_repeat_words / n_words", (0.02, 0.05, 0.08, 0.12, 0.16)),
    Rule("upper_per_char", "n_upper / word_chars", (0.06, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5)),
    Rule("marks_per_word", "n_marks / n_words", (0.3, 0.5, 0.75, 1.0, 1.5)),
)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct ``counts`` to every row; no shuffle, no Python."""
    kept = [F.col(c) for c in docs.columns]
    clean = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(clean, F.lit(" \t\n\x0b\f\r"))
    step = docs.select(
        F.struct(*kept).alias("_row"),
        clean.alias("_text"),
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+")).alias("_words"),
        F.filter(F.split(clean, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    n, w = F.size("_words"), F.col("_words")
    windows = F.transform(
        F.sequence(F.lit(0), n - SHINGLE_WORDS), lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(SHINGLE_WORDS)))
    )
    step = step.withColumn("_windows", F.when(n >= SHINGLE_WORDS, windows).otherwise(F.array().cast("array<bigint>")))
    # each step below reads the one above as a column, so nothing is computed anew inside a lambda
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn(
        "_sorted",
        F.when(repeats, F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    s = F.col("_sorted")
    twice = F.filter(
        s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
    )
    step = step.withColumn("_at", F.array_sort(F.transform(twice, lambda x: x["i"])))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda p, k: F.least(F.lit(SHINGLE_WORDS), F.coalesce(F.get(at, k + 1) - p, F.lit(SHINGLE_WORDS)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    long = lambda c: c.cast("long")
    counts = F.struct(
        long(n).alias("n_words"),
        long(F.length("_text") - F.regexp_count("_text", F.lit(SPACE))).alias("word_chars"),
        long(F.regexp_count("_text", F.lit(SYMBOLS))).alias("n_symbols"),
        long(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        long(F.coalesce(covered, F.lit(0))).alias("n_repeat_words"),
        long(F.size("_lines")).alias("n_lines"),
        long(F.regexp_count("_text", F.lit(r"\p{Lu}"))).alias("n_upper"),
        long(F.regexp_count("_text", F.lit(r"[!?.,;:]"))).alias("n_marks"),
    )
    # filters on the counts stay above this explode of one; pushed down, they would count inside every lambda
    return step.select("_row", F.explode(F.array(counts)).alias("counts")).select("_row.*", "counts")


def base_failed(counts: str = "counts") -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n)


def measure(rule: Rule, counts: str = "counts") -> Column:
    above, below = (F.col(f"{counts}.{x}") for x in rule.sql.split(" / "))
    return F.when(below > 0, above / below).otherwise(F.lit(0.0))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X ~ Binomial(n, p), summed in log space."""
    if n == 0:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(min(k, n) + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in logs))


def upper_bound(k: int, n: int, level: float) -> float:
    """The exact upper confidence bound of a share of which ``k`` in ``n`` were seen."""
    lo, hi = (k / n if n else 0.0), 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mid < 1 and binomial_tail(k, n, mid) > level else (lo, mid)
    return hi


@dataclass(frozen=True)
class Policy:
    """The cutoffs of a language in the order picked, and what they do on the half set aside."""

    lang: str | None
    cutoffs: tuple[tuple[str, float], ...]
    good: int = 0
    rejected: int = 0
    bound: float = 1.0  # of the share of good documents rejected


def labelled_measures(counted: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``_lang, _good, _aside`` and the measures of labelled documents that pass the base rules."""
    marks = labels.select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_quality")).where("_quality IN (0, 1)")
    rows = counted.where(~base_failed()).select("doc_id", F.col("lang").alias("_lang"), *(measure(r).alias(r.name) for r in rules))
    rows = rows.join(marks, rows["doc_id"] == marks["_labelled"])
    aside = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(2)) == 1
    return rows.select("_lang", (F.col("_quality") == 1).alias("_good"), aside.alias("_aside"), *(r.name for r in rules))


def policy_table(spark: SparkSession, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``_stratum``, and per rule its cutoff and its place in the policy (both null: not used).

    Stored, so that its size is known before the join and decides whether it is broadcast.
    """
    rows = []
    for p in policies:
        cuts = dict(p.cutoffs)
        places = {name: k + 1 for k, (name, _) in enumerate(p.cutoffs)}
        rows.append(("" if p.lang is None else "=" + p.lang, *(x for r in rules for x in (cuts.get(r.name), places.get(r.name)))))
    schema = "_stratum string, " + ", ".join(f"_cut_{r.name} double, _place_{r.name} int" for r in rules)
    return stored(spark.createDataFrame(rows, schema), "policies")


def with_step(rows: DataFrame, lang: str, values: dict[str, Column], policies: DataFrame, spread: Column) -> DataFrame:
    """Adds ``_step``: the place of the first rule that rejects the row, null if none does."""
    # the join key never is null, and null languages meet their own row
    keyed = rows.withColumn("_stratum", F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit(""))).withColumn("_spread", spread)
    joined = salted_left_join(keyed, policies, ["_stratum"], "_spread")
    hits = [F.when(v > F.col(f"_cut_{name}"), F.col(f"_place_{name}")) for name, v in values.items()]
    step = F.array_min(F.array(*hits))
    return joined.withColumn("_step", step).drop("_stratum", "_spread", *(f"_{x}_{name}" for name in values for x in ("cut", "place")))


def best_addition(tally: dict, used: set[str], rules: tuple[Rule, ...], risk: float, level: float) -> tuple[str, float] | None:
    """The rule and cutoff that gain most on top of a policy, if the policy with it still looks safe on the picking half."""
    best, found = 0, None
    for rule in rules:
        for i, cutoff in enumerate(rule.cutoffs) if rule.name not in used else ():
            wrong, right = tally[f"good_{rule.name}_{i}"], tally[f"bad_{rule.name}_{i}"]
            gain, lost = right - FALSE_REJECTION_COST * wrong, tally["lost"] + wrong
            # beyond the mean the tail is over a third, so there is no need to sum it
            if gain > best and lost < risk * tally["good"] and binomial_tail(lost, tally["good"], risk) <= level:
                best, found = gain, (rule.name, cutoff)
    return found


def pick_policies(rows: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, level: float = LEVEL) -> list[Policy]:
    """A policy per language from the picking half; a round of one aggregation adds a rule to each.

    The driver gets a row for each language with enough good labels for any test to pass.
    """
    least = math.log(1 / level) / -math.log1p(-risk)
    values = {r.name: F.col(r.name) for r in rules}
    policies: dict[str | None, Policy] = {}
    good, left = F.col("_good"), F.col("_step").isNull()
    sums = [F.count_if(good).alias("good"), F.count_if(good & ~left).alias("lost")]
    for r in rules:
        for i, c in enumerate(r.cutoffs):
            above = left & (F.col(r.name) > c)
            sums += [F.count_if(good & above).alias(f"good_{r.name}_{i}"), F.count_if(~good & above).alias(f"bad_{r.name}_{i}")]
    for _ in rules:
        stepped = with_step(rows, "_lang", values, policy_table(rows.sparkSession, list(policies.values()), rules), F.xxhash64(*values))
        grown = False
        for t in stepped.groupBy("_lang").agg(*sums).where(F.col("good") >= least).collect():
            old = policies.get(t["_lang"], Policy(t["_lang"], ()))
            added = best_addition(t.asDict(), {name for name, _ in old.cutoffs}, rules, risk, level)
            if added:
                policies[t["_lang"]], grown = Policy(t["_lang"], (*old.cutoffs, added)), True
        if not grown:
            break
    return list(policies.values())


def longest_safe(policy: Policy, good: int, rejected: list[int], tests: int, risk: float = RISK, level: float = LEVEL) -> Policy:
    """The longest prefix whose joint test passes; ``rejected[k]``: good documents that the first ``k + 1`` rules reject."""
    for k in range(len(policy.cutoffs), 0, -1):
        wrong = rejected[k - 1]
        if wrong < risk * good and binomial_tail(wrong, good, risk) <= level / tests:
            return Policy(policy.lang, policy.cutoffs[:k], good, wrong, upper_bound(wrong, good, level / tests))
    return Policy(policy.lang, (), good, 0, 0.0)


def safe_policies(
    counted: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, risk: float = RISK, level: float = LEVEL
) -> list[Policy]:
    """The policies of all languages, picked on one half of the labels and tested on the other."""
    rows = stored(labelled_measures(counted, labels, rules), "labelled-measures")
    picked = pick_policies(rows.where("NOT _aside"), rules, risk, level)
    if not picked:
        return []
    values = {r.name: F.col(r.name) for r in rules}
    table_ = policy_table(rows.sparkSession, picked, rules)
    good = with_step(rows.where("_aside AND _good"), "_lang", values, table_, F.xxhash64(*values))
    sums = [F.count_if(F.col("_step") <= k + 1).alias(f"k{k}") for k in range(len(rules))]
    seen = {
        r["_lang"]: r
        for r in good.where(F.coalesce("_lang", F.lit("")).isin([p.lang or "" for p in picked])).groupBy("_lang").agg(F.count(F.lit(1)).alias("good"), *sums).collect()
    }
    tests = sum(len(p.cutoffs) for p in picked)
    return [
        longest_safe(p, seen[p.lang]["good"], [seen[p.lang][f"k{k}"] for k in range(len(rules))], tests, risk, level)
        for p in picked
        if p.lang in seen
    ]


def judge(counted: DataFrame, policies: list[Policy], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to rows with ``doc_id, lang, counts``."""
    values = {r.name: measure(r) for r in rules}
    stepped = with_step(counted, "lang", values, policy_table(counted.sparkSession, policies, rules), F.xxhash64("doc_id"))
    return stepped.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & F.col("_step").isNull()
    ).drop("_step")


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, the counts, ``base_failed`` and ``kept`` of every document."""
    narrow = docs.select(F.col("doc_id"), F.col("lang").cast("string"), F.col("text"))
    counted = stored(with_counts(narrow).drop("text"), "word-counts")
    return judge(counted, safe_policies(counted, labels)).select("doc_id", "counts.*", "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns.

    They are stored beside their counts, so each text is counted once and none is shuffled.
    """
    named = docs.select(F.struct("*").alias("_document"), "doc_id", F.col("lang").cast("string"), "text")
    counted = stored(with_counts(named).drop("text"), "counted-documents")
    return judge(counted, safe_policies(counted, labels)).where("kept").select("_document.*")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return verdicts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
