"""Personal data in texts: fixed patterns, and spans added by weak supervision.

Base spans (email, ip, card, phone) come from patterns and checks. Beyond them,
every token that might be an identifier or a secret is a candidate. Three kinds
of labelers vote on it - patterns of its shape, a gazetteer of words before it,
and its direct context. Expectation-maximisation over the vote patterns
estimates how reliable each labeler is without any labels; its posteriors train
the span classifier, a logistic model of binned span features. Candidates with
a probability of a half or more become ``secret`` spans, unless they touch a
base span.

Votes and features take few values each, so what is collected for training is a
table of counts whose size is bounded by ``MOST_PATTERNS``, whatever the corpus.
Everything on texts is column functions.

Cases: a null text is empty and has no spans; spans of one kind never overlap,
those of different kinds may; digits without end, dots without end and the like
are matched without recursion; repeated rows are searched each; with no
candidates nothing is added; the work on a text grows with its length and, but
for a logarithm, its matches; other columns are ignored (``redact`` keeps them);
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import stored, table

KINDS = ("email", "ip", "card", "phone", "secret")
ADDED = "secret"

# What the base spans look like. Possessive loops keep long runs off the stack, and a
# run that failed once is not tried again from its middle.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDED = {"email": "@", "phone": "+"}
PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# Candidates: tokens of eight characters and more with a digit in them.
CANDIDATE = r"(?<![A-Za-z0-9])(?=[A-Za-z]*+[0-9])[A-Za-z0-9]{8,}+"
CONTEXT = 24

# Elements of an array merged at once, and code points of a text cut at once.
BLOCK_BITS, PIECE_BITS = 6, 10
BLOCK = 1 << BLOCK_BITS

# Words that introduce identifiers and secrets, and words that introduce harmless numbers.
GAZETTEER = ("token", "password", "passwd", "pwd", "secret", "api key", "apikey", "api_key", "access key", "credential",
             "ssn", "passport", "iban", "account", "contraseña", "passwort", "mot de passe")
HARMLESS = ("version", "license", "licence", "page", "chapter", "section", "year", "isbn", "figure")
LABELERS = ("key_shape", "hex_shape", "words_before", "sign_before", "mixed")
FEATURES = ("size", "letters", "sign", "word")
MOST_PATTERNS = 3 ** len(LABELERS) * 8 * 4 * 4 * 3
EM_ROUNDS = 50
PRIOR = 0.5


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def _before(values: Column, merge: Callable[[Column, Column], Column], levels: int = 2) -> Column:
    """Per element, all elements before it merged (from 0 on).

    A fold that grows an array copies it at every step. Here blocks of ``BLOCK``
    elements are merged, blocks of blocks likewise, and an element looks back
    over less than one block per level.
    """

    def fold(v: Column, lo: Column, n: Column) -> Column:
        return F.aggregate(F.slice(v, lo + 1, n), F.lit(0).cast("long"), merge)

    def blocked(v: Column) -> Column:
        if not levels:
            return F.transform(v, lambda _, i: fold(v, F.lit(0), i))
        blocks = F.sequence(F.lit(0), F.shiftright(F.size(v), BLOCK_BITS))
        whole = F.transform(blocks, lambda b: fold(v, F.shiftleft(b, BLOCK_BITS), F.lit(BLOCK)))
        inside = lambda i: i.bitwiseAND(F.lit(BLOCK - 1))
        return _let(
            _before(whole, merge, levels - 1),
            lambda up: F.transform(v, lambda _, i: merge(F.get(up, F.shiftright(i, BLOCK_BITS)), fold(v, i - inside(i), inside(i)))),
        )

    return _let(values, blocked)


def _below(ordered: Column, bound: Column, equal: bool = False) -> Column:
    """How many elements of a sorted array lie below ``bound`` (``equal``: or at it), by bisection."""
    steps = F.array(*(F.lit(1 << k) for k in range(30, -1, -1)))

    def step(at: Column, n: Column) -> Column:
        there = F.get(ordered, at + n - 1)
        return F.when(there <= bound if equal else there < bound, at + n).otherwise(at)

    return F.aggregate(F.filter(steps, lambda n: n <= F.size(ordered)), F.lit(0), step)


def _spans(matches: Column, gaps: Column, with_context: bool = False) -> Column:
    """``(start, end, match)`` of each match, in code points, from what lies between them.

    ``with_context`` adds ``before``, the ``CONTEXT`` code points before a match.
    Candidates have eight code points at least and don't touch, so three of them
    and the gaps between reach back far enough.
    """

    def described(m: Column, g: Column, at: Column) -> Column:
        def one(match: Column, i: Column) -> Column:
            names = lambda start: [start.alias("start"), (start + F.length(match)).alias("end"), match.alias("match")]
            more = []
            if with_context:
                back = [F.get(x, i - k) for k in (3, 2, 1) for x in (g, m)][1:] + [F.get(g, i)]
                more = [F.substring(F.concat_ws("", *back), -CONTEXT, CONTEXT).alias("before")]
            return _let(F.get(at, i) + F.length(F.get(g, i)), lambda start: F.struct(*names(start), *more))

        return F.transform(m, one)

    def placed(m: Column, g: Column) -> Column:
        sizes = F.transform(m, lambda x, i: (F.length(F.get(g, i)) + F.length(x)).cast("long"))
        return _let(_before(sizes, lambda a, b: a + b), lambda at: described(m, g, at))

    return _let(matches, lambda m: _let(gaps, lambda g: placed(m, g)))


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _checked(kind: str, rank: int) -> Column:
    """The kind's spans that pass its check."""
    valid = F.filter(f"_s_{kind}", lambda s: _valid(kind, s["match"]))
    return F.transform(
        valid,
        lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def with_spans(docs: DataFrame) -> DataFrame:
    """Adds ``base`` (array of kind, start, end by start, then kind) and ``candidates`` to rows with ``text``."""
    rows = docs.select(F.struct("*").alias("_row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text"))
    patterns = {**PATTERNS, "candidate": CANDIDATE}
    matches = {}
    for kind, pattern in patterns.items():
        all_ = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
        if kind in NEEDED:
            all_ = F.when(F.contains("_text", F.lit(NEEDED[kind])), all_).otherwise(F.array().cast("array<string>"))
        matches[f"_m_{kind}"] = all_
    rows = rows.withColumns(matches)
    rows = rows.withColumns(
        {f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split("_text", p, -1)) for k, p in patterns.items()}
    )
    rows = rows.withColumns({f"_s_{k}": _spans(F.col(f"_m_{k}"), F.col(f"_g_{k}"), k == "candidate") for k in patterns})
    base = F.concat(*(_checked(kind, rank) for rank, kind in enumerate(PATTERNS)))
    rows = rows.withColumn("base", F.array_sort(base))
    free = _let(
        F.array_sort(F.transform("base", lambda b: b["start"])),
        lambda starts: _let(
            F.array_sort(F.transform("base", lambda b: b["end"])),
            # spans that begin before the candidate's end but for those that end before it begins
            lambda ends: F.filter("_s_candidate", lambda c: _below(starts, c["end"]) == _below(ends, c["start"], equal=True)),
        ),
    )
    return rows.select("_row", "base", F.transform(free, _described).alias("candidates")).select("_row.*", "base", "candidates")


def _described(c: Column) -> Column:
    """Votes (-1 no, 0 don't know, 1 yes) and binned features of a candidate."""
    token, size = c["match"], F.length(c["match"])
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0).cast("int")

    def seen(before: Column) -> Column:
        listed, harmless = F.lit(False), F.lit(False)
        for w in GAZETTEER:
            listed = listed | F.contains(before, F.lit(w))
        for w in HARMLESS:
            harmless = harmless | F.contains(before, F.lit(w))
        return F.struct(
            listed.alias("listed"),
            harmless.alias("harmless"),
            F.regexp_extract(before, r"([=:\x22'])\x20?\x22?$", 1).alias("near"),
            token.rlike("[A-Z]").alias("upper"),
            token.rlike("[a-z]").alias("lower"),
        )

    def judged(t: Column) -> Column:
        cased, near = t["upper"] | t["lower"], t["near"]
        return F.struct(
            c["start"].alias("start"),
            c["end"].alias("end"),
            vote(token.rlike("^[A-Z]{4}[A-Z0-9]{12,}$") & (size >= 16), token.rlike("^[0-9]+$")).alias("key_shape"),
            vote(token.rlike("^[0-9a-f]{16,}$"), size < 12).alias("hex_shape"),
            vote(t["listed"], t["harmless"]).alias("words_before"),
            vote(near != "", F.lit(False)).alias("sign_before"),
            vote((size >= 16) & cased, ~cased).alias("mixed"),
            F.least(F.floor(size / 6), F.lit(7)).cast("int").alias("size"),
            (t["upper"].cast("int") * 2 + t["lower"].cast("int")).alias("letters"),
            F.when(near == "=", 1).when(near == ":", 2).when(near != "", 3).otherwise(0).cast("int").alias("sign"),
            F.when(t["listed"], 2).when(t["harmless"], 1).otherwise(0).cast("int").alias("word"),
        )

    return _let(_let(F.lower(c["before"]), seen), judged)


# ---- weak supervision: all of this sees counts of patterns only ----------------------------------------------


def reliabilities(votes: np.ndarray, n: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """EM for a naive Bayes model of the labelers.

    ``votes`` is patterns x labelers in -1, 0, 1, and ``n`` counts them. Returns
    the posterior of every pattern and, per labeler, P(vote | class).
    """
    share = 1 / (1 + np.exp(-2.0 * votes.sum(1)))  # starts from the majority
    chance = np.zeros((2, votes.shape[1], 3))
    for _ in range(rounds):
        weight = np.stack([(1 - share) * n, share * n])
        for c in range(2):
            for v in (-1, 0, 1):
                chance[c, :, v + 1] = weight[c] @ (votes == v) + 0.1
        chance /= chance.sum(2, keepdims=True)
        class_ = (weight.sum(1) + 1) / (n.sum() + 2)
        logs = np.log(class_)[:, None] + sum(np.log(chance[:, j, votes[:, j] + 1]) for j in range(votes.shape[1]))
        share = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))
    return share, chance


@dataclass(frozen=True)
class SpanClassifier:
    """Logistic weights per feature value."""

    bias: float
    weights: tuple[dict[int, float], ...]

    def probability(self, c: Column) -> Column:
        score = F.lit(self.bias)
        for name, weights in zip(FEATURES, self.weights, strict=True):
            for value, w in weights.items():
                score = score + F.when(c[name] == value, w).otherwise(0.0)
        return 1 / (1 + F.exp(-score))


def train_classifier(features: np.ndarray, soft: np.ndarray, n: np.ndarray, steps: int = 400, ridge: float = 1.0) -> SpanClassifier:
    """Gradient ascent on counts of feature patterns with soft labels."""
    values = [sorted(set(features[:, j].tolist())) for j in range(features.shape[1])]
    columns = [(features[:, j] == v).astype(float) for j, vs in enumerate(values) for v in vs]
    x = np.column_stack([np.ones(len(features)), *columns])
    w, weight = np.zeros(x.shape[1]), n / n.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        pull = ridge * 1e-4 * w
        pull[0] = 0
        w += 2.0 * (x.T @ (weight * (soft - p)) - pull)
    out, at = [], 1
    for vs in values:
        out.append({int(v): float(w[at + i]) for i, v in enumerate(vs)})
        at += len(vs)
    return SpanClassifier(float(w[0]), tuple(out))


def fit(found: DataFrame) -> SpanClassifier | None:
    """Counts the candidates' patterns, runs EM and trains the classifier; None without candidates."""
    names = [*LABELERS, *FEATURES]
    c = found.select(F.explode("candidates").alias("c")).select(*(F.col(f"c.{x}").alias(x) for x in names))
    rows = c.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # MOST_PATTERNS rows at most
    if not rows:
        return None
    data = np.array([tuple(r) for r in sorted(rows)], float)
    k = len(LABELERS)
    posterior, _ = reliabilities(data[:, :k].astype(int), data[:, -1])
    return train_classifier(data[:, k:-1].astype(int), posterior, data[:, -1])


def all_spans(classifier: SpanClassifier | None) -> Column:
    """Base and added spans by start, then kind."""
    if classifier is None:
        return F.col("base")
    added = F.transform(
        F.filter("candidates", lambda c: classifier.probability(c) >= PRIOR),
        lambda c: F.struct(c["start"].alias("start"), F.lit(len(PATTERNS)).alias("rank"), c["end"].alias("end"), F.lit(ADDED).alias("kind")),
    )
    return F.array_sort(F.concat("base", added))


def listed_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def find_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, a count per base kind, the digest of the base spans and all spans."""
    found = stored(with_spans(docs.select("doc_id", "text")).drop("text"), "spans")
    spans = all_spans(fit(found))
    count = lambda k: F.size(F.filter("base", lambda b: b["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in PATTERNS),
        F.sha2(listed_spans(F.col("base")), 256).alias("base_sha256"),
        listed_spans(spans).alias("spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    """``text`` with its spans replaced; a span that begins inside earlier ones goes with them.

    Parts are cut from pieces of the text, since cutting from the whole would
    count its code points from the beginning each time.
    """

    def cut(pieces: Column, lo: Column, hi: Column) -> Column:
        first, last = (F.shiftright(x.cast("int"), PIECE_BITS) for x in (lo, hi))
        near = F.array_join(F.slice(pieces, first + 1, last - first + 1), "")
        return F.substr(near, (lo - F.shiftleft(first, PIECE_BITS) + 1).cast("int"), (hi - lo).cast("int"))

    def joined(pieces: Column, s: Column, at: Column) -> Column:
        parts = F.transform(
            s,
            lambda x, i: F.when(
                x["start"] >= F.get(at, i),
                F.concat(cut(pieces, F.get(at, i), x["start"]), F.lit("<"), F.upper(x["kind"]), F.lit(">")),
            ).otherwise(""),
        )
        end = F.array_max(F.transform(s, lambda x: x["end"]))
        return F.concat(F.array_join(parts, ""), _let(end, lambda e: cut(pieces, e, F.greatest(e, F.length(text).cast("long")))))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{1 << PIECE_BITS}}}+"), F.lit(0))
    ends = lambda s: F.transform(s, lambda x: x["end"])
    return _let(pieces, lambda p: _let(spans, lambda s: _let(_before(ends(s), lambda a, b: F.greatest(a, b)), lambda at: joined(p, s, at))))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind, such as ``<EMAIL>``; ``n_chars`` follows."""
    named = docs.select(F.struct("*").alias("_document"), F.col("text"))
    found = with_spans(named)
    classifier = fit(found)
    masked = found.withColumn("_spans", all_spans(classifier))
    text = F.col("text")
    clean = F.when(F.size("_spans") > 0, _masked(text, F.col("_spans"))).otherwise(text)
    rows = masked.withColumn("_clean", clean)
    out = []
    for c in docs.columns:
        if c == "text":
            out.append(F.col("_clean").alias("text"))
        elif c == "n_chars":
            kind = docs.schema["n_chars"].dataType
            same = F.col("_document.n_chars")
            out.append(F.when(F.size("_spans") > 0, F.length("_clean").cast(kind)).otherwise(same).alias("n_chars"))
        else:
            out.append(F.col(f"_document.`{c}`").alias(c))
    return rows.select(*out)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spans(table(spark, sf_dir, "documents"))
