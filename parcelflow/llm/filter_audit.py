"""How quality filters interact: what each removes, alone and in every order.

Method: a table-driven byte transducer. One pass over the UTF-8 bytes of a
text looks every byte up in a class table and the pair (state, class) in a
transition table; the outputs count code points, capitals and symbols and mark
where words begin and end. The word spans go into an open-addressing hash
table; a span that meets a used slot is compared with the slot's word byte by
byte, so the number of distinct words is exact. A text's state after a byte
depends on that byte's class alone, so a chunk of texts is run through the
tables at once.

Each document becomes five bits (which filters it fails). Documents are then
counted per part and set of bits, 32 counts at most, and all orders of the
filters are answered from these counts: only narrow rows are ever shuffled,
texts never.

Cases: a null text is empty (no words: fails A, not B or C); a null part
counts as the empty one. Of equal texts the ones with the smallest doc_id pass
E, also where that id is repeated; a null id is neither smaller nor larger
than another, so such rows pass E and have no labels. Repeated rows count each.
Labels of an id that has several rows: 1 if any of them is. Other columns are
left alone, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.common import mapped, mix, stored, table, texts_of

FILTERS = "ABCDE"
LEAST_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
SYMBOLS = b"#$%&*|"
SPACES = b" \t\n\v\f\r"
CHUNK = 1 << 20  # text bytes run through the tables at once

# Classes of bytes.
SPACE, CAPITAL, SYMBOL, CONTINUATION, OTHER = range(5)
# States: outside and inside a word.
OUTSIDE, INSIDE = 0, 1
# Outputs of a step, as bits.
BEGINS, ENDS, POINT, UPPER, SIGN = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    out = np.full(256, OTHER, np.uint8)
    out[0x80:0xC0] = CONTINUATION
    out[ord("A") : ord("Z") + 1] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    out[list(SPACES)] = SPACE
    return out


def _outputs() -> np.ndarray:
    """Output bits by state before the byte and class of the byte."""
    out = np.zeros((2, 5), np.uint8)
    out[:, [SPACE, CAPITAL, SYMBOL, OTHER]] |= POINT
    out[:, CAPITAL] |= UPPER
    out[:, SYMBOL] |= SIGN
    out[OUTSIDE, [CAPITAL, SYMBOL, CONTINUATION, OTHER]] |= BEGINS
    out[INSIDE, SPACE] |= ENDS
    return out


CLASSES, OUTPUTS = _classes(), _outputs()
NEXT_STATE = np.array([OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)  # by class, from either state
STEP = np.array([[OUTPUTS[s, CLASSES[b]] for b in range(256)] for s in (OUTSIDE, INSIDE)], np.uint8)
STATE_AFTER = NEXT_STATE[CLASSES]


def transduce(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs texts ``data[starts:ends]`` (one after the other, none empty) through the tables.

    Returns per text the code points, capitals and symbols, and of all words
    the begin, the end and the text they are in.
    """
    before = np.empty(len(data), np.uint8)
    before[1:] = STATE_AFTER[data[:-1]]
    before[starts] = OUTSIDE
    out = STEP[before, data]
    points, upper, signs = (np.add.reduceat((out & bit) != 0, starts, dtype=np.int64) for bit in (POINT, UPPER, SIGN))
    begins = np.flatnonzero(out & BEGINS)
    closed = ends[STATE_AFTER[data[ends - 1]] == INSIDE]  # a word that the end of its text ends
    stops = np.sort(np.concatenate((np.flatnonzero(out & ENDS), closed)))
    return points, upper, signs, begins, stops, np.searchsorted(ends, begins, "right")


def span_hashes(data: np.ndarray, begins: np.ndarray, stops: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span and its owner."""
    length = stops - begins
    out = mix(owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + length.astype(np.uint64))
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    at, n = np.arange(len(begins)), length
    pos = begins.copy()
    while len(at):  # eight bytes of every span that is not through
        part = np.zeros(len(at), np.uint64)
        for k in range(8):
            byte = np.where(k < n, padded[pos + k], 0)
            part |= byte.astype(np.uint64) << np.uint64(8 * k)
        out[at] = mix(out[at] ^ part)
        more = n > 8
        at, pos, n = at[more], pos[more] + 8, n[more] - 8
    return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of equal ``length`` at ``a`` and at ``b`` hold the same bytes."""
    same = np.ones(len(a), bool)
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    at, n = np.arange(len(a)), length
    while len(at):
        for k in range(8):
            same[at] &= (padded[a[at] + k] == padded[b[at] + k]) | (k >= n)
        more = (n > 8) & same[at]
        at, n = at[more], n[more] - 8
        a, b = a.copy(), b.copy()
        a[at] += 8
        b[at] += 8
    return same


def distinct_per_owner(data: np.ndarray, begins: np.ndarray, stops: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    """Number of different spans of every owner, by rounds of insertion into one open-addressing table.

    In a round every open span looks at its next slot. Free slots go to one of
    the spans that look at them; a span that finds its own bytes is done, any
    other goes on to the next slot.
    """
    slots = 1 << max(4, int(2 * len(begins)).bit_length())
    table, mask = np.full(slots, -1, np.int64), np.uint64(slots - 1)
    hashes, length = span_hashes(data, begins, stops, owner), stops - begins
    found = np.zeros(owners, np.int64)
    open_, slot = np.arange(len(begins)), hashes & mask
    while len(open_):
        free = table[slot] < 0
        table[slot[free]] = open_[free]
        holder = table[slot]
        new = holder == open_
        found += np.bincount(owner[open_[new]], minlength=owners)
        equal = (owner[holder] == owner[open_]) & (length[holder] == length[open_]) & (hashes[holder] == hashes[open_])
        asked = np.flatnonzero(equal & ~new)
        equal[asked] = same_bytes(data, begins[holder[asked]], begins[open_[asked]], length[open_[asked]])
        going = ~(equal | new)
        open_, slot = open_[going], (slot[going] + np.uint64(1)) & mask
    return found


def measured(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Counts of every text of a batch, and a digest that equal texts share."""
    texts = [t.encode() for t in texts_of(batch).to_pylist()]
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    counts = {name: np.zeros(len(texts), np.int64) for name in ("n_words", "n_distinct", "n_capitals", "n_symbols", "n_points")}
    filled = np.flatnonzero(size)
    if len(filled):
        data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size[filled])
        points, upper, signs, begins, stops, owner = transduce(data, ends - size[filled], ends)
        counts["n_points"][filled], counts["n_capitals"][filled], counts["n_symbols"][filled] = points, upper, signs
        counts["n_words"][filled] = np.bincount(owner, minlength=len(filled))
        counts["n_distinct"][filled] = distinct_per_owner(data, begins, stops, owner, len(filled))
    digest = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
    return pa.RecordBatch.from_arrays(
        [batch.column("doc_id"), batch.column("part"), *map(pa.array, counts.values()), digest],
        ["doc_id", "part", *counts, "digest"],
    )


def text_counts(docs: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id, part``, counts of words, distinct words, capitals, symbols and code points, and ``digest`` per document."""
    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string"),
    )
    schema = (
        "doc_id long, part string, n_words long, n_distinct long, n_capitals long, n_symbols long, n_points long, "
        "digest binary"
    )
    return mapped(rows, measured, schema, most=CHUNK)


def failed_by_counts() -> Column:
    """Bits of the filters A to D that fail."""
    conditions = [
        F.col("n_words") < LEAST_WORDS,
        100 * F.col("n_distinct") < DISTINCT_PERCENT * F.col("n_words"),
        100 * F.col("n_capitals") > CAPITAL_PERCENT * F.col("n_points"),
        F.col("n_symbols") > 0,
    ]
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))


def failures(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """``part, failed, n, good, toxic``: documents by the set of filters that they fail (bits, A the lowest)."""
    facts = stored(
        text_counts(docs, part).select("doc_id", "part", "digest", failed_by_counts().alias("_failed")), "filter_counts"
    )
    copied = facts.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    copied = stored(copied.where("_last > _first").select("digest", "_first"), "copied_texts")
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    marked = stored(marked.where("_good = 1 or _toxic = 1"), "marked_documents")
    # stored sides and outer joins: plain shuffles, whose hot ids and texts are split at run time
    joined = facts.join(copied, "digest", "left").join(marked, "doc_id", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    failed = F.col("_failed") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    return joined.groupBy("part", failed.alias("failed")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("_good", F.lit(0))).alias("good"),
        F.sum(F.coalesce("_toxic", F.lit(0))).alias("toxic"),
    )


def steps() -> list[tuple[str, int, int, int]]:
    """Order, step, the step's filter as a bit and the filters before it as bits, for all orders."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order and step; see the module's text for the columns."""
    # 32 cells a part at most
    cells = failures(docs, labels, part).groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("_cells"))
    listed = F.array(*(
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(x).alias("before"))
        for o, s, b, x in steps()
    ))
    rows = cells.select("part", "_cells", F.explode(listed).alias("_step")).select("part", "_cells", "_step.*")
    bit, before = F.col("bit"), F.col("before")
    orders = len(steps()) // len(FILTERS)

    def total(keep: Callable[[Column], Column], value: Callable[[Column], Column] = lambda c: c["n"]) -> Column:
        chosen = F.filter("_cells", lambda c: keep(c["failed"]))
        return F.aggregate(chosen, F.lit(0).cast("long"), lambda sum_, c: sum_ + value(c))

    def removed(f: Column) -> Column:
        return (f.bitwiseAND(bit) != 0) & (f.bitwiseAND(before) == 0)

    return rows.select(
        "part", "filter_order", "step",
        total(lambda f: f.bitwiseAND(bit.bitwiseOR(before)) == 0).alias("kept"),
        total(removed).alias("removed"),
        total(lambda f: (f.bitwiseAND(bit) != 0) & (f.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda f: f == bit).alias("unique_fails"),
        total(removed, lambda c: c["good"]).alias("good_lost"),
        total(removed, lambda c: c["toxic"]).alias("toxic_lost"),
        # of the orders, a document's failing filters come first equally often
        total(
            lambda f: f.bitwiseAND(bit) != 0, lambda c: c["n"] * (F.lit(orders) / F.bit_count(c["failed"])).cast("long")
        ).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), first_ids AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS first_id FROM documents GROUP BY 1
), marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1
), facts AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
        + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
        + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
        + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
        + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS failed
    FROM words JOIN first_ids USING (text) LEFT JOIN marks USING (doc_id)
), cells AS (
    SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM facts GROUP BY 1, 2
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5
), steps AS (
    SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS bit,
        list_sum([0] || [1 << (ascii(substr(filter_order, k, 1)) - 65) FOR k IN range(1, step)])::INT AS before
    FROM orders, (SELECT unnest(range(1, 6))::INT AS step)
), counted AS (
    SELECT part, filter_order, step, bit,
        sum(CASE WHEN failed & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN failed & bit <> 0 AND failed & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN failed & bit <> 0 AND failed & before <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN failed = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN failed & bit <> 0 AND failed & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN failed & bit <> 0 AND failed & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, bit)::BIGINT AS shapley
FROM counted
"""
