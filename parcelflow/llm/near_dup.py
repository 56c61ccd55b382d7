"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds the hashes of its five-word shingles. Equal sets are one
class, and a class is joined through its smallest document. Every class carries
``COORDINATES`` minwise tokens. A tree branches the classes by tokens at chosen
coordinates: a node picks each coordinate with probability ``1 / (SIMILARITY *
COORDINATES)``, from a hash of the node alone, so similar classes take the same
paths without knowing of each other. A pair at the threshold meets in about one
child per node it shares and is the likelier lost the more levels it passes, so
the independent roots a class gets grow with the level it reaches: a class that
is still in a branching node at a level takes part in as many more roots as
keep pairs at the threshold from being missed there (see ``missed``). The
recall thus holds for any ``NODE``, which is a matter of cost only.

Nodes of up to ``SMALL`` classes are compared exhaustively. In larger ones each
class is first compared with the node's smallest class. Copies by the thousand
are linked that way at the first node they share, and a node whose classes lie
in one component is closed. Open nodes of up to ``NODE`` classes are then
compared exhaustively inside a task, which holds that many sketches and sets;
larger ones branch on, and dissimilar classes part. There is no cap: after
``DEEP`` levels what is left is compared exhaustively, in tasks that hold two
blocks of a node's classes each. Tasks emit links that join two components
only, and look at a pair in one of the nodes it shares, so nothing grows with
the pairs of a node but the comparing itself.

Compared pairs pass a sketch (four bits of each minwise token) five standard
deviations below the threshold, and then the full shingle sets decide. Pairs
within one component need no check, since only components are asked for.

Cases: null and empty texts, and texts without words, have the empty set and no
links; fewer than five words are one shingle; rows that share a ``doc_id`` are
one document; rows without one are never linked, have no component and are
kept; repeated rows come back as often as they are; other columns are ignored
(``one_of_each`` keeps them); an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelflow.llm.bloom import with_possible
from parcelflow.llm.common import chunks, mapped, mix, released, salted_left_join, shingle_sets, short_batches, stored, table, texts_of
from parcelflow.llm.components import components

COORDINATES = 128
PERCENT = 75
SIMILARITY = PERCENT / 100
# Every class takes part in 24 roots, which miss a pair at the threshold with 7e-7 in two levels. Deeper ones take as
# many as keep that under MISS: 30, 41, 68 and 104 for 3, 4, 6 and 8 levels.
ROOTS = 24
MISS = 1e-5
SMALL = 12
# A level multiplies rows by 4/3 besides the further roots; from here on comparing all is cheaper.
DEEP = 8
CHUNK = 2 << 20  # text bytes whose shingle sets a worker holds at once
NODE = 4000
NODE_SHINGLES = 2 << 20  # 16 MB of sets, which a task holds about twice
SKETCH_WORDS = 8
# Agreements of the four-bit sketch at the threshold: 98 of 128, with a standard deviation of 4.8.
SKETCH_LEAST = 74


def _multipliers() -> np.ndarray:
    return mix(np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minwise(sets: list[np.ndarray]) -> np.ndarray:
    """The minwise tokens (uint32) of non-empty sets, a row each."""
    out = np.empty((len(sets), COORDINATES), np.uint32)
    factors = _multipliers()
    lo = 0
    while lo < len(sets):
        hi, total = lo, 0
        while hi < len(sets) and (hi == lo or total + len(sets[hi]) <= 1 << 16):
            total += len(sets[hi])
            hi += 1
        x = np.concatenate(sets[lo:hi])
        starts = np.cumsum([0, *(len(s) for s in sets[lo : hi - 1])])
        for t, factor in enumerate(factors):
            hashed = ((x * factor) >> np.uint64(32)).astype(np.uint32)
            out[lo:hi, t] = np.minimum.reduceat(hashed, starts)
        lo = hi
    return out


def sketch(tokens: np.ndarray) -> np.ndarray:
    """Four bits of each token, 16 tokens to a 64-bit word."""
    small = (tokens & 15).astype(np.uint64).reshape(len(tokens), SKETCH_WORDS, 16)
    return np.bitwise_or.reduce(small << (np.arange(16, dtype=np.uint64) * np.uint64(4)), axis=2).astype(np.uint64).view(np.int64)


# ---- trees ----------------------------------------------------------------------------------------------------


def missed(depth: int, n_roots: np.ndarray) -> np.ndarray:
    """How likely a pair at the threshold shares no node ``depth`` levels below any of so many roots.

    The root counts as a level. Averaged over the coordinates at which the two
    agree, binomial(``COORDINATES``, ``SIMILARITY``), since all roots see the same.
    """
    agree = np.arange(COORDINATES + 1)
    ways = np.array([math.comb(COORDINATES, int(k)) for k in agree], float)
    weight = ways * SIMILARITY**agree * (1 - SIMILARITY) ** (COORDINATES - agree)
    shared = np.ones(COORDINATES + 1)
    for _ in range(depth - 1):
        shared = 1 - (1 - shared / (SIMILARITY * COORDINATES)) ** agree
    return weight @ (1 - agree / COORDINATES * shared)[:, None] ** np.asarray(n_roots)[None, :]


@functools.cache
def roots_for(depth: int) -> int:
    """Roots that keep pairs of classes in nodes of ``depth`` levels from being missed more often than ``MISS``."""
    lo = ROOTS
    while True:
        good = np.flatnonzero(missed(depth, np.arange(lo, lo + 512)) <= MISS)
        if len(good):
            return lo + int(good[0])
        lo += 512


def roots(n: int) -> np.ndarray:
    """The coordinates picked at the first ``n`` roots: all of them in turn."""
    order = np.random.default_rng(7).permutation(COORDINATES)
    return np.resize(order, n)


def child_nodes(nodes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Children of ``nodes`` (int64), one row of ``tokens`` each: row numbers and child nodes."""
    limit = np.uint64(int(2.0**64 / (SIMILARITY * COORDINATES)))
    parts = []
    columns = mix(np.arange(COORDINATES, dtype=np.uint64) + np.uint64(0x51))
    for lo in range(0, len(nodes), 4096):
        draw = mix(nodes[lo : lo + 4096].view(np.uint64)[:, None] + columns[None, :])
        row, at = np.nonzero(draw < limit)
        parts.append((row + lo, at))
    row = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, np.int64)
    at = np.concatenate([p[1] for p in parts]) if parts else np.empty(0, np.int64)
    child = mix(mix(nodes[row].view(np.uint64) + columns[at]) + tokens[row, at].astype(np.uint64))
    return row, child.view(np.int64)


def first_nodes(tokens: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and nodes two levels below the roots ``lo`` to ``hi`` (not included) of each row, some at a time."""
    if not len(tokens):
        return
    picked = roots(int(hi.max()))
    seeds = mix(np.arange(len(picked), dtype=np.uint64) * np.uint64(1 << 20) + picked.astype(np.uint64))
    row = np.repeat(np.arange(len(tokens)), hi - lo)
    at = np.arange(len(row)) - np.repeat(np.cumsum(hi - lo) - hi, hi - lo)
    for k in range(0, len(row), 1 << 15):
        r, t = row[k : k + (1 << 15)], at[k : k + (1 << 15)]
        nodes = mix(seeds[t] + tokens[r, picked[t]].astype(np.uint64))
        below, child = child_nodes(nodes.view(np.int64), tokens[r])
        yield r[below], child


def _tokens(column: pa.Array) -> np.ndarray:
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, "<u4").reshape(len(column), COORDINATES)


def _branched(rows: DataFrame, first: bool) -> DataFrame:
    """``node, rep`` one level on from ``node, rep, tokens``, or two levels below the roots from ``rep, tokens, lo, hi``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                tokens = _tokens(part.column("tokens"))
                if first:
                    found = first_nodes(tokens, part.column("lo").to_numpy(), part.column("hi").to_numpy())
                else:
                    found = [child_nodes(part.column("node").to_numpy(), tokens)]
                for row, child in found:
                    yield pa.RecordBatch.from_arrays([pa.array(child), part.column("rep").take(pa.array(row))], ["node", "rep"])

    return rows.mapInArrow(lambda batches: released(run(batches)), "node long, rep long")


# ---- sets -----------------------------------------------------------------------------------------------------


def document_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, set_key, tokens`` (both null for the empty set) and the sketch ``s0 .. s7``."""

    def read(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingle_sets(texts_of(batch)))
        filled = [s for s in sets if len(s)]
        tokens = minwise(filled)
        where = np.cumsum([len(s) > 0 for s in sets]) - 1
        packed = sketch(tokens)
        bits = np.zeros((len(sets), SKETCH_WORDS), np.int64)
        some = np.array([len(s) > 0 for s in sets], bool)
        bits[some] = packed
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                pa.array([tokens[i].tobytes() if some[k] else None for k, i in enumerate(where)], pa.binary()),
                *(pa.array(bits[:, j]) for j in range(SKETCH_WORDS)),
            ],
            ["doc_id", "n_shingles", "set_key", "tokens", *(f"s{j}" for j in range(SKETCH_WORDS))],
        )

    words = ", ".join(f"s{j} long" for j in range(SKETCH_WORDS))
    return mapped(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        read,
        f"doc_id long, n_shingles long, set_key binary, tokens binary, {words}",
        most=CHUNK,
    )


def similar_sets(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``a, b`` whose full shingle sets reach ``percent``."""
    wanted = stored(pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct(), "wanted")
    # a Bloom filter keeps the other texts out of the shuffles; the joins below are exact
    texts = with_possible(docs.select(F.col("doc_id").cast("long"), "text"), "doc_id", wanted, "_id").where("possible")
    texts = stored(texts.select("doc_id", "text").distinct(), "wanted-texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text_b", CHUNK):
            ok = []
            for some in chunks(iter([part]), "text_a", CHUNK):
                for x, y in zip(shingle_sets(texts_of(some, "text_a")), shingle_sets(texts_of(some, "text_b")), strict=True):
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    ok.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return short_batches(both).mapInArrow(lambda batches: released(run(batches)), "a long, b long").distinct()


# ---- the join -------------------------------------------------------------------------------------------------


class Join:
    """Links found so far and the components they make."""

    def __init__(self, docs: DataFrame, classes: DataFrame):
        self.docs, self.classes = docs, classes
        self.tried: DataFrame | None = None
        self.links: DataFrame | None = None
        self.labels: DataFrame | None = None

    def labelled(self, rows: DataFrame, column: str, label: str) -> DataFrame:
        """Adds the component of ``column`` (itself where it has no link yet)."""
        if self.labels is None:
            return rows.withColumn(label, F.col(column))
        known = self.labels.select(F.col("id").alias(column), F.col("label").alias(label))
        return rows.join(known, column, "left").withColumn(label, F.coalesce(label, column))

    def apart(self, pairs: DataFrame) -> DataFrame:
        rows = self.labelled(self.labelled(pairs, "a", "_la"), "b", "_lb")
        return rows.where("_la <> _lb").drop("_la", "_lb")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sketches agree often enough, with ``agree``."""
        words = [f"s{j}" for j in range(SKETCH_WORDS)]
        side = lambda x: self.classes.select(F.col("rep").alias(x), F.col("n_shingles").alias(f"n_{x}"), *(F.col(w).alias(f"{x}_{w}") for w in words))
        rows = pairs.join(side("a"), "a").join(side("b"), "b")
        least, most = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
        differ = F.lit(0)
        for w in words:
            x = F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))
            x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
            x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
            differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
        return rows.where(100 * least >= PERCENT * most).withColumn("agree", COORDINATES - differ).where(
            F.col("agree") >= SKETCH_LEAST
        ).select("a", "b", "agree")

    def add(self, pairs: DataFrame, turns: int = 1) -> None:
        """Checks pairs between components and joins the components they link.

        With two turns each class tries its most similar partner first; most
        other pairs then lie within a component and need no check.
        """
        rest = stored(self.new(self.likely(self.apart(pairs))), "likely-pairs")
        best = rest.groupBy("b").agg(F.max_by("a", F.struct("agree", -F.col("a"))).alias("a")).select("a", "b")
        for turn in range(turns):
            now = best if turn < turns - 1 else self.apart(rest.select("a", "b"))
            if turn:
                now = now.join(best, ["a", "b"], "left_anti")
            now = stored(now, "tried-pairs")
            if now.isEmpty():
                return
            self.tried = now if self.tried is None else self.tried.union(now)
            self.link(similar_sets(now, self.docs))

    def new(self, pairs: DataFrame) -> DataFrame:
        """The pairs not tried before."""
        return pairs if self.tried is None else pairs.join(self.tried, ["a", "b"], "left_anti")

    def link(self, found: DataFrame) -> None:
        found = stored(found, "links")
        if not found.isEmpty():
            self.links = found if self.links is None else self.links.union(found)
            self.labels = components(self.links)


def first_pairs(rows: DataFrame) -> DataFrame:
    """Pairs to compare at once, from ``node, rep, label, n, pivot``: with the smallest class, and all of small nodes."""
    star = rows.where("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    few = rows.where(f"rep <> pivot AND n > 2 AND n <= {SMALL}")
    left = few.select("node", F.col("rep").alias("a"), F.col("label").alias("_la"))
    right = few.select("node", F.col("rep").alias("b"), F.col("label").alias("_lb"))
    rest = left.join(right, "node").where("a < b AND _la <> _lb").select("a", "b")
    return star.union(rest).distinct()


def units(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``node, rep`` dealt into units that a task can hold: ``unit, own, whole, node, rep``.

    ``blocks`` has ``node, blocks``: a node's classes are hashed into that many
    blocks, and a unit holds one block (``whole``: compare it inside) or two
    (compare one with the other). So every pair of a node is in one unit.
    """
    rows = rows.select("node", "rep").join(blocks, "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    rows = rows.withColumn("_other", F.explode(F.expr("sequence(0L, blocks - 1)")))
    unit = F.when(F.col("blocks") == 1, F.col("node")).otherwise(F.xxhash64("node", F.least("own", "_other"), F.greatest("own", "_other")))
    return rows.select(unit.alias("unit"), "own", (F.col("own") == F.col("_other")).alias("whole"), "node", "rep")


class Unit:
    """The classes of a unit in memory, and which of their pairs are to be looked at here."""

    def __init__(self, t: pa.Table):
        self.rep, self.label, self.size, self.own = (t.column(c).to_numpy().copy() for c in ("rep", "label", "n_shingles", "own"))
        self.bits = np.column_stack([t.column(f"s{j}").to_numpy() for j in range(SKETCH_WORDS)]).view(np.uint64)
        self.node = t.column("node")[0].as_py()
        self.across = not t.column("whole").to_numpy(zero_copy_only=False).all()
        # a pair is looked at in the smallest of the nodes that it shares
        self.before = [{m for m in nodes if m < self.node} for nodes in t.column("nodes").to_pylist()]

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs in two components whose sketches agree often enough, the most alike of a stripe first."""
        for lo in range(0, len(self.rep), 32):
            x = self.bits[lo : lo + 32, None, :] ^ self.bits[None, lo:, :]
            x |= x >> np.uint64(1)
            x |= x >> np.uint64(2)
            agree = COORDINATES - np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(2, dtype=np.int32)
            ok = (agree >= SKETCH_LEAST) & (self.label[lo : lo + 32, None] != self.label[None, lo:])
            if self.across:
                ok &= self.own[lo : lo + 32, None] != self.own[None, lo:]
            row, at = np.nonzero(ok)
            keep = at > row
            row, at = row[keep], at[keep]
            small, large = np.minimum(self.size[row + lo], self.size[at + lo]), np.maximum(self.size[row + lo], self.size[at + lo])
            alike = 100 * small >= PERCENT * large
            row, at = row[alike], at[alike]
            order = np.argsort(-agree[row, at], kind="stable")
            yield row[order] + lo, at[order] + lo

    def first_here(self, i: int, j: int) -> bool:
        return self.before[i].isdisjoint(self.before[j])

    def active(self) -> pa.Array:
        """The classes with a candidate partner: only their sets are needed."""
        some = np.zeros(len(self.rep), bool)
        for rows, ats in self.candidates():
            for i, j in zip(rows.tolist(), ats.tolist(), strict=True):
                if not (some[i] and some[j]) and self.first_here(i, j):
                    some[i] = some[j] = True
        return pa.array(self.rep[some])

    def links(self, sets: list[np.ndarray], percent: int) -> tuple[list[int], list[int]]:
        """Pairs that reach ``percent``; none between classes that earlier links already join."""
        a, b = [], []
        for rows, ats in self.candidates():
            for i, j in zip(rows.tolist(), ats.tolist(), strict=True):
                if self.label[i] != self.label[j] and self.first_here(i, j):
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                        a.append(int(min(self.rep[i], self.rep[j])))
                        b.append(int(max(self.rep[i], self.rep[j])))
                        self.label[self.label == self.label[j]] = self.label[i]
        return a, b


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The units of a partition sorted by unit, one after the other."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        unit = batch.column("unit").to_numpy()
        cuts = [0, *(np.flatnonzero(unit[1:] != unit[:-1]) + 1), len(unit)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if hi > lo:
                if held and unit[lo] != last:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(lo, hi - lo))
                last = unit[lo]
    if held:
        yield pa.Table.from_batches(held)


def links_in_nodes(inside: DataFrame, docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links ``a, b`` that join the similar classes of every node (``node, rep, label``) of ``inside``.

    Tasks first compare sketches and name the classes that have a partner at
    all; these come again with their full sets, and tasks emit a link only
    where it joins two components. So rows grow with the classes of a node,
    never with its pairs. Units hold up to ``NODE`` classes and about
    ``NODE_SHINGLES`` hashes; larger nodes are compared block by block.
    """
    lists = stored(inside.groupBy("rep").agg(F.collect_list("node").alias("nodes"), F.min("label").alias("label")), "nodes-of-classes")
    sketches = classes.drop("tokens").join(lists, "rep")
    counts = inside.groupBy("node").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.when(F.col("n") <= NODE, 1).otherwise(F.ceil(2 * F.col("n") / NODE)).cast("long")
    held = units(inside, counts.select("node", blocks.alias("blocks"))).join(sketches, "rep")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _grouped(batches):
            unit = Unit(t)
            reps = unit.active()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(reps), unit.node, np.int64)), reps], ["node", "rep"])

    sorted_units = held.repartition("unit").sortWithinPartitions("unit")
    active = stored(sorted_units.mapInArrow(lambda batches: released(name(batches)), "node long, rep long").distinct(), "active-classes")

    sizes = active.join(classes.select("rep", "n_shingles"), "rep").groupBy("node").agg(
        F.sum("n_shingles").alias("_all"), F.count(F.lit(1)).alias("n")
    )
    many = F.greatest(F.ceil(2 * F.col("_all") / NODE_SHINGLES), F.ceil(2 * F.col("n") / NODE))
    fits = (F.col("_all") <= NODE_SHINGLES) & (F.col("n") <= NODE)
    sizes = stored(sizes.select("node", F.when(fits, 1).otherwise(many).cast("long").alias("blocks")), "node-blocks")
    ids = stored(active.select("rep").distinct(), "wanted")
    texts = with_possible(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", ids, "rep")

    def sets_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [x.tobytes() for x in shingle_sets(texts_of(batch))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["rep", "shingles"])

    sets = mapped(texts.where("possible").select("doc_id", "text"), sets_of, "rep long, shingles binary", most=CHUNK)
    sets = sets.join(ids, "rep").dropDuplicates(["rep"])  # a doc_id may have many rows
    rows = units(active, sizes).join(sketches.join(sets, "rep"), "rep")

    def check(t: pa.Table) -> pa.Table:
        a, b = Unit(t).links([np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")], percent)  # views, no copies
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("unit").applyInArrow(check, "a long, b long")


def descend(join: Join, level: DataFrame) -> list[DataFrame]:
    """Compares the classes of ``level`` (``node, rep``, two levels below roots) node by node, to the last level.

    Returns ``rep, depth`` of the classes in nodes that branched, with the level they came to.
    """
    classes, reached = join.classes, []
    for depth in range(2, DEEP + 1):
        open_ = join.labelled(level, "rep", "label").groupBy("node").agg(
            F.count(F.lit(1)).alias("n"), F.min("rep").alias("pivot"), F.min("label").alias("_lo"), F.max("label").alias("_hi")
        )
        open_ = stored(open_.where("n > 1 AND _lo <> _hi").drop("_lo", "_hi"), "open-nodes")
        rows = stored(join.labelled(level.join(open_, "node"), "rep", "label"), "members")
        join.add(first_pairs(rows), turns=2 if depth == 2 else 1)

        large = stored(join.labelled(rows.where(F.col("n") > SMALL).select("node", "rep"), "rep", "label"), "large-nodes")
        parts = large.groupBy("node", "label").agg(F.count(F.lit(1)).alias("_c"))
        nodes = parts.groupBy("node").agg(
            F.sum("_c").alias("n"), F.max("_c").alias("_most")
        )
        nodes = stored(nodes.where("n > _most"), "large-open-nodes")
        if nodes.isEmpty():
            break
        inside = large.join(nodes.where(F.col("n") <= NODE).select("node"), "node").select("node", "rep", "label")
        nodes = nodes.where(F.col("n") > NODE)
        if depth == DEEP:
            inside = inside.union(large.join(nodes.select("node"), "node").select("node", "rep", "label"))
        join.link(links_in_nodes(stored(inside, "nodes-to-compare"), join.docs, classes))
        if depth == DEEP or nodes.isEmpty():
            break
        large = large.join(nodes.select("node"), "node")
        reached.append(stored(large.select("rep").distinct().withColumn("depth", F.lit(depth + 1)), "branching-classes"))
        level = stored(_branched(large.join(classes.select("rep", "tokens"), "rep").select("node", "rep", "tokens"), first=False), "nodes")
    return reached


def class_components(docs: DataFrame, classes: DataFrame) -> DataFrame | None:
    """``id, label`` of the classes (``rep, n_shingles, tokens, s0 ..``) that have a link; None without any."""
    join = Join(docs, classes)
    # a level ahead, since among more roots some lead deeper; that saves rounds
    ahead = [roots_for(2), roots_for(2), *(roots_for(min(d + 1, DEEP)) for d in range(3, DEEP + 1))]
    needed = F.element_at(F.array(*(F.lit(n) for n in ahead)), F.col("depth"))
    level = classes.select("rep", "tokens", F.lit(0).cast("long").alias("lo"), F.lit(roots_for(2)).cast("long").alias("hi"))
    depths: DataFrame | None = None
    while True:
        reached = descend(join, stored(_branched(level, first=True), "nodes"))
        if not reached:
            return join.labels
        found = functools.reduce(DataFrame.union, reached).groupBy("rep").agg(F.max("depth").alias("depth"))
        old = F.lit(2) if depths is None else F.coalesce("_old", F.lit(2))
        if depths is not None:
            found = found.join(depths.withColumnRenamed("depth", "_old"), "rep", "full")
        depths = found.select("rep", F.greatest("depth", old).alias("depth"), old.alias("_old"))
        depths = stored(depths, "depths")
        more = depths.where("depth > _old").withColumn("hi", needed.cast("long"))
        more = more.select("rep", "hi", F.col("_old").alias("depth")).withColumn("lo", needed.cast("long")).drop("depth")
        depths = depths.drop("_old")
        more = stored(more.where("hi > lo"), "more-roots")
        if more.isEmpty():
            return join.labels
        level = more.join(classes.select("rep", "tokens"), "rep")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    sets = stored(document_sets(docs), "document-sets")
    reps = sets.where("set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    reps = stored(reps, "classes")
    first = reps.where("rep IS NOT NULL").select(F.col("set_key").alias("_key"), "rep")
    classes = sets.join(first, (sets["set_key"] == first["_key"]) & (sets["doc_id"] == first["rep"]))
    classes = classes.dropDuplicates(["rep"]).select("rep", "n_shingles", "tokens", *(f"s{j}" for j in range(SKETCH_WORDS)))
    labels = class_components(docs, stored(classes, "class-sets"))
    if labels is None:
        reps = reps.withColumn("label", F.col("rep"))
    else:
        known = labels.select(F.col("id").alias("rep"), "label")
        reps = stored(reps.join(known, "rep", "left").withColumn("label", F.coalesce("label", "rep")), "class-labels")
    rows = salted_left_join(sets.select("doc_id", "n_shingles", "set_key"), reps.select("set_key", "label"), ["set_key"], "doc_id")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """``docs`` without the near-duplicates of a kept document; exact repeats of a kept row go too."""
    found = stored(near_duplicates(docs), "near-duplicates")
    # documents to drop, and those with more rows than one
    special = found.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.min("kept").alias("_kept"), F.count(F.lit(1)).alias("_rows")
    )
    special = stored(special.where("NOT _kept OR _rows > 1"), "dropped")
    flagged = with_possible(docs, "doc_id", special, "_id", "_possible")
    plain = flagged.where("NOT _possible").drop("_possible")
    checked = flagged.where("_possible").drop("_possible").join(special, F.col("doc_id") == F.col("_id"), "left")
    checked = checked.where(F.coalesce("_kept", F.lit(True))).drop("_id", "_kept", "_rows")
    return plain.unionByName(checked.dropDuplicates(["doc_id", "text"]))


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
