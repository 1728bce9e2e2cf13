"""Exact set-similarity self-join on word n-grams, by prefix filter and prefix trees.

1. One pass counts words and n-grams in sketches and gives every set's size and digest. Sets
   equal by digest are one class.
2. All n-grams have one global order: those that the sketch finds heavy last, the others by how
   rare their words are, then by hash. Two sets that are similar enough share an n-gram among the
   first few (the prefix) of both. Sets of fitting sizes are tied through shared prefix n-grams: where
   few sets share one, every two of them, and two whose bits differ too much to link part again; else each to one
   before it. Components of these ties are the clusters within which links can lie. The sketches set
   the order only, so their errors cost time, not links.
3. Per cluster the same filter runs again, with exact counts; what it leaves together goes into a
   trie, common n-grams first, so that sets share partial overlaps. Each set walks the trie with its
   overlap so far, leaves out subtrees that cannot reach the overlap asked for by what is left of
   either side, and subtrees already connected to it.
4. Links connect classes; components of the links are the result.

Clusters over ``CLUSTER`` sets or ``CLUSTER_GRAMS`` n-grams are cut into bands of sizes, and bands that are still over it into
slices, every two of which meet in a task of their own: no cluster is capped or held whole. A hot n-gram is combined batch by batch before the
shuffle, so it is a few rows per task. Prefix n-grams are shuffled in packed runs, one per batch and range of hashes.

Defined results: NULL and empty texts, and texts without words, have the empty set and link
with nothing; under n words the whole sequence is the one member; repeated rows are copies; rows that share
an id but not the text are compared each by its text; a NULL id links with nothing and its component is NULL; an empty
table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import by_few_rows, written
from dugout.llm.components import components, forest, in_groups

WORD_SLOTS = 1 << 21
SLOTS = 1 << 23
CHUNK = 1 << 16
FOLD = 256
# What a group of sets may hold: sets, and n-grams in them.
CLUSTER = 3000
CLUSTER_GRAMS = 3 << 20
KEPT_WORDS = 50_000
# Prefix n-grams that a task holds before it ties their sets, and those of a range of hashes (up to twice as many).
TIED = 1 << 19
RANGED = 1 << 17
# Bits of an n-gram's hash that ties go by; two n-grams with the same ones cost a tie, no link.
TIE_BITS = 48
# As many sets with one n-gram are tied each with each, more in a row.
FEW = 32
# N-grams of a group that are sorted at once.
RANGE = 1 << 19
MARKS = 1 << 24
_MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


@dataclass(frozen=True)
class Join:
    """Words per n-gram, and the least similarity in percent."""

    words: int = 4
    percent: int = 85

    def prefix(self, size: int) -> int:
        return size - -(-self.percent * size // 100) + 1

    def index(self, size):
        """The part of the prefix that suffices for the smaller set of a pair, or either of equal ones."""
        return size - -(-2 * self.percent * size // (100 + self.percent)) + 1

    def fits(self, small, large):
        """Whether sets of these sizes, the smaller one first, can be similar enough."""
        return 100 * small >= self.percent * large

    def overlap(self, a: int, b: int) -> int:
        """Least common members for sets of these sizes."""
        return -(-self.percent * (a + b) // (100 + self.percent))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > KEPT_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_hashes = _Hashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the lower-cased words."""
    # On bytes, lower() changes A-Z only and split() cuts at exactly the white space asked for.
    words = text.encode().lower().split() if isinstance(text, str) else []
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n-gram of words, in order; one for all words if they are fewer."""
    take = min(n, len(h))
    grams = np.full(len(h) - take + 1, np.uint64(take))
    for k in range(take):
        grams = (grams ^ h[k : len(h) - take + 1 + k]) * _MIX[0]
        grams ^= grams >> np.uint64(29)
    grams = (grams ^ (grams >> np.uint64(30))) * _MIX[1]
    grams = (grams ^ (grams >> np.uint64(27))) * _MIX[2]
    return grams ^ (grams >> np.uint64(31))


def distinct(grams: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    grams = np.sort(grams)
    return grams[np.append(True, grams[1:] != grams[:-1])] if len(grams) else grams


def slot(hashes: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Places in a sketch."""
    return (hashes & np.uint64(slots - 1)).view(np.int64)


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of lower-cased words."""
    h = word_hashes(text)
    return distinct(windows(h, n)) if len(h) else np.zeros(0, np.uint64)


class Order:
    """The global order of n-grams: a class for each, ascending; hashes decide within a class."""

    def __init__(self, words: np.ndarray, grams: np.ndarray):
        self.rarity = (16 * np.log2(words + 1.0)).astype(np.int32)
        # What a slot holds by chance, four deviations wide; more is heavy, and each doubling heavier.
        usual = float(grams.sum()) / SLOTS
        usual += 4 * usual**0.5 + 2
        # By chunks, as the steps are in doubles.
        self.heavy = np.empty(len(grams), np.int8)
        for at in range(0, len(grams), CHUNK):
            part = np.maximum(grams[at : at + CHUNK], 1) / usual
            self.heavy[at : at + CHUNK] = np.maximum(np.floor(np.log2(part)) + 1, 0)

    def first(self, h: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
        """The set of these words' n-grams, and its prefix."""
        grams = windows(h, join.words)
        at = np.argsort(grams, kind="stable")
        grams = grams[at]
        once = np.append(True, grams[1:] != grams[:-1])
        grams, at = grams[once], at[once]
        rare = self.rarity[slot(h, WORD_SLOTS)]
        take = min(join.words, len(h))
        score = sum(rare[k : len(h) - take + 1 + k] for k in range(take))[at]
        score = score + (self.heavy[slot(grams)].astype(np.int32) << 16)
        # grams are in hash order, and a stable sort keeps it among equals.
        return grams, grams[np.argsort(score, kind="stable")[: join.prefix(len(grams))]]


def _sid(grams: np.ndarray) -> int:
    """A long for a set. Two sets with one sid would share a cluster, not a class."""
    return int(np.uint64(xxhash.xxh64_intdigest(grams.tobytes())).view(np.int64))


def parity(grams: np.ndarray) -> bytes:
    """A bit per slot of a set's n-grams, whether their number is odd; slots are a power of two, at least as many as n-grams.

    Bits in which two sets differ are never more than the n-grams that only one of them has.
    """
    slots = 1 << max(6, (len(grams) - 1).bit_length())
    return np.packbits((np.bincount(slot(grams, slots), minlength=slots) & 1).astype(np.uint8)).tobytes()


def may_link(a: bytes, n: int, b: bytes, m: int, join: Join) -> bool:
    """Whether sets of ``n`` and ``m`` n-grams with bits ``a`` and ``b`` can be similar enough."""
    small, large = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    while len(large) > len(small):
        large = large[: len(large) // 2] ^ large[len(large) // 2 :]
    return int(np.bitwise_count(small ^ large).sum()) <= n + m - 2 * join.overlap(n, m)


def _pack(counts: np.ndarray) -> bytes:
    """Counts compressed, a byte each if they are small."""
    return zlib.compress(counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    raw = zlib.decompress(packed)
    return np.frombuffer(raw, np.uint8 if len(raw) == CHUNK else np.uint32)


def _first(docs: DataFrame, join: Join) -> DataFrame:
    """Rows of documents (doc_id, n_shingles, digest, sid, bits) and, per task, the chunks of its sketches:
    words first, then n-grams."""
    names = ["doc_id", "n_shingles", "digest", "sid", "bits", "chunk", "task", "counts"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(WORD_SLOTS + SLOTS, np.uint32)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                h = word_hashes(text)
                grams = distinct(windows(h, join.words)) if len(h) else h
                np.add.at(counts[:WORD_SLOTS], slot(h, WORD_SLOTS), np.uint32(1))
                np.add.at(counts[WORD_SLOTS:], slot(grams), np.uint32(1))
                digest = hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None
                bits = parity(grams) if len(grams) else None
                rows.append((doc_id, len(grams), digest, _sid(grams), bits, None, None, None))
            yield pd.DataFrame(rows, columns=names)
        task = TaskContext.get().partitionId()
        for at in range(0, len(counts), CHUNK):
            part = counts[at : at + CHUNK]
            if part.any():
                yield pd.DataFrame([(None, None, None, None, None, at // CHUNK, task, _pack(part))], columns=names)

    # Ids travel as text: beside a NULL, pandas would make long ids floats.
    schema = "doc_id string, n_shingles long, digest binary, sid long, bits binary, chunk int, task int, counts binary"
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(run, schema)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _sketch(parts: DataFrame) -> np.ndarray:
    """The sketches over all tasks: chunks are added in two steps, one chunk and ``FOLD`` tasks at a time."""

    def work(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for (chunk, fold), own in frame.groupby(["chunk", "fold"]):
            total = np.zeros(CHUNK, np.uint64)
            for c in own["counts"]:
                total += _unpack(c)
            yield pd.DataFrame({"chunk": [chunk], "fold": [fold], "counts": [_pack(np.minimum(total, 2**32 - 1))]})

    schema = "chunk int, fold int, counts binary"
    folded = parts.select("chunk", F.floor(F.col("task") / FOLD).cast("int").alias("fold"), "counts")
    once = in_groups(folded, ["chunk", "fold"], work, schema)
    twice = in_groups(once.withColumn("fold", F.lit(0)), ["chunk", "fold"], work, schema)
    sketch = np.zeros(WORD_SLOTS + SLOTS, np.uint32)
    for row in twice.collect():
        sketch[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = _unpack(row["counts"])
    return sketch


def _runs(grams: np.ndarray, sizes: np.ndarray, index: np.ndarray, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """For rows of (n-gram, set size, whether the n-gram is in the set's ``index`` part): their order by n-gram
    and size, and for each row in it the place of the row it is tied to, or -1.

    Of two sets that may link, the smaller one has a shared n-gram in its index part. So a row is tied to the
    last index row of its n-gram before it, if that one's size fits, and all that may link are connected.
    Rows without a tie begin runs: an index row with those tied after it, or another row alone.
    """
    order = np.lexsort((sizes, grams))
    g, n = grams[order], sizes[order]
    last = np.maximum.accumulate(np.where(index[order], np.arange(len(g)), -1))
    last = np.append(-1, last)[: len(g)]
    tied = (last >= 0) & (g[last] == g) & join.fits(n[last], n)
    return order, np.where(tied, last, -1)


def _packed_runs(g: np.ndarray, low: np.ndarray, high: np.ndarray, s: np.ndarray) -> bytes:
    """Runs in order of their n-gram: steps between n-grams byte by byte, so that they compress well, sizes and set ids."""
    steps = np.diff(g, prepend=0).view(np.uint8).reshape(-1, 8).T
    raw = b"".join(x.tobytes() for x in (steps, low.astype(np.uint32).view(np.uint8).reshape(-1, 4).T, high.astype(np.uint32).view(np.uint8).reshape(-1, 4).T, s))
    return pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpacked_runs(packed: bytes, n: int) -> tuple[np.ndarray, ...]:
    raw = np.frombuffer(pa.Codec("zstd").decompress(packed, 24 * n, asbytes=True), np.uint8)
    g = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.int64).ravel()
    low, high = (np.ascontiguousarray(raw[at * n : (at + 4) * n].reshape(4, n).T).view(np.uint32).ravel().astype(np.int64) for at in (8, 12))
    return np.cumsum(g), low, high, raw[16 * n :].view(np.int64)


def _tied_runs(g: np.ndarray, low: np.ndarray, high: np.ndarray, many: np.ndarray, s: np.ndarray, join: Join) -> np.ndarray:
    """Rows (a, b, 1 if the tie is sure) for runs of n-grams: the least size, the largest one of index rows (0: none),
    whether it holds several sets, and a set.

    Of the runs of an n-gram in order of their lowest size, one may link with those before it whose index rows it fits.
    Up to ``FEW`` runs are tied each with each, surely if one holds several sets. Of more, one that fits is surely tied
    to the last run before it with index rows.
    """
    order = np.lexsort((s, high, low, g))
    same = g[order][1:] == g[order][:-1]
    order = order[np.append(same, False) | np.append(False, same)]
    g, low, high, many, s = g[order], low[order], high[order], many[order], s[order]
    at = np.arange(len(g))
    begins = np.append(True, g[1:] != g[:-1])[: len(g)]
    start = np.maximum.accumulate(np.where(begins, at, 0))
    few = np.bincount(start, minlength=len(g))[start] <= FEW
    found = []
    for d in range(1, FEW):
        later = np.flatnonzero(few & (at - start >= d))
        earlier = later - d
        fit = (high[earlier] > 0) & join.fits(high[earlier], low[later])
        earlier, later = earlier[fit], later[fit]
        found.append((s[earlier], s[later], many[earlier] | many[later]))
    # The largest size before it, made to start anew with each n-gram.
    shift = start << 32
    reach = np.append(0, np.maximum.accumulate(shift + high))[: len(g)] - shift
    before = np.append(-1, np.maximum.accumulate(np.where(high > 0, at, -1)))[: len(g)]
    later = np.flatnonzero(~few & (before >= start) & join.fits(reach, low))
    found.append((s[before[later]], s[later], np.ones(len(later), bool)))
    a, b, sure = (np.concatenate(x) for x in zip(*found, strict=True))
    ties = np.stack([np.minimum(a, b), np.maximum(a, b), sure.astype(np.int64)], axis=1)[a != b]
    return np.unique(ties, axis=0)


def _ties(docs: DataFrame, order, join: Join, n_grams: int) -> DataFrame:
    """Pairs (a, b) of set ids that share a prefix n-gram, enough of them to connect all that may link, and whether the
    tie is sure: of the others, only those that may link are needed.

    A task ties its own sets where more than ``FEW`` of them share an n-gram, ``TIED`` prefix n-grams at a time, and
    passes on one run for these and one for each other set: an n-gram, the least size and the largest one of index rows
    (0: none), and a set. Runs travel packed, by ranges of hashes; ``n_grams`` is about how many there are.
    """
    bits = max(0, (n_grams // RANGED).bit_length() - 1)

    def tied(found: list[tuple[np.ndarray, int, int]]) -> Iterator[pa.RecordBatch]:
        own = np.array([len(first) for first, _, _ in found])
        g = (np.concatenate([first for first, _, _ in found]) >> np.uint64(64 - TIE_BITS)).view(np.int64)
        s = np.repeat(np.array([sid for _, sid, _ in found], np.int64), own)
        n = np.repeat(np.array([size for _, _, size in found], np.int64), own)
        index = np.arange(len(g)) - np.repeat(np.cumsum(own) - own, own) < join.index(n)
        at, to = _runs(g, n, index, join)
        g, s, n, index = g[at], s[at], n[at], index[at]
        begins = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        times = np.diff(np.append(begins, len(g)))
        to = np.where(np.repeat(times, times) > FEW, to, -1)
        starts = np.flatnonzero(to < 0)
        high = np.maximum.reduceat(np.where(index, n, 0), starts)
        many = np.diff(np.append(starts, len(g))) > 1
        yield from ranges(g[starts], n[starts], 2 * high + many, s[starts])
        inside = np.flatnonzero(to >= 0)
        pairs = np.unique(np.stack([s[to[inside]], s[inside]], axis=1), axis=0)
        yield from rows((pairs[:, 0] ^ pairs[:, 1]) & ((1 << bits) - 1), pa.nulls(len(pairs), pa.int32()), pa.nulls(len(pairs), pa.binary()), pairs[:, 0], pairs[:, 1])

    def ranges(g, low, high, s) -> Iterator[pa.RecordBatch]:
        part = g >> (TIE_BITS - bits)
        cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(g)).tolist()
        spans = [slice(x, y) for x, y in zip(cuts, cuts[1:], strict=False)]
        none = pa.nulls(len(spans), pa.int64())
        yield from rows(part[cuts[:-1]], np.diff(cuts), [_packed_runs(g[x], low[x], high[x], s[x]) for x in spans], none, none)

    def rows(*columns) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
        batch = pa.RecordBatch.from_arrays(arrays, names=["part", "n", "runs", "a", "b"])
        for start in range(0, batch.num_rows, CHUNK):
            yield batch.slice(start, CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found, seen, held = order.value, [], set(), 0
        for batch in batches:
            for text in batch.column("text"):
                h = word_hashes(text.as_py())
                if not len(h):
                    continue
                own, first = known.first(h, join)
                sid = _sid(own)
                if sid not in seen:
                    seen.add(sid)
                    found.append((first, sid, len(own)))
                    held += len(first)
                if held >= TIED:
                    yield from tied(found)
                    found, seen, held = [], set(), 0
        if found:
            yield from tied(found)

    def ties(found: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(found), CHUNK):
            a, b, sure = found[start : start + CHUNK].T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure == 1)], names=["a", "b", "sure"])

    def meet(held: list[tuple[np.ndarray, ...]]) -> np.ndarray:
        g, low, high, s = (np.concatenate(x) for x in zip(*held, strict=True))
        return _tied_runs(g, low, high >> 1, (high & 1) == 1, s, join)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            made = batch.filter(pc.is_valid(batch.column("a")))
            a, b = (made.column(c).to_numpy() for c in ("a", "b"))
            yield from ties(np.stack([np.minimum(a, b), np.maximum(a, b), np.ones(len(a), np.int64)], axis=1))
            for part, n, runs in zip(*(batch.column(c) for c in ("part", "n", "runs")), strict=True):
                if part.as_py() != now:
                    if held:
                        yield from ties(meet(held))
                    now, held = part.as_py(), []
                if runs.is_valid:
                    held.append(_unpacked_runs(runs.as_py(), n.as_py()))
        if held:
            yield from ties(meet(held))

    found = docs.select("text").mapInArrow(run, "part int, n int, runs binary, a long, b long")
    by_part = found.repartition("part").sortWithinPartitions("part")
    return by_part.mapInArrow(met, "a long, b long, sure boolean").filter("a <> b").distinct()


def _kept(ties: DataFrame, sets: DataFrame, join: Join) -> DataFrame:
    """Pairs (a, b) of ``ties`` that are sure or whose ``sets`` (sid, size, bits) may link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(*(batch.column(c).to_pylist() for c in ("_bits_a", "_size_a", "_bits_b", "_size_b")), strict=True)
            yield batch.filter(pa.array([may_link(*x, join) for x in own], pa.bool_())).select(["a", "b"])

    sides = [sets.select(F.col("sid").alias(c), F.col("size").alias(f"_size_{c}"), F.col("bits").alias(f"_bits_{c}")) for c in ("a", "b")]
    asked = ties.filter("not sure").select("a", "b").join(sides[0], "a").join(sides[1], "b")
    return ties.filter("sure").select("a", "b").unionByName(asked.mapInArrow(run, "a long, b long"))


class _Node:
    __slots__ = ("label", "children", "sets", "low", "high", "one", "mixed")

    def __init__(self, label: np.ndarray, low: int, high: int, one: int):
        self.label, self.children, self.sets = label, {}, []
        self.low, self.high = low, high  # of the sets below: least size, most n-grams
        self.one, self.mixed = one, False  # a set below; whether others may not be connected to it


class Trie:
    """Sets of ranks (0 the most common), each ascending, on shared paths; finds links between them."""

    def __init__(self, join: Join, sizes: list[int], n_ranks: int):
        self.join, self.sizes = join, sizes
        self.parent = list(range(len(sizes)))
        self.root = _Node(np.zeros(0, np.int32), 1 << 60, 0, -1)
        self.inside = np.zeros(n_ranks, bool)

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def insert(self, x: int, ranks: np.ndarray) -> None:
        node, rest, size = self.root, ranks, self.sizes[x]
        while True:
            node.low, node.high = min(node.low, size), max(node.high, len(ranks))
            if node.one < 0:
                node.one = x
            elif not node.mixed and self.find(node.one) != self.find(x):
                node.mixed = True
            if not len(rest):
                node.sets.append(x)
                return
            child = node.children.get(int(rest[0]))
            if child is None:
                child = node.children[int(rest[0])] = _Node(rest, size, len(ranks), x)
                child.sets.append(x)
                return
            n = min(len(child.label), len(rest))
            differ = np.flatnonzero(child.label[:n] != rest[:n])
            common = int(differ[0]) if len(differ) else n
            if common < len(child.label):
                top = _Node(child.label[:common], child.low, child.high, child.one)
                top.mixed = child.mixed
                child.label = child.label[common:]
                top.children[int(child.label[0])] = child
                node.children[int(rest[0])] = child = top
            node, rest = child, rest[common:]

    def probe(self, x: int, ranks: np.ndarray) -> None:
        """Connects ``x`` to every set in the trie that is similar enough."""
        size = self.sizes[x]
        self.inside[ranks] = True
        stack = [(child, 0, 0) for child in self.root.children.values()]
        while stack:
            node, depth, overlap = stack.pop()
            if not node.mixed and self.find(node.one) == self.find(x):
                continue
            overlap += int(self.inside[node.label].sum())
            depth += len(node.label)
            left = len(ranks) - int(np.searchsorted(ranks, node.label[-1], side="right"))
            if overlap + min(left, node.high - depth) < self.join.overlap(size, node.low):
                continue
            for y in node.sets:
                if overlap >= self.join.overlap(size, self.sizes[y]):
                    self.union(x, y)
            stack += [(child, depth, overlap) for child in node.children.values()]
        self.inside[ranks] = False


def linked(sets: list[np.ndarray], join: Join) -> list[int]:
    """For each set the index of the first set it is connected with by links among ``sets``."""
    if not sets:
        return []
    sizes = np.array([len(s) for s in sets])
    tokens, counts = _numbered(sets)
    # Held no longer where the caller has handed over its list.
    del sets
    _shared(tokens, counts, sizes, join)
    # Places in each set by rising count, after the n-grams of that set only, which tie nothing.
    alone = sizes - np.array([len(own) for own in tokens])
    take = np.maximum(np.array([join.prefix(n) for n in sizes]) - alone, 0)
    first = [own[np.argsort(counts[own], kind="stable")[:n]] for own, n in zip(tokens, take, strict=True)]
    take = np.array([len(own) for own in first])
    owner = np.repeat(np.arange(len(sizes), dtype=np.int32), take)
    place = np.arange(len(owner)) + np.repeat(alone - (np.cumsum(take) - take), take)
    at, to = _runs(np.concatenate(first), sizes[owner], place < join.index(sizes[owner]), join)
    inside = np.flatnonzero(to >= 0)
    ties = np.stack([owner[at[to[inside]]], owner[at[inside]]], axis=1)
    cluster = forest(len(sizes), np.unique(ties, axis=0))
    del first, owner, place, at, to, inside, ties
    # Common n-grams first: neighbours in the trie then share long paths.
    rank = np.empty(len(counts), np.int32)
    rank[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.int32)
    out = np.arange(len(sizes))
    for members in _groups(cluster):
        if len(members) > 1:
            ranks = [rank[tokens[x]] for x in members]
            for k, first in enumerate(_join_by_trie(ranks, sizes[members].tolist(), join)):
                out[members[k]] = members[first]
    return out.tolist()


def _numbered(sets: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each of the sorted ``sets`` those n-grams that another one has too, ascending and numbered from 0
    over all sets, and how many sets have each number.

    N-grams are put in order by ranges of about ``RANGE``, so that little is held beside the sets and numbers.
    """
    # Ranges cut the longest set evenly; n-grams are hashes, so they cut the others about as evenly.
    n_ranges = 1 + sum(map(len, sets)) // RANGE
    longest = max(sets, key=len)
    cuts = longest[np.arange(1, n_ranges) * len(longest) // n_ranges]
    bounds = [np.concatenate([[0], np.searchsorted(s, cuts), [len(s)]]) for s in sets]
    parts: list[list[np.ndarray]] = [[] for _ in sets]
    counts, known = [], 0
    for k in range(n_ranges):
        own = [s[b[k] : b[k + 1]] for s, b in zip(sets, bounds, strict=True)]
        every = np.concatenate(own)
        grams, times = _repeated(every.copy())
        at = np.searchsorted(grams, every)
        hit = grams[np.minimum(at, len(grams) - 1)] == every if len(grams) else np.zeros(len(every), bool)
        ends = np.append(0, np.cumsum(hit, dtype=np.int32))[np.cumsum([len(part) for part in own])]
        for part, numbers in zip(parts, np.split((at[hit] + known).astype(np.int32), ends[:-1]), strict=True):
            part.append(numbers)
        counts.append(times)
        known += len(grams)
    return [np.concatenate(p) for p in parts], np.concatenate(counts)


def _repeated(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values that occur more than once, ascending, and how often. Sorts ``grams`` in place."""
    grams.sort()
    same = grams[1:] == grams[:-1]
    starts = np.flatnonzero(np.append(same, False) & ~np.append(False, same))
    ends = np.flatnonzero(np.append(False, same) & ~np.append(same, False))
    return grams[starts], (ends - starts + 1).astype(np.int32)


def _shared(tokens: list[np.ndarray], counts: np.ndarray, sizes: np.ndarray, join: Join) -> None:
    """Takes out n-grams that only one set has, and all of sets that have too few others to link with any.

    Each removal may leave other n-grams alone, so it goes on until nothing changes. What is left
    of a set bounds its overlaps; its size stays what it was.
    """
    # The least overlap a set needs: with the smallest set whose size fits.
    smallest = np.unique(sizes)
    first = smallest[np.searchsorted(100 * smallest, join.percent * sizes)]
    need = -(-join.percent * (sizes + first) // (100 + join.percent))
    changed = True
    while changed:
        changed = False
        for x, own in enumerate(tokens):
            left = own[counts[own] > 1]
            if len(left) < need[x]:
                left = np.zeros(0, np.int32)
            if len(left) < len(own):
                counts[own] -= 1
                counts[left] += 1
                tokens[x], changed = left, True


def _groups(labels: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(labels[order][1:] != labels[order][:-1]) + 1
    return np.split(order, cuts)


def _join_by_trie(sets: list[np.ndarray], sizes: list[int], join: Join) -> list[int]:
    """As ``linked``, for sets of ranks: every set meets those before it, smaller ones first.

    ``sizes`` counts the n-grams left out of ``sets`` too.
    """
    used = np.concatenate(sets)
    used.sort()
    used = used[np.append(True, used[1:] != used[:-1])]
    trie = Trie(join, sizes, len(used))
    for x in sorted(range(len(sets)), key=lambda i: sizes[i]):
        own = np.sort(np.searchsorted(used, sets[x]).astype(np.int32))
        trie.probe(x, own)
        trie.insert(x, own)
    return [trie.find(x) for x in range(len(sets))]


def _compressed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, _text, _size) of documents: the compressed text and its bytes before, both NULL for NULL.

    Texts meet their slices and groups by two shuffles; compressed one by one they are smaller there
    than in the blocks that Spark compresses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 3)
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            packed = [None if t is None else codec.compress(t, asbytes=True) for t in texts]
            sizes = [None if t is None else len(t) for t in texts]
            arrays = [batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "_text", "_size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, _text binary, _size long")


def _walk(join: Join):
    """Work on sorted rows (cluster, band, left, right, rep, sid, _text, _size): one edge per set linked to a smaller id.

    A text becomes a set as it comes, so a group costs its sets, which ``_sliced`` bounds, and no text.
    """

    def edges(sets: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
        own = sorted(sets)
        ids = [rep for rep, _ in own]
        # Handed over, so that the sets go as soon as they are numbered.
        found = [(ids[root], ids[x]) for x, root in enumerate(linked([sets.pop(k) for k in own], join)) if root != x]
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets, codec = None, {}, pa.Codec("zstd")
        for batch in batches:
            keys = [batch.column(i) for i in range(4)]
            for row in range(batch.num_rows):
                key = tuple(k[row].as_py() for k in keys)
                if key != now:
                    if len(sets) > 1:
                        yield edges(sets)
                    now, sets = key, {}
                one = batch.column(4)[row].as_py(), batch.column(5)[row].as_py()
                if one not in sets:
                    packed, size = batch.column(6)[row].as_py(), batch.column(7)[row].as_py()
                    text = None if packed is None else codec.decompress(packed, size, asbytes=True).decode()
                    grams = shingles(text, join.words)
                    # Of rows that share the id, those with the class's text.
                    if _sid(grams) == one[1]:
                        sets[one] = grams
        if len(sets) > 1:
            yield edges(sets)

    return run


def _likely(docs: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` whose id may be one of the ids ``rep`` in ``asked``, so that few other texts are shuffled, and the others.

    A bit per hashed id, ``MARKS`` of them: the broadcast table holds 2 MB at most, whatever the
    size of ``asked``. With very many ids asked for, all rows may be.
    """

    def mark(c) -> Column:
        return F.pmod(F.xxhash64(F.col(c).cast("long")), F.lit(MARKS))

    bits = asked.groupBy(F.bitmap_bucket_number(mark("rep")).alias("_jaccard_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(mark("rep"))).alias("_jaccard_bits")
    )
    at = F.bitmap_bit_position(mark("doc_id"))
    byte = F.conv(F.hex(F.substring("_jaccard_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.coalesce(F.floor(byte / F.pow(F.lit(2), at % 8)) % 2 == 1, F.lit(False))
    joined = docs.join(F.broadcast(bits), F.bitmap_bucket_number(mark("doc_id")) == F.col("_jaccard_bucket"), "left")
    likely, others = (joined.filter(rows).drop("_jaccard_bucket", "_jaccard_bits") for rows in (marked, ~marked))
    return likely, others


def _sliced(asked: DataFrame, join: Join) -> DataFrame:
    """Adds to sets (rep, size, cluster) their band, slice number and number of slices.

    A cluster over ``CLUSTER`` sets or ``CLUSTER_GRAMS`` n-grams is cut by size first: a band holds two neighbouring classes
    of sizes, and sets that may link are in one class or in two neighbouring ones, so every set
    is in two bands and every link within one; a band that adds no pair is left out. A band that is still too large is cut into slices.
    """
    # Groups as large as the tighter of both bounds allows, at least one.
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / CLUSTER), F.ceil(F.sum("size") / CLUSTER_GRAMS)).cast("int")
    small = asked.groupBy("cluster").agg((parts <= 1).alias("_small"))
    # Classes a little wider than the sizes that fit, so that rounding cannot part them.
    step = F.log(F.col("size")) / math.log(100 / (join.percent - 1))
    own = F.floor(step).cast("int")
    bands = F.when(F.col("_small"), F.array(F.lit(0))).otherwise(F.array(own - 1, own))
    banded = asked.join(small, "cluster").withColumns({"_class": own, "band": F.explode(bands)})
    stats = banded.groupBy("cluster", "band").agg(
        parts.alias("slices"), F.min("_class").alias("_low"), F.max("_class").alias("_high"), F.first("_small").alias("_small")
    )
    # A band of one class is left out where another band holds that class: the one above its class, which
    # every set has, or, if there are sets of the class below, the one it shares with those.
    below = F.lag(F.struct("band", "_low")).over(Window.partitionBy("cluster").orderBy("band"))
    shared = F.coalesce((F.col("_below.band") == F.col("band") - 1) & (F.col("_below._low") == F.col("band") - 1), F.lit(False))
    needed = F.col("_small") | (F.col("_low") < F.col("_high")) | ((F.col("_low") == F.col("band")) & ~shared)
    slices = stats.withColumn("_below", below).where(needed).select("cluster", "band", "slices")
    banded = banded.drop("_small", "_class")
    slot = F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int")
    return banded.join(slices, ["cluster", "band"]).withColumn("_slot", slot)


def similar_groups(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    Runs jobs at once; what is written between steps is in the shared folder. The driver sees
    counts and the sketch, which has a fixed size.
    """
    # All work in workers is in jobs that run here.
    with by_few_rows(docs.sparkSession):
        return _similar_groups(docs, join)


def _similar_groups(docs: DataFrame, join: Join) -> DataFrame:
    first = written(_first(docs, join), "grams")
    rows = first.filter("chunk is null").select("doc_id", "n_shingles", "digest", "sid", "bits")
    sketch = _sketch(first.filter("chunk is not null"))
    order = docs.sparkSession.sparkContext.broadcast(Order(sketch[:WORD_SLOTS], sketch[WORD_SLOTS:]))
    known = rows.filter("digest is not null and doc_id is not null").groupBy("digest")
    numbers = [F.min("doc_id").alias("rep"), F.min("sid").alias("sid"), F.min("n_shingles").alias("size")]
    classes = known.agg(*numbers)
    n_grams = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0] * (100 - join.percent) // 100
    ties = written(_ties(docs, order, join, n_grams), "ties")
    clusters = components(_kept(ties, known.agg(*numbers, F.first("bits").alias("bits")), join))
    asked = classes.join(clusters.select(F.col("node").alias("sid"), F.col("component").alias("cluster")), "sid")
    asked = written(asked.select("rep", "sid", "size", "cluster"), "clusters")
    sliced = _sliced(asked, join)
    # Who is asked for grows with the documents, so the join is a merge at every size. Texts
    # travel, not sets: they compress better than hashes.
    members = (
        _compressed(_likely(docs.select("doc_id", "text"), asked)[0])
        .join(sliced.hint("merge"), F.col("doc_id") == F.col("rep"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .withColumns({"left": F.least("_slot", "_with"), "right": F.greatest("_slot", "_with")})
        .select("cluster", "band", "left", "right", "rep", "sid", "_text", "_size")
    )
    of_group = ["cluster", "band", "left", "right"]
    sorted_in = members.repartition(*of_group).sortWithinPartitions(*of_group)
    nodes = components(sorted_in.mapInArrow(_walk(join), "a long, b long"))
    reached = (
        classes.join(nodes, F.col("rep") == F.col("node"), "left")
        .select(F.col("digest").alias("_d"), F.coalesce("component", "rep").alias("component_id"))
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(reached, F.col("digest") == F.col("_d"), "left").select(
        "doc_id", "n_shingles", own.alias("component_id")
    )


def keep_one(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; the columns stay.

    Repeated rows become one. Rows without an id stay, and so do rows without words, which are in
    no group. An id with several texts stays if any of them is not a copy.
    """
    groups = similar_groups(docs, join).filter("doc_id is not null").groupBy("doc_id")
    rows = groups.agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("_copy"), F.count(F.lit(1)).alias("_rows"))
    asked = written(rows.filter("_copy or _rows > 1").select(F.col("doc_id").alias("rep"), "_copy"), "copies")
    # Only rows of an id that is a copy or comes more than once are shuffled, and few others.
    likely, others = _likely(docs.filter("doc_id is not null"), asked)
    copies = asked.filter("_copy").select(F.col("rep").alias("_jaccard_gone"))
    stay = likely.join(copies, F.col("doc_id") == F.col("_jaccard_gone"), "left_anti")
    hashed = stay.withColumn("_jaccard_text", F.xxhash64("text"))
    single = hashed.dropDuplicates(["doc_id", "_jaccard_text"]).drop("_jaccard_text")
    return others.unionByName(single).unionByName(docs.filter("doc_id is null"))
