"""Best-fit packing of tokenised documents into sequences, by linear grouping.

Only the number of pieces per length decides how full sequences can get, and there are at most
``capacity`` lengths. So the plan is made from that histogram, in time and memory that do
not depend on the number of documents, and Spark then puts every piece in its place:

1. Large pieces, in order of length, are cut into groups of equal count; in a group each
   length is rounded up to the largest.
2. With these few sizes, configurations (how many pieces of each size share a sequence) are
   chosen one by one by how much of a sequence they fill, and used as often as pieces last.
3. Actual pieces take the places of the rounded ones. Sequences with equal contents are one
   entry of the plan, with how many there are.
4. Small pieces, longest first, go where they leave the least room; new sequences are opened only
   when none has room.

A piece finds its place by its number within its length: its rank in a block of the length's
pieces and the pieces in the blocks before, so no length and no sequence is worked on in one task.

Defined results: a NULL text is an empty one, which is one token (the end mark) long; repeated
rows are packed each; an empty table gives an empty table; other columns are dropped.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import ROWS, by_few_rows, written
from dugout.llm.token_counts import byte_names

GROUPS = 1024
SMALL = 3  # a piece is small if that many fit into one sequence
BLOCKS = 256
COUNTS = 4096  # of so many parts of all pieces, a block has about one
KEPT_WORDS = 300_000
# Letters and then marks, both maybe missing. An apostrophe or an angle bracket may start more.
SIMPLE = re.compile(r"([^\W\d_]*)([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{|}~]+)")
LATIN_END = "\u0250"


class _Ids(dict):
    """Token ids of words between white space, as bytes; two generations of words are kept.

    The tokenizer drops white space and never joins anything across it, so the ids of a text
    are those of its words. Words of Latin letters, with marks after them or not, are one or two
    pieces of its split pattern and go straight to its model; others go through all of it.
    """

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.old: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.names = {b: c for c, b in byte_names().items()}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self._word(word.decode())
        if len(self) >= KEPT_WORDS:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            ids = self._letters(word)
        elif (parts := SIMPLE.fullmatch(word)) and (not parts[1] or parts[1].isalpha()):
            ids = self._letters(parts[1]) if parts[1] else b""
            ids = None if ids is None else ids + self._piece(parts[2])
        else:
            ids = None
        return self._bytes(self.tokenizer.encode(word, add_special_tokens=False).ids) if ids is None else ids

    def _letters(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters, which are in normal form; None for others."""
        low = word.lower()
        return self._piece(low) if max(word) < LATIN_END and low.isalpha() else None

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if len(self.pieces) >= KEPT_WORDS:
                self.pieces.clear()
            spelled = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.names)
            ids = self.pieces[piece] = self._bytes([t.id for t in self.model.tokenize(spelled)])
        return ids

    @staticmethod
    def _bytes(ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}I", *ids)

    def text(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, text.encode().split()))


@lru_cache(1)
def _ids(path: str) -> _Ids:
    return _Ids(path)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, vocabulary: str, capacity: int, with_ids: bool = False) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: doc_id, piece, start, length, ids_crc32.

    A document is its ids and the end mark 0. ``with_ids`` adds the ids themselves.
    """

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())][: 5 + with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _ids(vocabulary)
        step = 4 * capacity
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                rows = []
                for doc_id, text in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text")), strict=True):
                    ids = (b"" if text is None else words.text(text)) + b"\0\0\0\0"
                    for k, at in enumerate(range(0, len(ids), step)):
                        own = ids[at : at + step]
                        row = (doc_id, k, k * capacity, len(own) // 4, zlib.crc32(own))
                        rows.append((*row, np.frombuffer(own, "<u4").tolist()) if with_ids else row)
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES + ", ids array<long>" * with_ids)


@dataclass
class _Run:
    """``count`` sequences with equal contents; ``inside``: (length, how often, first number)."""

    count: int
    room: int
    inside: list[tuple[int, int, int]] = field(default_factory=list)


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Configurations over few sizes and how often each is used, largest size first.

    For the largest size left, the fullest combination with it is found by dynamic programming
    over the room (bounded by what is left of each size), and used as often as it can be.
    """
    left, out = list(counts), []
    for top in sorted(range(len(sizes)), key=lambda g: -sizes[g]):
        while left[top]:
            room = capacity - sizes[top]
            # reach[r]: the last size on a way to fill r exactly, with few pieces.
            reach: dict[int, dict[int, int]] = {0: {}}
            for g in sorted(range(len(sizes)), key=lambda g: -sizes[g]):
                spare = left[g] - (g == top)
                if not spare or sizes[g] > room:
                    continue
                for r, used in sorted(reach.items(), reverse=True):
                    for k in range(1, min(spare, (room - r) // sizes[g]) + 1):
                        reach.setdefault(r + k * sizes[g], used | {g: k})
            used = dict(reach[max(reach)])
            used[top] = used.get(top, 0) + 1
            times = min(left[g] // k for g, k in used.items())
            for g, k in used.items():
                left[g] -= k * times
            out.append((used, times))
    return out


class _Pool:
    """Pieces of one group in order of length, taken as stretches of equal length."""

    def __init__(self, lengths: list[tuple[int, int, int]]):
        self.stretches = [list(x) for x in lengths]  # length, count, first number
        self.at = 0

    def take(self, n: int) -> list[tuple[int, int, int]]:
        out = []
        while n:
            length, count, first = s = self.stretches[self.at]
            part = min(n, count)
            out.append((length, part, first))
            s[1] -= part
            s[2] += part
            n -= part
            self.at += not s[1]
        return out


def _substitute(used: dict[int, int], times: int, pools: list[_Pool], capacity: int) -> list[_Run]:
    """Runs of ``times`` sequences of one configuration, filled with actual pieces."""
    slots = [pools[g].take(times) for g, k in sorted(used.items()) for _ in range(k)]
    runs, done = [], 0
    ends = sorted({end for slot in slots for end in np.cumsum([s[1] for s in slot]).tolist()})
    at = [(0, 0)] * len(slots)  # stretch and how much of it is used, per slot
    for end in ends:
        n, inside = end - done, []
        for i, slot in enumerate(slots):
            k, gone = at[i]
            length, count, first = slot[k]
            inside.append((length, 1, first + gone))
            at[i] = (k, gone + n) if gone + n < count else (k + 1, 0)
        runs.append(_Run(n, capacity - sum(x[0] for x in inside), inside))
        done = end
    return runs


def plan(histogram: dict[int, int], capacity: int, groups: int = GROUPS) -> list[_Run]:
    """Runs that hold every piece of the histogram; see the module docstring."""
    large = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if n * SMALL > capacity]
    small = [(n, histogram[n]) for n in sorted(histogram, reverse=True) if n * SMALL <= capacity]
    total = sum(c for _, c in large)
    size = -(-total // groups) if total else 1
    grouped: list[list[tuple[int, int, int]]] = []
    space = 0
    for length, count in large:
        first = 0
        while first < count:
            if not space:
                grouped.append([])
                space = size
            part = min(space, count - first)
            grouped[-1].append((length, part, first))
            first += part
            space -= part
    sizes = [g[0][0] for g in grouped]
    pools = [_Pool(g) for g in grouped]
    counts = [sum(x[1] for x in g) for g in grouped]
    runs: list[_Run] = []
    for used, times in _configurations(sizes, counts, capacity):
        runs += _substitute(used, times, pools, capacity)

    by_room: dict[int, list[_Run]] = {}
    rooms: list[int] = []

    def put(run: _Run) -> None:
        if run.room not in by_room:
            bisect.insort(rooms, run.room)
        by_room.setdefault(run.room, []).append(run)

    for run in runs:
        put(run)
    for length, count in small:
        first = 0
        while first < count:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                each = capacity // length
                whole, rest = divmod(count - first, each)
                if whole:
                    put(_Run(whole, capacity - each * length, [(length, each, first)]))
                if rest:
                    put(_Run(1, capacity - rest * length, [(length, rest, first + whole * each)]))
                break
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
            # As many in each sequence as fit, as long as there are pieces for all.
            each = max(1, min(room // length, (count - first) // run.count))
            filled = min(run.count, count - first)
            if filled < run.count:
                rest = [(n, k, f + filled * k) for n, k, f in run.inside]
                put(_Run(run.count - filled, room, rest))
            put(_Run(filled, room - each * length, [*run.inside, (length, each, first)]))
            first += filled * each
    return [run for held in by_room.values() for run in held]


def places(runs: list[_Run]) -> pd.DataFrame:
    """The plan as rows: pieces of ``length`` numbered from ``first`` on, ``each`` to a sequence."""
    rows, sequence = [], 0
    for run in runs:
        offset = 0
        for length, each, first in run.inside:
            rows.append((length, first, first + each * run.count, each, sequence, offset))
            offset += length * each
        sequence += run.count
    table = pd.DataFrame(rows, columns=["length", "first", "end", "each", "sequence", "offset"])
    return table.sort_values(["length", "first"], ignore_index=True)


def _blocks(histogram: dict[int, int]) -> pa.Table:
    """Lengths whose pieces go to more than one block, fewer than ``COUNTS``, and how many blocks."""
    total = sum(histogram.values())
    many = {n: min(BLOCKS, -(-count * COUNTS // total)) for n, count in histogram.items() if count * COUNTS > total}
    return pa.table({"_of": pa.array(many.keys(), pa.int64()), "_blocks": pa.array(many.values(), pa.int64())})


def _starts(counts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """From counts per length and block: a sorted key of both, and how many pieces of the length are
    in blocks before."""
    length, block, n = (counts.column(c).to_numpy() for c in ("length", "_block", "count"))
    order = np.lexsort((block, length))
    length, block, n = length[order], block[order], n[order]
    _, at, of = np.unique(length, return_index=True, return_inverse=True)
    before = np.cumsum(n) - n
    return length * BLOCKS + block, before - before[at][of]


def place(cut: DataFrame, capacity: int, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length, ids_crc32 and any others).

    Runs three jobs at once: pieces are written to the shared folder, then counted per length, then
    per length and block. Only these counts, at most ``capacity`` plus ``COUNTS``, reach the driver;
    they and the plan, bounded by them, go back. Pieces are then shuffled and sorted once.
    """
    spark = cut.sparkSession
    with by_few_rows(spark):
        cut = written(cut, "pieces")
    histogram = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    # A block is a stretch of a length's buckets, so numbers do not depend on the blocks.
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BLOCKS))
    of = F.broadcast(spark.createDataFrame(_blocks(histogram)))
    held = (
        cut.join(of, F.col("length") == F.col("_of"), "left")
        .withColumn("_bucket", bucket)
        .withColumn("_block", F.floor(F.col("_bucket") * F.coalesce("_blocks", F.lit(1)) / BLOCKS))
        .drop("_of", "_blocks")
    )
    starts, before = _starts(held.groupBy("length", "_block").count().toArrow())
    table = spark.sparkContext.broadcast((starts, before, places(plan(histogram, capacity, groups))))
    # Numbers of a length are apart from those of others, so one sorted list serves all.
    wide = max(histogram.values(), default=0) + 1
    own = Window.partitionBy("length", "_block").orderBy("_bucket", "doc_id", "piece", "ids_crc32")
    ranked = held.withColumn("_in", F.row_number().over(own) - 1)

    columns = cut.columns

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, before, planned = table.value
        t = {c: planned[c].to_numpy() for c in planned.columns}
        keys = t["length"] * wide + t["first"]
        for batch in batches:
            length, block, inside = (batch.column(c).to_numpy() for c in ("length", "_block", "_in"))
            number = before[np.searchsorted(starts, length * BLOCKS + block)] + inside
            at = np.searchsorted(keys, length * wide + number, side="right") - 1
            gone, each = number - t["first"][at], t["each"][at]
            found = (t["sequence"][at] + gone // each, t["offset"][at] + gone % each * t["length"][at])
            arrays = [*(batch.column(c) for c in columns), *(pa.array(x, pa.int64()) for x in found)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "sequence_id", "offset"])

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(find, f"{kept}, sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, with_ids: bool = False) -> DataFrame:
    """Packs documents into sequences of ``capacity`` tokens; one row per piece."""
    return place(pieces(docs, vocabulary, capacity, with_ids), capacity)
