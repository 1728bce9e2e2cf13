"""Cross-tokenizer alignment: which tokens of two vocabularies share bytes, and how often over a corpus.

1. A text with a space before it is cut at every space that follows a character that is no white
   space. No token of either vocabulary crosses such a cut, so pieces are aligned one by one
   and equal pieces once per worker. Texts are aligned once: a written row keeps a text's sums, its digest
   and its distinct links, packed. From these come, per task, the pairs of linked ids and the
   number of documents that hold them, in buckets by hash.
2. The distinct pairs of a bucket, merged in a tree of bounded width, get a minimal perfect hash: levels
   of bit tables, a key going to the first level where it meets no other; its number is the rank of
   its bit. Counts become dense vectors indexed by it and are summed in a tree. A bucket is
   written with its bits, its keys in hash order, which verify a look-up, and its counts.
3. A second pass over the written links looks every pair up. While there are at most
   ``BROADCAST_PAIRS`` pairs, the tables travel to all workers; with more, the second pass gives a
   row for each distinct pair of a text, which Spark joins with the counts and sums up again. Both
   give the same rows.

Defined results: a text that is NULL, empty, or that either vocabulary does not give back byte
for byte has no tokens, links or groups; repeated rows count as documents of their own; an empty
table gives no rows; other columns play no part. A text without cuts is one piece, aligned whole.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import ROWS, PerText, written
from dugout.llm.token_counts import byte_names

BUCKETS = 256
FAN_IN = 16
BROADCAST_PAIRS = 2_000_000
# Bounds of what a worker keeps: pieces, bytes of their pairs, and pairs before a task hands its counts over.
KEPT_PIECES = 500_000
KEPT_BYTES = 64 << 20
KEPT_PAIRS = 1 << 20
# Pieces aligned in one call.
TOGETHER = 4096
_CUT = re.compile(r"(?<=\S) ")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of unsigned keys."""
    h = keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in zip((30, 27), _MIX, strict=True):
        h = (h ^ (h >> np.uint64(shift))) * factor
    return h ^ (h >> np.uint64(31))


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys, 0) & np.uint64(BUCKETS - 1)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash of the keys of some buckets: bit tables, one bucket and level after the other."""

    def __init__(self, tables: list[list[np.ndarray]]):
        """``tables`` holds for each bucket the words of its levels; a level's length gives its size."""
        depth = max(map(len, tables), default=0)
        self.start = np.zeros((depth, len(tables)), np.int64)
        self.size = np.zeros((depth, len(tables)), np.uint64)
        words, at = [], 0
        for b, levels in enumerate(tables):
            for k, bits in enumerate(levels):
                self.start[k, b], self.size[k, b] = at, 64 * len(bits)
                at += len(bits)
                words.append(bits)
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.rank = np.cumsum(ones) - ones

    @staticmethod
    def levels(keys: np.ndarray) -> list[np.ndarray]:
        """The bit tables of one bucket's distinct keys."""
        found = []
        while len(keys):
            size = -(-2 * len(keys) // 64) * 64
            at = (mixed(keys, len(found) + 1) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            found.append(np.packbits(alone, bitorder="little").view(np.uint64))
            keys = keys[~alone[at]]
        return found

    def find(self, keys: np.ndarray, buckets: np.ndarray) -> np.ndarray:
        """Numbers of the keys over all buckets, each in its bucket's range; -1 for some that are no keys."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for k in range(len(self.start)):
            size = self.size[k, buckets[left]]
            left, size = left[size > 0], size[size > 0]
            if not len(left):
                break
            at = mixed(keys[left], k + 1) % size
            word = self.start[k, buckets[left]] + (at >> np.uint64(6)).astype(np.int64)
            bit = at & np.uint64(63)
            held = (self.words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[held]] = (self.rank[word] + below)[held]
            left = left[~held]
        return out


@dataclass
class Pieces:
    """What some pieces give, one after the other: ``totals`` (tokens of A and B, groups, links), the
    ``pairs`` of their links, and their groups as text."""

    totals: np.ndarray
    pairs: np.ndarray
    texts: list[str]

    def __post_init__(self):
        self.starts = np.cumsum(self.totals[:, 3]) - self.totals[:, 3]

    @staticmethod
    def none() -> Pieces:
        return Pieces(np.zeros((0, 4), np.int64), np.zeros(0, np.uint64), [])

    def __len__(self) -> int:
        return len(self.totals)

    def take(self, which: np.ndarray) -> Pieces:
        return Pieces(self.totals[which], self.pairs[self.links_of(which)], [self.texts[i] for i in which.tolist()])

    def links_of(self, which: np.ndarray) -> np.ndarray:
        """Places in ``pairs`` of these pieces' links."""
        starts, n = self.starts[which], self.totals[which, 3]
        return np.repeat(starts - np.cumsum(n) + n, n) + np.arange(n.sum())


def aligned(a: np.ndarray, b: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray, ends: np.ndarray) -> Pieces | None:
    """The pieces of one text, which end at the bytes ``ends``; None if tokens cross such an end.

    ``a`` and ``b`` are the ids over the whole text, with their numbers of bytes.
    """
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    a_of, b_of = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
    if (a_ends[a_of] != ends).any() or (b_ends[b_of] != ends).any():
        return None
    # B tokens that overlap an A token are neighbours: from the first that ends after its start
    # to the first that ends at or after its end.
    last = np.searchsorted(b_ends, a_ends)
    shared = b_ends[last] == a_ends
    low = np.concatenate([[0], (last + shared)[:-1]])
    n = last - low + 1
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
    links = (np.repeat(a.astype(np.uint64), n) << np.uint64(32)) | b.astype(np.uint64)[at]
    stops = np.cumsum(shared)[a_of]
    totals = np.stack([np.diff(x, prepend=0) for x in (a_of + 1, b_of + 1, stops, np.cumsum(n)[a_of])], axis=1)
    groups = _spelt(a.tolist(), b.tolist(), np.flatnonzero(shared) + 1, last[shared] + 1)
    texts = [";".join(groups[x:y]) for x, y in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]
    return Pieces(totals, links, texts)


def _spelt(a: list[int], b: list[int], a_stops: np.ndarray, b_stops: np.ndarray) -> list[str]:
    """The groups that end before these places, as text."""
    names_a, names_b = list(map(str, a)), list(map(str, b))
    groups, i, j = [], 0, 0
    for x, y in zip(a_stops.tolist(), b_stops.tolist(), strict=True):
        left = names_a[i] if x == i + 1 else ",".join(names_a[i:x])
        groups.append(f"{left}|{names_b[j]}" if y == j + 1 else f"{left}|{','.join(names_b[j:y])}")
        i, j = x, y
    return groups


class _Bytes:
    """The bytes of all tokens of a vocabulary, to spell ids out at once."""

    def __init__(self, tokens: dict[int, bytes]):
        own = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.size = np.array(list(map(len, own)), np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(own), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        n = self.size[ids]
        return self.data[np.repeat(self.start[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())].tobytes()


class Aligner:
    """Aligns pieces of text by two vocabulary files, and keeps those it may meet again."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        with open(a_path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        named = byte_names()
        self.a_bytes = _Bytes({i: bytes(named[c] for c in t) for t, i in vocab.items() if all(c in named for c in t)})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        own = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            own[i] = bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("\u2581", " ").encode()
        self.b_bytes = _Bytes(own)
        self.space = self.b.piece_to_id("\u2581")
        self.known: dict[str, int] = {}
        self.pieces, self.met = Pieces.none(), np.zeros(0, np.int64)

    def _whole(self, text: str, a: list[int], b: list[int], ends: list[int]) -> Pieces | None:
        """Pieces of a text from its tokens; None if those do not give it back or cross an end."""
        data, a, b = text.encode(), np.array(a, np.int64), np.array(b, np.int64)
        if self.a_bytes.of(a) != data or self.b_bytes.of(b) != data:
            return None
        return aligned(a, b, self.a_bytes.size[a], self.b_bytes.size[b], np.array(ends))

    def _a_ids(self, text: str) -> list[int]:
        # The fast call leaves out the offsets of tokens.
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _together(self, pieces: list[str]) -> Pieces | None:
        text = " ".join(pieces)
        sizes = map(len, pieces) if text.isascii() else (len(p.encode()) for p in pieces)
        return self._whole(" " + text, self._a_ids(" " + text), self.b.encode(text), np.cumsum([n + 1 for n in sizes]))

    def _alone(self, piece: str) -> Pieces | None:
        # An empty piece is a space at the end of a text; alone it would get no token.
        b = self.b.encode(piece) if piece else [self.space]
        return self._whole(" " + piece, self._a_ids(" " + piece), b, [len(piece.encode()) + 1])

    def learn(self, pieces: list[str]) -> None:
        """Aligns pieces, given without their leading space; -1 is the number of those not given back whole.

        Pieces that end in a character that is no white space are put together again, so one call
        of each library serves many.
        """
        whole = [p for p in pieces if p and not p[-1].isspace() and "\u2581" not in p]
        alone = sorted(set(pieces).difference(whole)) if len(whole) < len(pieces) else []
        parts, n = [self.pieces], len(self.pieces)
        for at in range(0, len(whole), TOGETHER):
            some = whole[at : at + TOGETHER]
            found = self._together(some)
            if found is None:
                alone += some
            else:
                self.known.update(zip(some, range(n, n + len(some)), strict=True))
                parts.append(found)
                n += len(some)
        for piece in alone:
            found = self._alone(piece)
            self.known[piece] = -1 if found is None else n
            if found is not None:
                parts.append(found)
                n += 1
        texts = [t for part in parts for t in part.texts]
        self.pieces = Pieces(np.concatenate([x.totals for x in parts]), np.concatenate([x.pairs for x in parts]), texts)
        self.met = np.concatenate([self.met, np.zeros(n - len(self.met), np.int64)])

    def _forget(self) -> None:
        """Keeps the pieces met again and again, if those are not too many themselves."""
        keep = np.flatnonzero(self.met > 1)
        if len(keep) > KEPT_PIECES // 2 or 8 * self.pieces.totals[keep, 3].sum() > KEPT_BYTES // 2:
            keep = keep[:0]
        number = np.full(len(self.pieces) + 1, -2)
        number[keep] = np.arange(len(keep))
        new = number.tolist()
        self.known = {p: new[i] for p, i in self.known.items() if i >= 0 and new[i] >= 0}
        self.pieces, self.met = self.pieces.take(keep), self.met[keep] // 2

    def texts(self, texts: list[str | None]) -> list[np.ndarray]:
        """The numbers of the pieces of each text, in order; none for a text without tokens."""
        if len(self.known) > KEPT_PIECES or self.pieces.pairs.nbytes > KEPT_BYTES:
            self._forget()
        cut = [_CUT.split(t) if t else [] for t in texts]
        missing = set().union(*cut).difference(self.known)
        if missing:
            self.learn(sorted(missing))
        find, out = self.known.__getitem__, []
        for own in cut:
            found = np.fromiter(map(find, own), np.int64, len(own))
            if len(found) and found.min() < 0:
                found = found[:0]
            out.append(found)
        every = np.concatenate([np.zeros(0, np.int64), *out])
        self.met += np.bincount(every, minlength=len(self.met))
        return out

    def pairs_of(self, found: np.ndarray) -> np.ndarray:
        """All links of a text, in any order."""
        return self.pieces.pairs[self.pieces.links_of(found)]

    def totals(self, found: np.ndarray) -> tuple:
        """Sums over a text's pieces, and the digest of all groups."""
        if not len(found):
            return 0, 0, 0, 0, ""
        digest = hashlib.sha256(";".join(map(self.pieces.texts.__getitem__, found.tolist())).encode()).hexdigest()
        return *self.pieces.totals[found].sum(axis=0).tolist(), digest


@lru_cache(1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per worker process."""
    return Aligner(a_path, b_path)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.uint64)


def _packed(values: np.ndarray) -> bytes:
    return zlib.compress(values.astype(np.uint64).tobytes(), 1)


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of (keys, counts) and their sums."""
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    sums = np.zeros(len(keys), np.int64)
    np.add.at(sums, at, np.concatenate([c for _, c in parts]))
    return keys, sums


def _packed_links(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Distinct links and how often a text has each: byte by byte, so that the zeros stand together."""
    planes = (x.view(np.uint8).reshape(-1, x.itemsize).T.ravel() for x in (pairs, times.astype(np.uint32)))
    return len(pairs).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(np.concatenate([*planes]).tobytes(), asbytes=True)


def _links(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 12 * n, asbytes=True), np.uint8).reshape(12, n)
    pairs, times = (x.T.copy().reshape(-1) for x in (planes[:8], planes[8:]))
    return pairs.view(np.uint64), times.view(np.uint32).astype(np.int64)


TOTALS = ("n_a", "n_b", "n_groups", "n_links")


def _aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """A written row per row of ``docs``: doc_id, its totals, the digest of its groups, its ``links``."""

    def work(texts: list[str | None]) -> list[tuple]:
        machine, rows = aligner(a_path, b_path), []
        for own in machine.texts(texts):
            pairs, times = np.unique(machine.pairs_of(own), return_counts=True)
            rows.append((*machine.totals(own), _packed_links(pairs, times)))
        return rows

    results = {c: "long" for c in TOTALS} | {"groups_sha256": "string", "links": "binary"}
    return written(PerText(docs, ["doc_id"], "text", results, work).with_columns(), "links")


PARTIAL = "bucket int, slot int, pairs binary, counts binary"


def _partials(aligned: DataFrame) -> DataFrame:
    """Per task and bucket the distinct linked pairs and the number of its documents with each."""

    def rows(parts: list, task: int) -> pa.RecordBatch:
        keys, sums = _summed(parts)
        own = bucket_of(keys)
        order = np.argsort(own, kind="stable")
        held, starts = np.unique(own[order], return_index=True)
        cuts = [*starts.tolist(), len(keys)]
        return pa.RecordBatch.from_pydict(
            {
                "bucket": pa.array(held.tolist(), pa.int32()),
                "slot": pa.array([task] * len(held), pa.int32()),
                "pairs": pa.array([_packed(keys[order[i:j]]) for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                "counts": pa.array([_packed(sums[order[i:j]]) for i, j in zip(cuts, cuts[1:], strict=False)], pa.binary()),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, parts, held = TaskContext.get().partitionId(), [], 0
        for batch in _batches(batches):
            of_docs = np.concatenate([_links(x)[0] for x in batch.column("links").to_pylist()])
            parts.append(np.unique(of_docs, return_counts=True))
            held += len(parts[-1][0])
            if held > KEPT_PAIRS:
                parts = [_summed(parts)]
                held = len(parts[0][0])
                if held > KEPT_PAIRS // 2:
                    yield rows(parts, task)
                    parts, held = [], 0
        if parts:
            yield rows(parts, task)

    return aligned.select("links").mapInArrow(run, PARTIAL)


def _tree(rows: DataFrame, width: int, merge) -> DataFrame:
    """Merges the ``data`` of rows (bucket, slot, data) to one row a bucket, ``FAN_IN`` slots at a time.

    ``merge`` takes the value so far (None at first) and one ``data``. A task holds one value.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(key, value) -> pa.RecordBatch:
            names = {"bucket": pa.int32(), "slot": pa.int32(), "data": pa.binary()}
            arrays = [pa.array([v], t) for v, t in zip((*key, _packed(value)), names.values(), strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=list(names))

        now, value = None, None
        for batch in batches:
            for key, data in zip(zip(batch.column("bucket").to_pylist(), batch.column("slot").to_pylist(), strict=True), batch.column("data"), strict=True):
                if now is not None and key != now:
                    yield row(now, value)
                    value = None
                now, value = key, merge(value, _longs(data.as_py()))
        if now is not None:
            yield row(now, value)

    while True:
        rows = rows.withColumn("slot", F.floor(F.col("slot") / FAN_IN).cast("int"))
        rows = rows.repartition("bucket", "slot").sortWithinPartitions("bucket", "slot")
        rows = rows.mapInArrow(run, "bucket int, slot int, data binary")
        width = -(-width // FAN_IN)
        if width <= 1:
            return rows.select("bucket", "data")


def _functions(keys: DataFrame) -> DataFrame:
    """For rows of distinct keys per bucket: the bits of the bucket's perfect hash, and the keys in its order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data"), strict=True):
                own = _longs(data.as_py())
                levels = PerfectHash.levels(own)
                at = PerfectHash([levels]).find(own, np.zeros(len(own), np.int64))
                ordered = np.empty_like(own)
                ordered[at] = own
                out.append({"bucket": bucket, "n": len(own), "bits": [b.tobytes() for b in levels], "keys": _packed(ordered)})
            schema = [("bucket", pa.int32()), ("n", pa.int64()), ("bits", pa.list_(pa.binary())), ("keys", pa.binary())]
            yield pa.RecordBatch.from_pylist(out, pa.schema(schema))

    return keys.mapInArrow(run, "bucket int, n long, bits array<binary>, keys binary")


def _dense(partials: DataFrame, functions: DataFrame) -> DataFrame:
    """Every partial row's counts as a vector indexed by its bucket's perfect hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                at = {n: batch.column(n)[row].as_py() for n in ("bucket", "slot", "pairs", "counts", "n")}
                if held != at["bucket"]:
                    held = at["bucket"]
                    table = PerfectHash([[np.frombuffer(b, np.uint64) for b in batch.column("bits")[row].as_py()]])
                pairs = _longs(at["pairs"])
                vector = np.zeros(at["n"], np.uint64)
                vector[table.find(pairs, np.zeros(len(pairs), np.int64))] = _longs(at["counts"])
                own = [pa.array([held], pa.int32()), pa.array([at["slot"]], pa.int32()), pa.array([_packed(vector)], pa.binary())]
                yield pa.RecordBatch.from_arrays(own, names=["bucket", "slot", "data"])

    bits = functions.select(F.col("bucket").alias("_b"), "n", "bits")
    joined = partials.join(bits, F.col("bucket") == F.col("_b")).select("bucket", "slot", "pairs", "counts", "n", "bits")
    return joined.mapInArrow(run, "bucket int, slot int, data binary")


def counted(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The written table of all linked pairs, a row for each bucket: bucket, n, bits, keys, counts.

    Runs jobs at once; the driver sees the number of tasks.
    """
    return _counted(_aligned(docs, a_path, b_path))


def _counted(aligned: DataFrame) -> DataFrame:
    partials = written(_partials(aligned), "pairs")
    width = (partials.agg(F.max("slot")).first()[0] or 0) + 1

    def union(value, keys):
        return keys if value is None else np.union1d(value, keys)

    def add(value, vector):
        return vector if value is None else value + vector

    keys = _tree(partials.select("bucket", "slot", F.col("pairs").alias("data")), width, union)
    functions = written(_functions(keys), "hashes")
    sums = _tree(_dense(partials, functions), width, add)
    sums = sums.select(F.col("bucket").alias("_b"), F.col("data").alias("counts"))
    return written(functions.join(sums, F.col("bucket") == F.col("_b")).drop("_b"), "counts")


def pair_counts(table: DataFrame) -> DataFrame:
    """(a, b, n_docs) of every linked pair of ids, from the table of ``counted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                pairs = _longs(keys.as_py())
                arrays = (pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF), _longs(counts.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], names=["a", "b", "n_docs"])

    return table.select("keys", "counts").mapInArrow(run, "a long, b long, n_docs long")


class Counts:
    """The counts of all pairs, looked up by the perfect hash and verified by the keys."""

    def __init__(self, rows: list):
        # Buckets without pairs have no table.
        held = {r["bucket"]: r for r in rows}
        bits = [[np.frombuffer(b, np.uint64) for b in held[k]["bits"]] if k in held else [] for k in range(BUCKETS)]
        self.hash = PerfectHash(bits)
        none = np.zeros(0, np.uint64)
        self.keys = np.concatenate([none, *(_longs(held[k]["keys"]) for k in sorted(held))])
        self.counts = np.concatenate([none, *(_longs(held[k]["counts"]) for k in sorted(held))]).astype(np.int64)
        ids = (self.keys >> np.uint64(32)).astype(np.int64)
        self.best = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
        np.maximum.at(self.best, ids, self.counts)

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The counts of pairs, 0 for one that is not in the table."""
        if not len(self.keys):
            return np.zeros(len(pairs), np.int64)
        at = self.hash.find(pairs, bucket_of(pairs))
        return np.where((at >= 0) & (self.keys[at] == pairs), self.counts[at], 0)

    def scores(self, texts: list[bytes]) -> list[tuple[int, int]]:
        """For the packed links of each text (links whose count is the highest of their A id, sum of counts)."""
        found = list(map(_links, texts))
        pairs = np.concatenate([p for p, _ in found])
        counts = self.of(pairs)
        if not counts.all():
            raise LookupError("a pair of a text is not in the table of counts")
        best = counts == self.best[(pairs >> np.uint64(32)).astype(np.int64)]
        ends = np.cumsum([len(p) for p, _ in found])
        times = np.concatenate([t for _, t in found])
        # Sums up to each text's end, so that texts without links are like any other.
        sums = [np.diff(np.append(0, np.cumsum(x * times))[np.append(0, ends)]) for x in (best, counts)]
        return list(zip(*(x.tolist() for x in sums), strict=True))


def groups(docs: DataFrame, a_path: str, b_path: str, columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``columns`` of ``docs`` with ``groups``, the aligned ids of the text as `a1,a2|b1;a3|b2,b3`."""

    def work(texts: list[str | None]) -> list[tuple]:
        machine = aligner(a_path, b_path)
        found = machine.texts(texts)
        return [(";".join([machine.pieces.texts[i] for i in own.tolist()]),) for own in found]

    return PerText(docs, columns, "text", {"groups": "string"}, work).with_columns()


def align(docs: DataFrame, a_path: str, b_path: str, limit: int = BROADCAST_PAIRS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Runs jobs at once. The driver gathers the counts of at most ``limit`` pairs to send them to the
    workers; beyond it, counts meet the documents by a join.
    """
    aligned = _aligned(docs, a_path, b_path)
    table = _counted(aligned)
    n = table.agg(F.sum("n")).first()[0] or 0
    names = ["doc_id", *TOTALS, "n_best", "count_sum", "groups_sha256"]
    if n > limit:
        return _scored_by_join(aligned, pair_counts(table)).select(names)
    sent = docs.sparkSession.sparkContext.broadcast(Counts(table.collect()))
    results = {"n_best": "long", "count_sum": "long"}
    own = ["doc_id", *TOTALS, "groups_sha256"]
    return PerText(aligned, own, "links", results, lambda texts: sent.value.scores(texts)).with_columns().select(names)


def _scored_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """``aligned`` with its scores, a row for each distinct pair of a text meeting its count by a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            found = list(map(_links, batch.column("links").to_pylist()))
            at = pa.array(np.repeat(np.arange(len(found)), [len(p) for p, _ in found]))
            keys = [batch.column(c).take(at) for c in ("doc_id", "_text")]
            pairs = pa.array(np.concatenate([p for p, _ in found]).view(np.int64))
            times = pa.array(np.concatenate([t for _, t in found]))
            yield pa.RecordBatch.from_arrays([*keys, pairs, times], names=["doc_id", "_text", "_pair", "_times"])

    rows = aligned.withColumn("_text", F.unhex(F.md5("links")))
    of_doc = ["doc_id", "_text", *TOTALS, "groups_sha256"]
    # Rows with equal links were told apart by nothing else: they are counted, and come apart at the end.
    heads = rows.groupBy(*of_doc).agg(F.count(F.lit(1)).alias("_rows"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    each = rows.select("doc_id", "_text", "links").mapInArrow(run, f"doc_id {kind}, _text binary, _pair long, _times long")
    links = each.groupBy("doc_id", "_text", "_pair").agg(F.max("_times").alias("_times"))
    of_a = counts.groupBy(F.col("a").alias("_a")).agg(F.max("n_docs").alias("_best"))
    known = counts.join(of_a, F.col("a") == F.col("_a"))
    known = known.select((F.shiftleft("a", 32) + F.col("b")).alias("_key"), "n_docs", (F.col("n_docs") == F.col("_best")).alias("_top"))
    scored = links.join(known, F.col("_pair") == F.col("_key"))
    sums = scored.groupBy(F.col("doc_id").alias("_d"), F.col("_text").alias("_t")).agg(
        F.sum(F.when(F.col("_top"), F.col("_times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("_times") * F.col("n_docs")).alias("count_sum"),
    )
    whole = heads.join(sums, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("_text").eqNullSafe(F.col("_t")), "left")
    whole = whole.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows").cast("int"))))
    return whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
