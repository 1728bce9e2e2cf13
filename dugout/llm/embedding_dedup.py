"""Near-duplicate vectors: sign hashing in several tables, exact cosines, components.

Random hyperplanes turn a vector into one code per table; vectors that share a code in some
table are compared exactly, in double precision. Bits per table follow the number of vectors
(buckets stay small), tables follow the bits and the recall asked for: a pair at the limit
is found with probability ``recall``, closer pairs with more. Equal vectors are one class from
the start. A pair that meets in several tables counts in the first only. Buckets over
``BUCKET`` vectors are cut into slices and every two slices meet in a task of their own, so no
bucket is capped and none is held whole.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite numbers link with nothing, nor do
vectors of different lengths; repeated rows are copies of one another; an empty table gives no
rows; labels and other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import written
from dugout.llm.components import components, forest, in_groups

BUCKET = 2000
FEW = 24  # buckets up to this size are compared by shifts, larger ones by matrix products


@dataclass(frozen=True)
class Tables:
    bits: int
    tables: int
    seed: int = 11


def tables_for(n: int, limit: float, recall: float) -> Tables:
    """Bits so that random buckets hold about one vector; tables so that the recall is met."""
    bits = min(max(math.ceil(math.log2(max(n, 2))), 6), 30)
    together = (1 - math.acos(limit) / math.pi) ** bits
    return Tables(bits, math.ceil(math.log(1 - recall) / math.log(1 - together)))


def planes(width: int, t: Tables) -> np.ndarray:
    return np.random.default_rng([t.seed, width]).standard_normal((width, t.bits * t.tables))


def codes(x: np.ndarray, t: Tables) -> np.ndarray:
    signs = (x @ planes(x.shape[1], t) > 0).reshape(len(x), t.tables, t.bits)
    return (signs @ (1 << np.arange(t.bits))).astype("<i4")


def _usable(values) -> np.ndarray | None:
    if values is None:
        return None
    x = np.array([np.nan if v is None else v for v in values] if isinstance(values, list) else values, float)
    return x if x.size and np.isfinite(x).all() and x.any() else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Ids pass through as Arrow: beside a NULL, pandas would make long ids floats.
    for batch in batches:
        found = [_usable(v) for v in batch.column("embedding").to_pylist()]
        data = [None if x is None else (x + 0.0).tobytes() for x in found]
        digests = [None if d is None else hashlib.blake2b(d, digest_size=16).digest() for d in data]
        arrays = [batch.column("vec_id"), pa.array(digests, pa.binary()), pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "digest", "vector"])


def _pairs(size: int, start: int) -> np.ndarray:
    a, b = np.triu_indices(size, 1)
    return np.stack([a, b], axis=1) + start


def _compare(limit: float):
    """Work on whole (table, code, left, right) groups: links and one edge per linked vector."""

    def work(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
        keys = frame[["tab", "code", "left", "right"]].to_numpy()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        bounds = np.concatenate([[0], cuts, [len(frame)]])
        sizes = np.diff(bounds)
        tab, slot = frame["tab"].to_numpy(), frame["slot"].to_numpy()
        left, right = keys[:, 2], keys[:, 3]
        width = np.array([len(v) for v in frame["vector"]])
        n = frame["n"].to_numpy()
        links = np.zeros(len(frame), np.int64)
        edges: list[np.ndarray] = []
        all_codes = np.stack([np.frombuffer(c, "<i4") for c in frame["codes"]])
        table_of = np.arange(all_codes.shape[1])

        def settle(pairs: np.ndarray, cosine: np.ndarray) -> None:
            pairs = pairs[cosine >= limit]
            a, b = pairs[:, 0], pairs[:, 1]
            # Two slices meet in their own task; within a slice only where it meets itself.
            fit = (left[a] == right[a]) | (slot[a] != slot[b])
            met = ((all_codes[a] == all_codes[b]) & (table_of < tab[a][:, None])).any(axis=1)
            pairs = pairs[fit & ~met]
            np.add.at(links, pairs[:, 0], n[pairs[:, 1]])
            np.add.at(links, pairs[:, 1], n[pairs[:, 0]])
            edges.append(pairs)

        for w in np.unique(width):
            rows = np.flatnonzero(width == w)
            x = np.stack([np.frombuffer(frame["vector"].iat[i], np.float64) for i in rows])
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            unit = np.zeros((len(frame), w // 8))
            unit[rows] = x
            group = np.repeat(np.arange(len(sizes)), sizes)
            small = (sizes[group] <= FEW) & (width == w)
            for step in range(1, FEW):
                a = np.flatnonzero(small[:-step] & small[step:] & (group[:-step] == group[step:])) if len(frame) > step else []
                if not len(a):
                    break
                settle(np.stack([a, a + step], axis=1), np.einsum("ij,ij->i", unit[a], unit[a + step]))
            for g in np.flatnonzero(sizes > FEW):
                own = np.arange(bounds[g], bounds[g + 1])
                own = own[width[own] == w]
                for at in range(0, len(own), 512):
                    some = own[at : at + 512]
                    near = unit[some] @ unit[own].T
                    i, j = np.nonzero(near >= limit - 1e-9)
                    keep = some[i] < own[j]
                    pairs = np.stack([some[i[keep]], own[j[keep]]], axis=1)
                    # The product's last bits depend on its blocks; the decision does not.
                    settle(pairs, np.einsum("ij,ij->i", unit[pairs[:, 0]], unit[pairs[:, 1]]))
        root = forest(len(frame), np.concatenate(edges) if edges else np.zeros((0, 2), int))
        ids = frame["rep"].to_numpy()
        smallest = np.full(len(frame), np.iinfo(np.int64).max)
        np.minimum.at(smallest, root, ids)
        linked = np.flatnonzero(links)
        yield pd.DataFrame({"rep": ids[linked], "links": links[linked], "to": smallest[root[linked]]})

    return work


def near_duplicates(vectors: DataFrame, limit: float = 0.95, recall: float = 0.999) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding): vec_id, n_links, component_id, kept.

    Runs jobs at once; tables written between steps are in the shared folder.
    """
    rows = written(
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").mapInArrow(
            _digests, "vec_id long, digest binary, vector binary"
        ),
        "vectors",
    )
    reps = written(
        rows.filter("digest is not null and vec_id is not null")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")),
        "vector-classes",
    )
    t = tables_for(reps.count(), limit, recall)

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.assign(codes=None).astype({"codes": object}).reset_index(drop=True)
            sizes = out["vector"].map(len)
            for w in sizes.unique():
                at = np.flatnonzero(sizes == w)
                x = np.stack([np.frombuffer(out["vector"].iat[i], np.float64) for i in at])
                for i, c in zip(at, codes(x / np.abs(x).max(axis=1, keepdims=True), t), strict=True):
                    out.at[i, "codes"] = c.tobytes()
            yield out

    one = rows.select(F.col("vec_id").alias("rep"), F.col("digest").alias("_d"), "vector")
    classes = reps.join(one, (F.col("digest") == F.col("_d")) & (reps["rep"] == one["rep"])).select(
        reps["rep"], "digest", "n", "vector"
    )
    # A repeated row has the same id and vector as its class's first one.
    classes = classes.dropDuplicates(["rep", "digest"]).select("rep", "n", "vector")
    hashed = written(classes.mapInPandas(coded, "rep long, n long, vector binary, codes binary"), "vector-codes")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                c = np.stack([np.frombuffer(x, "<i4") for x in batch["codes"]])
                ids = batch["rep"].to_numpy()
                yield pd.DataFrame(
                    {"tab": np.tile(np.arange(c.shape[1]), len(c)), "code": c.ravel(), "rep": np.repeat(ids, c.shape[1])}
                )

    postings = hashed.select("rep", "codes").mapInPandas(spread, "tab int, code int, rep long")
    buckets = postings.groupBy("tab", "code").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    slices = F.ceil(F.col("size") / BUCKET).cast("int")
    members = (
        postings.join(buckets, ["tab", "code"])
        .withColumn("_q", slices)
        .withColumn("slot", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("_q")).cast("int"))
        .withColumn("_with", F.explode(F.sequence(F.lit(0), F.col("_q") - 1)))
        .withColumns({"left": F.least("slot", "_with"), "right": F.greatest("slot", "_with")})
        .select("tab", "code", "left", "right", "slot", "rep")
    )
    full = members.join(hashed, "rep")
    found = written(
        in_groups(full, ["tab", "code", "left", "right"], _compare(limit), "rep long, links long, to long"), "vector-links"
    )
    nodes = components(found.select(F.col("rep").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    known = (
        reps.join(links, "rep", "left")
        .join(nodes.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            F.col("digest").alias("_d"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return (
        rows.select("vec_id", "digest")
        .join(known, F.col("digest") == F.col("_d"), "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
