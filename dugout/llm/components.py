"""Connected components of an edge table, as alternating large and small stars.

Each round every node's neighbours are tied to the smallest node around it (Kiveris et al.,
"Connected Components in MapReduce and Beyond"). Hot nodes are safe: minima combine before the
shuffle, and the joins may be split by Spark. Every round is written to the shared folder,
so lineage stays short; the driver sees counts only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dugout.llm.common import written


def _tied(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    return edges.join(smallest.withColumnRenamed("a", "_n"), F.col("a") == F.col("_n")).drop("_n")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _tied(both, smallest).filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    ties = _tied(edges, smallest).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return ties.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()


def _is_star(edges: DataFrame) -> bool:
    """Every node has one parent and no parent has one itself."""
    parents = edges.select(F.col("b").alias("a")).distinct().join(edges, "a", "left_semi")
    twice = edges.groupBy("a").count().filter("count > 1").select("a")
    return parents.unionByName(twice).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes with an edge; component is the smallest node reachable.

    ``edges`` has long columns a and b; order, loops, NULLs and repeats do not matter. Runs
    jobs at once, a few rounds of them.
    """
    proper = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    star = written(proper.distinct(), "components")
    while not _is_star(star):
        star = written(_small_star(_large_star(star)), "components")
    nodes = star.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(star.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and an array of pairs, the smallest node of each one's component."""
    root = np.arange(n)
    while len(pairs):
        low = np.minimum(root[pairs[:, 0]], root[pairs[:, 1]])
        before = root.copy()
        for side in (0, 1):
            np.minimum.at(root, root[pairs[:, side]], low)
            np.minimum.at(root, pairs[:, side], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def by_group(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups from batches sorted by ``key``: frames that never cut a group apart."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = (batch[key] == batch[key].iloc[-1]).all(axis=1).to_numpy()
        start = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        same = held and (held[-1][key].iloc[-1] == batch[key].iloc[0]).all()
        if start == 0 and (same or not held):
            held.append(batch)
            continue
        done = pd.concat([*held, batch.iloc[:start]], ignore_index=True)
        held = [batch.iloc[start:]]
        yield done
    if held:
        yield pd.concat(held, ignore_index=True)


def in_groups(df: DataFrame, key: list[str], work: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Applies ``work`` to frames of whole groups; many small groups share a call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in by_group(batches, key):
            yield from work(frame)

    return df.repartition(*key).sortWithinPartitions(*key).mapInPandas(run, schema)
