"""A Merkle manifest of a table as a persistent tree: changed rows make versions by path copying.

1. Every row is a leaf, the SHA-256 of its fields. Leaves are range-partitioned by (tree, key) and
   numbered without gaps within their tree from the counts of the parts.
2. ``2 ** LEVELS`` neighbouring leaves are an aligned block; a block's nodes are hashed in one row of
   a DataFrame, its root is a leaf of the next layer, and layers end when one block is left.
   Roots of trees, in the order of trees, are the leaves of one more tree, worked in the same way.
3. What a leaf needs from above its block, the siblings on the way up, goes down layer by layer, a row
   for each block.
4. A changed leaf is a version: its ancestors are copied inside its block, and the copy of the block's
   root goes on through the layers above with the siblings of that block. All other nodes
   are the first version's, which no version changes; no version is written as a whole.

A node of the last, shorter run is hashed alone as long as its tree has several nodes on that level;
a single leaf is its tree's root. All is column algebra; no tree, lang or version meets in one task.

Defined results: a NULL field is `-`; NULL keys and NULL trees come first; equal keys of a tree stand
in the order of their digests; repeated rows are leaves of their own with equal digests; a NULL id
is never tampered with; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dugout.llm.common import written
from dugout.session import shuffle_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 8
PART_ROWS = 1 << 18
PATH = "array<struct<digest:string,left:boolean>>"


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: `-` for NULL, else the number of UTF-8 bytes, `:` and the value."""
    texts = [f.cast("string") for f in fields]
    coded = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*coded), 256)


def document_leaves(docs: DataFrame, tampered: Column, changed: dict[str, Column]) -> DataFrame:
    """Leaves (tree, key, leaf, changed) of documents: a tree for each lang, keys are ids. ``changed``
    is the digest with the fields given, where ``tampered`` holds, else NULL."""
    own = leaf_digest([F.col(c) for c in FIELDS])
    other = leaf_digest([changed.get(c, F.col(c)) for c in FIELDS])
    # A name for each tree that is never NULL and sorts as the language does, NULL first.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return docs.select(tree.alias("tree"), F.col("doc_id").alias("key"), own.alias("leaf"), F.when(tampered, other).alias("changed"))


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0).cast("int")


def _placed(leaves: DataFrame) -> DataFrame:
    """Leaves with ``idx``, their number within the tree from 0, and ``depth`` and ``_part`` of the tree."""
    # Equal rows are one row with a count until they have numbers, so they are never one task's load.
    once = written(leaves.groupBy("tree", "key", "leaf", "changed").agg(F.count(F.lit(1)).alias("_rows")), "leaves")
    parts = max(shuffle_partitions(leaves.sparkSession), -(-once.count() // PART_ROWS))
    parted = once.repartitionByRange(parts, "tree", "key", "leaf").withColumn("_part", F.spark_partition_id())
    parted = written(parted, "parts")
    counts = parted.groupBy("tree", "_part").agg(F.sum("_rows").alias("_of"))
    of_tree = Window.partitionBy("tree")
    earlier = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("tree").alias("_t"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_of").over(earlier), F.lit(0)).alias("_start"),
        _depth(F.sum("_of").over(of_tree)).alias("depth"),
    )
    inner = Window.partitionBy("tree", "_part").orderBy("key", "leaf").rowsBetween(Window.unboundedPreceding, -1)
    local = parted.withColumn("_local", F.coalesce(F.sum("_rows").over(inner), F.lit(0)))
    joined = local.join(starts, (F.col("tree") == F.col("_t")) & (F.col("_part") == F.col("_p")))
    copy = F.explode(F.sequence(F.lit(0), F.col("_rows").cast("int") - 1))
    rows = joined.withColumn("_copy", copy).withColumn("idx", F.col("_start") + F.col("_local") + F.col("_copy"))
    return rows.select("tree", "idx", "depth", "leaf", "key", "changed")


def _parents(nodes: Column) -> Column:
    """The level above an array of nodes: every two hashed together, a last single one alone."""
    pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(pairs, lambda i: F.sha2(F.concat(F.get(nodes, i * 2), F.coalesce(F.get(nodes, i * 2 + 1), F.lit(""))), 256))


def _layer(nodes: DataFrame) -> DataFrame:
    """Blocks (tree, block, depth, steps, members, levels) of nodes (tree, idx, depth, leaf, ...).

    ``members`` are the rows of the block in order, ``levels`` the arrays of its nodes, lowest first.
    """
    rest = [c for c in nodes.columns if c not in ("tree", "depth")]
    block = F.shiftright("idx", LEVELS).alias("block")
    member = F.struct("idx", *(c for c in rest if c != "idx"))
    blocks = nodes.groupBy("tree", "depth", block).agg(F.sort_array(F.collect_list(member)).alias("members"))
    steps = F.least(F.col("depth"), F.lit(LEVELS))
    each = F.slice(F.array(*(F.lit(k) for k in range(LEVELS))), F.lit(1), F.col("steps"))
    levels = F.aggregate(
        each, F.array(F.col("members.leaf")), lambda done, _: F.concat(done, F.array(_parents(F.element_at(done, -1))))
    )
    return blocks.withColumn("steps", steps).withColumn("levels", levels)


def _layers(leaves: DataFrame, label: str) -> list[DataFrame]:
    """Written layers of blocks, lowest first; the last has one block for each tree."""
    layers, nodes = [], leaves
    while True:
        blocks = written(_layer(nodes), label)
        layers.append(blocks)
        nodes = blocks.select(
            "tree",
            F.col("block").alias("idx"),
            (F.col("depth") - F.col("steps")).alias("depth"),
            F.element_at(F.element_at("levels", -1), 1).alias("leaf"),
        )
        if not nodes.agg(F.max("depth")).first()[0]:
            return layers


def _roots(layers: list[DataFrame]) -> DataFrame:
    return layers[-1].select("tree", F.element_at(F.element_at("levels", -1), 1).alias("root"))


def _siblings(at: Column) -> Column:
    """Siblings on the way from the member at place ``at`` of a block to the block's root."""

    def one(nodes: Column, level: Column) -> Column:
        own = F.call_function("shiftright", at, level)
        return F.struct(F.get(nodes, own.bitwiseXOR(F.lit(1))).alias("digest"), (own % 2 == 1).alias("left"))

    return F.transform(F.slice("levels", F.lit(1), F.col("steps")), one).cast(PATH)


def _above(layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, block, subroot, path): for each block of the lowest layer the siblings above it; ``tops``
    holds (tree, subroot, path) of the trees' roots."""
    above = layers[-1].select("tree", "block").join(tops, "tree").select("tree", "block", "subroot", "path")
    for layer in reversed(layers[1:]):
        members = layer.join(above, ["tree", "block"]).select(
            "tree", "steps", "levels", "subroot", "path", F.posexplode("members").alias("_at", "_member")
        )
        path = F.concat(_siblings(F.col("_at")), "path").alias("path")
        above = members.select("tree", F.col("_member.idx").alias("block"), "subroot", path)
    return above


def _leaves_up(layers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest layer's members with their siblings ``inside`` the block and ``path``, those above it."""
    joined = layers[0].join(_above(layers, tops), ["tree", "block"])
    each = joined.select("*", F.posexplode("members").alias("_at", "_member"))
    return each.select("tree", "depth", "_member.*", "subroot", _siblings(F.col("_at")).alias("inside"), "path")


def _copied(start: Column, path: Column) -> Column:
    """The node ``start`` and the copies of its ancestors along ``path``."""

    def up(done: Column, s: Column) -> Column:
        own, other = F.element_at(done, -1), F.coalesce(s["digest"], F.lit(""))
        both = F.when(s["left"], F.concat(other, own)).otherwise(F.concat(own, other))
        return F.concat(done, F.array(F.sha2(both, 256)))

    return F.aggregate(path, F.array(start), up)


def manifest(leaves: DataFrame) -> DataFrame:
    """One row per row of ``leaves`` (tree, key, leaf, changed): tree, depth, idx, key, leaf, changed, subroot,
    root, ``path``, the siblings (digest, left) up to the root, a NULL digest where there is none, and
    ``copies``, the version of the leaf, changed or not: the leaf and the copied ancestors, the root last.

    Runs jobs at once; the driver sees counts and depths only.
    """
    layers = _layers(_placed(leaves), "blocks")
    # Trees are few against the leaves but not bounded, so their roots are worked like leaves.
    none = F.lit(None).cast("string").alias("changed")
    roots = _roots(layers).select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("leaf"), none)
    upper = _layers(_placed(roots), "roots")
    root = _roots(upper).first()
    end = _roots(upper).select("tree", F.col("root").alias("subroot"), F.array().cast(PATH).alias("path"))
    tops = _leaves_up(upper, end)
    tops = tops.select(F.col("key").alias("tree"), F.col("leaf").alias("subroot"), F.concat("inside", "path").alias("path"))
    rows = _leaves_up(layers, written(tops, "tops"))
    within = _copied(F.coalesce("changed", "leaf"), F.col("inside"))
    beyond = _copied(F.element_at("_within", -1), F.col("path"))
    rows = rows.withColumn("_within", within).withColumn("_beyond", beyond)
    return rows.select(
        "tree",
        "depth",
        "idx",
        "key",
        "leaf",
        "changed",
        "subroot",
        F.lit(root["root"] if root else None).cast("string").alias("root"),
        F.concat("inside", "path").alias("path"),
        F.concat("_within", F.slice("_beyond", 2, F.greatest(F.size("_beyond") - 1, F.lit(0)))).alias("copies"),
    )


def nodes(leaves: DataFrame) -> DataFrame:
    """The first version as a table: tree, level, idx, digest, each node of each tree once."""
    found = None
    for k, layer in enumerate(_layers(_placed(leaves), "blocks")):
        each = layer.select("tree", "block", "depth", "steps", F.posexplode("levels").alias("_level", "_nodes"))
        # A block's root is the next layer's leaf; only the last layer keeps it.
        each = each.filter((F.col("_level") < F.col("steps")) | (F.col("depth") == F.col("steps")))
        if k:
            # Trees that ended below come up as single nodes.
            each = each.filter("depth > 0")
        at = F.call_function("shiftleft", F.col("block"), F.lit(LEVELS) - F.col("_level")) + F.col("_at")
        each = each.select("tree", "block", "_level", F.posexplode("_nodes").alias("_at", "digest"))
        each = each.select("tree", (F.lit(k * LEVELS) + F.col("_level")).alias("level"), at.alias("idx"), "digest")
        found = each if found is None else found.unionByName(each)
    return found


def versions(leaves: DataFrame) -> DataFrame:
    """The copied nodes of every changed leaf's version: tree, key, leaf_idx, level, digest, and ``idx``, the
    place of the original on its level of the tree. Levels go on past the tree's root through the tree of roots,
    where ``idx`` is NULL. Every node without a copy is the first version's."""
    rows = manifest(leaves).filter("changed is not null")
    each = rows.select("tree", "key", "idx", "depth", F.posexplode("copies").alias("level", "digest"))
    place = F.when(F.col("level") <= F.col("depth"), F.call_function("shiftright", F.col("idx"), F.col("level")))
    return each.select("tree", "key", F.col("idx").alias("leaf_idx"), "level", place.alias("idx"), "digest")
