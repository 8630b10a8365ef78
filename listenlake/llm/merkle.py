"""A Merkle manifest of a dataset: one digest that every row can be held against.

The leaves of a tree, in order, are cut into superblocks of ``2 ** height`` places. Going up, each superblock
is reduced to one node, and those nodes are the leaves of the next, smaller tree, until one node is left.
Going down, each superblock's nodes are cogrouped with the siblings above their superblock: one task reduces
the block once more, joins the proofs of all its nodes to the outer part and folds them. A row's proof thus
needs no join per level, and no task or driver holds more than one superblock.

The trees of the languages are built side by side; their roots, in order of language, are the leaves of a
last tree.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.operators.durable import materialise

# places of a superblock, as a power of two
HEIGHT = 12
# The fields of a leaf in order, and what stands for a null.
FIELDS, NULL = ("doc_id", "source", "lang", "n_chars", "text"), "-"
# rows whose number this divides are tampered with
TAMPERED_EACH = 7
LEFT, RIGHT, ALONE = "l", "r", "-"


def _field(value: Column) -> Column:
    return F.when(value.isNull(), NULL).otherwise(F.concat(F.octet_length(value), F.lit(":"), value))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields; ``changed`` gives other values for some of them."""
    values = [changed.get(name, F.col(name)).cast("string") for name in FIELDS]
    return F.sha2(F.concat(*map(_field, values)), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, tree, leaf, held): the leaf of each row, and the one to be held against the manifest.

    ``tree`` is the language with a mark before it, so that null comes first and isn't the empty one.
    """
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        # wide enough for a number to be added to
        F.col("n_chars").cast("decimal(20,0)").alias("n_chars"),
        F.col("text").cast("string").alias("text"),
    )
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EACH == 0, F.lit(False))
    return plain.select(
        "doc_id",
        F.when(F.col("lang").isNull(), "0").otherwise(F.concat(F.lit("1"), "lang")).alias("tree"),
        leaf().alias("leaf"),
        F.when(hit, leaf(n_chars=(F.col("n_chars") + 1))).alias("other"),
    ).select("doc_id", "tree", "leaf", F.coalesce("other", "leaf").alias("held"))


def placed(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """Add ``place`` (from 0, by ``order`` inside the tree) and ``size`` (nodes of the tree).

    Rows are range-partitioned, so a tree with most of the rows runs over many partitions. Its row numbers
    are consecutive inside a partition; where they begin is one row per partition and tree.
    """
    ordered = materialise(rows.orderBy("tree", *order).withColumn("_at", F.monotonically_increasing_id()), label)
    ordered = ordered.withColumn("_segment", F.shiftright("_at", 33))
    begun = ordered.groupBy("tree", "_segment").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.sum("_rows").over(tree.orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1))
    begun = begun.select("tree", "_segment", "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_rows").over(tree).alias("size"))
    place = F.col("_before") + F.col("_at") - F.col("_first")
    return ordered.join(begun, ["tree", "_segment"]).withColumn("place", place).drop("_at", "_segment", "_first", "_before")


def digest(*nodes: str) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels(nodes: list[str], most: int, whole: bool) -> list[list[str]]:
    """The nodes of each level, bottom first: up to a single node, or ``most`` levels up if the tree goes on."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= most:
        below = out[-1]
        out.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return out


def proof(local: list[list[str]], i: int) -> tuple[str, str]:
    """Siblings of node ``i`` from the bottom to the top of a block, joined, and the side each stands on."""
    found, sides = [], []
    for level in local[:-1]:
        other = i ^ 1
        if other < len(level):
            found.append(level[other])
            sides.append(LEFT if other < i else RIGHT)
        else:
            sides.append(ALONE)
        i >>= 1
    return "".join(found), "".join(sides)


def fold(node: str, siblings: str, sides: str) -> str:
    """The root that a node and its proof lead to."""
    at = 0
    for side in sides:
        if side == ALONE:
            node = digest(node)
        else:
            other = siblings[at : at + 64]
            node = digest(other, node) if side == LEFT else digest(node, other)
            at += 64
    return node


def _block(height: int) -> Column:
    return F.shiftright("place", height).alias("block")


def reduced(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One node per superblock, placed in the next tree: (tree, place, size, node)."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        size = int(group["size"].iloc[0])
        top = levels(group["node"].tolist(), height, size <= 1 << height)[-1][0]
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "size": [-(-size >> height)], "node": [top]})

    blocks = nodes.select("tree", _block(height), "place", "size", "node")
    return blocks.groupBy("tree", "block").applyInPandas(run, "tree string, place long, size long, node string")


OUTER = "tree string, block long, siblings string, sides string, root string"


def exchanged(nodes: DataFrame, outer: DataFrame, height: int, columns: list[str], finish, kind: str) -> DataFrame:
    """Cogroup each superblock's nodes with the siblings above it, and ``finish`` every node.

    ``outer`` has one row per superblock: the siblings, sides and root above its top node. ``finish`` gets the row
    of a node (``columns``), its whole proof, the sides and the root.
    """

    def run(key: tuple, group: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", ignore_index=True)
        local = levels(group["node"].tolist(), height, bool((group["size"] <= 1 << height).iloc[0]))
        siblings, sides, root = above.loc[0, ["siblings", "sides", "root"]]
        out = []
        for i, row in enumerate(zip(*(group[c] for c in columns))):
            inner, inner_sides = proof(local, i)
            out.append(finish(row, inner + siblings, inner_sides + sides, root))
        return pd.DataFrame(out, columns=[f.split()[0] for f in kind.split(", ")])

    # every column may be needed twice, as a group's key and as a value
    blocks = nodes.select("tree", _block(height), "place", "size", "node", *[c for c in columns if c not in ("tree", "place", "size", "node")])
    return blocks.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(run, kind)


def proofs(nodes: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """(roots, outer) of all trees of ``nodes``: (tree, node), and one row per superblock as ``exchanged`` takes it.

    The levels of superblocks are as many as the logarithm of the largest tree by ``2 ** height``: three for 60 billion rows.
    """
    ups = [materialise(reduced(nodes, height), "merkle-nodes")]
    while not ups[-1].where("size > 1").isEmpty():
        # finished trees have a single node and stay as they are
        ups.append(materialise(reduced(ups[-1], height), "merkle-nodes"))
    roots = ups[-1].select("tree", "node")
    outer = ups[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit("").alias("siblings"), F.lit("").alias("sides"), F.col("node").alias("root"))
    for up in reversed(ups[:-1]):
        outer = exchanged(up, outer, height, ["tree", "place"], lambda row, siblings, sides, root: (*row, siblings, sides, root), OUTER)
    return roots, outer


MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Manifest of ``docs`` and the check of every row against it.

    Needs ``doc_id, source, lang, n_chars, text``; other columns, whatever their names, are ignored. One row comes
    back per row: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``. Rows whose number says so
    are held against the manifest with one more character counted, so they must fail; a null count stays null and
    passes. Null fields have a mark of their own in the leaf; a null language is a tree of its own and comes first.
    Rows of one id come in order of their leaves, a null id before all others; repeated rows have leaves of their own
    and the same digest. A very long text is one digest. An empty table gives no rows.
    """
    frozen = materialise(leaves(docs).withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    # the row number only tells repeated rows apart, so that many of them can be split
    nodes = materialise(placed(frozen.withColumnRenamed("leaf", "node"), ["doc_id", "node", "row"], "merkle-order"), "merkle-places")
    subroots, inner = proofs(nodes, height)
    inner = materialise(inner, "merkle-outer")
    top = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "node")
    top = materialise(placed(top, ["lang"], "merkle-top-order"), "merkle-top")
    _, above = proofs(top, height)

    def join(row, siblings, sides, root):
        return (row[0], siblings, sides, root)

    tops = materialise(exchanged(top, above, height, ["lang"], join, "tree string, t_siblings string, t_sides string, t_root string"), "merkle-tops")
    # the way from a superblock through its language's root to the root of all
    outer = inner.join(tops, "tree").select(
        "tree",
        "block",
        F.concat("siblings", "t_siblings").alias("siblings"),
        F.concat("sides", "t_sides").alias("sides"),
        F.concat_ws(":", "root", "t_root").alias("root"),
    )

    def finish(row, siblings, sides, root):
        subroot, _, whole = root.partition(":")
        doc_id, node, held = row
        found = fold(held, siblings, sides)
        return (None if doc_id != doc_id else doc_id, node, subroot, whole, digest(siblings), found, found == whole)

    # a null id comes to pandas as text, so that large ids keep all their digits
    nodes = nodes.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = exchanged(nodes, outer, height, ["doc_id", "node", "held"], finish, MANIFEST.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
