"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed size. Sorting the distinct blocks gives each an integer name;
then pairs of adjacent names are named the same way, level by level, until every document is down
to one name. Equal names of one level mean equal texts, by construction: a name stands for one
block, or for one pair of names, and never for a hash of it. Only DataFrame functions are used.

Blocks meet their names over a 64-bit key rather than over their text, so text is shuffled once.
Keys under which the sort has found more than one block are ambiguous; their blocks, and only
theirs, are joined by the text itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import WHITE, tagged, text_of
from listenlake.operators.durable import materialise

BLOCK = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, f"[{WHITE}]", "")


def _names(distinct: DataFrame, by: list[str], label: str, drop: str = "") -> DataFrame:
    """One row per distinct value with ``name``: its place in sorted order inside its partition.

    Equal values were brought to one partition by the distinct step, so a name is never shared.
    The write freezes names, which depend on the layout, before anything is joined to them.
    """
    named = distinct.sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())
    return materialise(named.drop(drop), label)


def _block_names(blocks: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(key, name) of the blocks told apart by their key, and (key, block, name) of the others, if any."""
    distinct = blocks.select(F.expr(key).alias("key"), "block").distinct()
    # frozen with their keys only, so that the corpus isn't stored again
    names = _names(distinct, ["block"], "block-names", drop="block")
    twice = names.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    if twice.isEmpty():
        return names, None
    odd = _names(distinct.join(twice, "key", "left_semi"), ["key", "block"], "ambiguous-blocks")
    # negative, so that they can't equal the others
    return names.join(twice, "key", "left_anti"), odd.withColumn("name", -1 - F.col("name"))


def named_texts(rows: DataFrame, text: str, block: int = BLOCK, key: str = "xxhash64(block)") -> DataFrame:
    """Give every row of ``rows`` an identity: (row, level, name).

    ``rows`` has a unique ``row`` number that is frozen, and the normalised ``text``. ``key`` is the
    SQL expression that blocks are joined by; any expression gives right names.
    """
    cut = F.when(F.col(text) == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{block}}}"), F.lit(0))
    )
    blocks = rows.select("row", F.posexplode(cut).alias("pos", "block"))
    clear, odd = _block_names(blocks, key)
    placed = blocks.withColumn("key", F.expr(key))
    level = placed.select("row", "pos", "key").join(clear, "key").select("row", "pos", "name")
    if odd is not None:
        level = level.unionByName(placed.join(odd, ["key", "block"]).select("row", "pos", "name"))
    level = materialise(level, "level")
    found, depth = [], 0
    while True:
        # a document is done once a single name is left; any other has a name at place 1
        longer = level.where("pos = 1").select("row")
        if longer.isEmpty():
            found.append(level.select("row", F.lit(depth).alias("level"), "name"))
            break
        found.append(level.join(longer, "row", "left_anti").select("row", F.lit(depth).alias("level"), "name"))
        half = F.floor(F.col("pos") / 2)
        side = lambda odd_place: F.max(F.when(F.col("pos") % 2 == odd_place, F.col("name")))
        pairs = level.join(longer, "row", "left_semi").groupBy("row", half.alias("pos"))
        pairs = pairs.agg(side(0).alias("left"), side(1).alias("right"))
        # a last name without a partner makes a pair of its own kind
        pairs = pairs.withColumn("single", F.col("right").isNull()).fillna(0, ["right"])
        pairs, both = materialise(pairs, "pairs"), ["left", "right", "single"]
        names = _names(pairs.select(both).distinct(), both, "pair-names")
        level = materialise(pairs.join(names, both).select("row", "pos", "name"), "level")
        depth += 1
    return reduce(DataFrame.unionByName, found)


def _grouped(docs: DataFrame, block: int, key: str) -> DataFrame:
    """What ``exact_groups`` returns, and ``points``: the code points of the text as it is."""
    # a row number of its own, as neither doc_id nor text need be unique; frozen with all that is
    # needed later, so that it is never dealt twice
    rows = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.length(text_of("text")).cast("long").alias("points"),
            normalised(text_of("text")).alias("text"),
        ),
        "exact-rows",
    )
    named = named_texts(rows, "text", block, key)
    digest = rows.select("row", "doc_id", "points", F.sha2("text", 256).alias("text_sha256"))
    known = materialise(digest.join(named, "row"), "exact")
    rank = F.struct((-F.col("points")).alias("p"), F.col("doc_id").isNull().alias("n"), "doc_id", "row")
    groups = known.groupBy("level", "name").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("group_size"))
    groups = materialise(groups, "exact-groups")  # apart from the join, which can then split a large group
    return known.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        "text_sha256",
        "points",
    )


def exact_groups(docs: DataFrame, block: int = BLOCK, key: str = "xxhash64(block)") -> DataFrame:
    """Groups of documents whose texts are equal when white space is deleted.

    Needs ``doc_id`` and ``text``; other columns are ignored, whatever their names. One row comes back
    per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``. Of equal texts the row with
    the most code points in the text as it is stays, then the smallest ``doc_id``; a null id comes after all
    others, and of rows that agree in both exactly one stays. A null text counts as an empty one, and
    empty texts are equal to each other. An empty table gives no rows.

    A very long text only takes more levels. The copies of one text meet as names, in joins that
    adaptive execution splits when one group is large, and groups are counted before they are shuffled.
    """
    return _grouped(docs, block, key).drop("points")


def drop_exact(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of repeated rows one."""

    def tag(points, digest):
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), points, digest)

    stay = _grouped(docs, BLOCK, "xxhash64(block)").where("kept")
    stay = stay.select(tag(F.col("points"), F.col("text_sha256")).alias("_tag"))
    text = text_of("text")
    rows = tagged(docs, tag(F.length(text), F.sha2(normalised(text), 256)))
    return rows.join(stay, "_tag", "left_semi").dropDuplicates(["_tag"]).select("_row.*")
