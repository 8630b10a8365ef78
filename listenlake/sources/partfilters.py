"""Filters that tell which parts of a table may hold a key, so that a small batch need not look into the others.

Each part has a split-block Bloom filter: a key's hash picks a block of eight 64-bit words, and one bit in each
word. A block is one row, so filters are built and asked by plain aggregates and joins. What a filter lets
through wrongly only costs a look at that part's keys; a part whose filter refuses a key never holds it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the name of the column that holds a row's part
PART = "part"
WORDS, BITS_A_KEY = 8, 24
FILTER_DDL = "blocks bigint, block bigint, " + ", ".join(f"w{i} bigint" for i in range(WORDS))


def _hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit(1))


def _bit(of: Column, i: int) -> Column:
    """One of the 64 bits of a word, as six bits of the hash say."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(of, 6 * i).bitwiseAND(F.lit(63)).cast("int"))


def part_filters(rows: DataFrame, key: str) -> DataFrame:
    """(part, blocks, block, w0 … w7): the filters of the rows' parts, sized by their rows.

    There is one size per part, so sizes are broadcast: tables bound their number of parts.
    """
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    blocks = F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.col("n") * BITS_A_KEY / (64 * WORDS), F.lit(1.0))))).cast("long")
    place, bits = _hashed(F.col(key))
    sized = rows.select(PART, place.alias("place"), bits.alias("bits")).join(F.broadcast(sizes.select(PART, blocks.alias("blocks"))), PART)
    words = [F.bit_or(_bit(F.col("bits"), i)).alias(f"w{i}") for i in range(WORDS)]
    return sized.groupBy(PART, "blocks", F.pmod("place", "blocks").alias("block")).agg(*words)


def parts_that_may_hold(filters: DataFrame, keys: DataFrame, key: str) -> list[str]:
    """Parts in whose filter some key of the frame may be. For few keys: they are broadcast."""
    sizes = [row.blocks for row in filters.select("blocks").distinct().collect()]  # powers of two
    if not sizes:
        return []
    place, bits = _hashed(F.col(key))
    asked = keys.select(place.alias("place"), *[_bit(bits, i).alias(f"m{i}") for i in range(WORDS)]).withColumn(
        "asked_blocks", F.explode(F.array(*[F.lit(x).cast("long") for x in sizes]))
    )
    asked = asked.withColumn("asked_block", F.pmod("place", "asked_blocks"))
    same = [F.col("blocks") == F.col("asked_blocks"), F.col("block") == F.col("asked_block")]
    same += [F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}") for i in range(WORDS)]
    found = filters.join(F.broadcast(asked), reduce(lambda a, b: a & b, same), "left_semi")
    return [row[PART] for row in found.select(PART).distinct().collect()]
