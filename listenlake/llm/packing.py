"""Packing of documents into sequences by a grouping genetic algorithm on islands.

A genome is a whole packing, and its genes are bins. Crossover injects the well-filled bins of one
parent into the other, removes the bins that hold one of their documents a second time, and puts what
lost its place where it fits best. Documents are dealt over shards by a hash; each shard is packed
on several islands, tasks of their own, whose elites move to the next island between epochs. Bins
of a shard's best packing that are as good as full are settled; what the others hold is dealt anew over
fewer shards and packed again, so that a half-empty last bin per shard doesn't stay.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of
from listenlake.llm.memory import let_go, small_batches
from listenlake.llm.tokenizer import REMEMBERED, encoder
from listenlake.operators.durable import materialise

CAPACITY = 2048
SHARD_ITEMS, ISLANDS, EPOCHS, GENERATIONS, POPULATION, ROUNDS = 1500, 2, 2, 5, 4, 3
SETTLED_WASTE = 4
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """Token pieces of every document: its ids and a closing 0, cut into ``capacity`` tokens from the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, remembered=remembered).encode
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + b"\0\0\0\0"
                n = len(ids) // 4
                start, end = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    rows.append((doc_id, piece, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                    start, end = end, end + capacity
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], PIECES.split()[::2])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return plain.mapInArrow(run, PIECES)


class Packing:
    """Bins of item numbers, and how full they are."""

    def __init__(self, sizes: list[int], capacity: int, bins: list[list[int]] = ()):
        self.sizes, self.capacity = sizes, capacity
        self.bins = [list(b) for b in bins]

    def fills(self) -> list[int]:
        return [sum(map(self.sizes.__getitem__, b)) for b in self.bins]

    def insert(self, items: list[int]) -> None:
        """Best fit: each item into the fullest bin that has room, or a new one."""
        sizes, bins = self.sizes, self.bins
        room = sorted((self.capacity - f, k) for k, f in enumerate(self.fills()))
        for item in items:
            at = bisect_left(room, (sizes[item], -1))
            if at < len(room):
                left, k = room.pop(at)
            else:
                left, k = self.capacity, len(bins)
                bins.append([])
            bins[k].append(item)
            if left > sizes[item]:
                insort(room, (left - sizes[item], k))

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first; then rather some full and some empty bins than all half full."""
        return -len(self.bins), sum((f / self.capacity) ** 2 for f in self.fills())


def descending(sizes: list[int], items, rng: random.Random, noise: float) -> list[int]:
    return sorted(items, key=lambda i: -sizes[i] * (1 + noise * rng.random()))


def crossover(one: Packing, other: Packing, rng: random.Random) -> Packing:
    """``one`` with well-filled bins of ``other``; displaced items go where they fit best."""
    fills = other.fills()
    order = sorted(range(len(fills)), key=lambda k: -fills[k])
    good = order[: max(1, int(len(order) * rng.uniform(0.2, 0.7)))]
    injected = [other.bins[k] for k in rng.sample(good, max(1, len(good) // 2))]
    taken = {i for b in injected for i in b}
    kept = [b for b in one.bins if taken.isdisjoint(b)]
    # a few of the emptiest bins are opened as well: mutation
    kept_fill = sorted(range(len(kept)), key=lambda k: sum(map(one.sizes.__getitem__, kept[k])))
    opened = set(kept_fill[: rng.randint(1, 3)])
    child = Packing(one.sizes, one.capacity, injected + [b for k, b in enumerate(kept) if k not in opened])
    placed = {i for b in child.bins for i in b}
    child.insert(descending(one.sizes, (i for i in range(len(one.sizes)) if i not in placed), rng, 0.0))
    return child


def evolve(sizes: list[int], capacity: int, seed: int, elites: list[list[list[int]]]) -> Packing:
    """The best packing after some generations from the given elites and fresh ones."""
    rng = random.Random(seed)
    people = [Packing(sizes, capacity, bins) for bins in elites]
    while len(people) < POPULATION:
        fresh = Packing(sizes, capacity)
        fresh.insert(descending(sizes, range(len(sizes)), rng, 0.0 if not people else 0.3))
        people.append(fresh)
    least = -(-sum(sizes) // capacity)
    for _ in range(GENERATIONS):
        people.sort(key=Packing.fitness, reverse=True)
        if len(people[0].bins) <= least:
            break
        children = [crossover(*rng.sample(people, 2), rng) for _ in range(POPULATION // 2)]
        people = sorted(people + children, key=Packing.fitness, reverse=True)[:POPULATION]
    return max(people, key=Packing.fitness)


def _bins(column: pd.Series) -> list[list[int]]:
    out: dict[int, list[int]] = {}
    for item, k in enumerate(column):
        out.setdefault(int(k), []).append(item)
    return list(out.values())


EPOCH = "shard long, island int, item long, length long, bin int, offset long, fill long, bins int, score double"


def _epoch(rows: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """One epoch on every island. ``rows`` has own and guest bins, null in the first epoch."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        let_go()
        group = group.sort_values("item", ignore_index=True)
        sizes = group["length"].tolist()
        elites = [_bins(group[c]) for c in ("own", "guest") if len(group) and group[c].notna().all()]
        best = evolve(sizes, capacity, hash((int(key[0]), int(key[1]), epoch)), elites)
        n = len(sizes)
        at, offset, fill = np.zeros(n, "i4"), np.zeros(n, "i8"), np.zeros(n, "i8")
        for k, items in enumerate(best.bins):
            widths = [sizes[i] for i in items]
            at[items], fill[items] = k, sum(widths)
            offset[items] = np.cumsum([0, *widths[:-1]])
        bins, score = best.fitness()
        out = group[["shard", "island", "item", "length"]]
        return out.assign(bin=at, offset=offset, fill=fill, bins=np.int32(-bins), score=score)

    return rows.groupBy("shard", "island").applyInPandas(run, EPOCH)


def _settle(items: DataFrame, n: int, capacity: int, turn: int) -> DataFrame:
    """Best packing of each shard: (shard, item, length, bin, offset, fill)."""
    shards = max(1, -(-n // SHARD_ITEMS))
    dealt = items.select(
        F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(shards)).alias("shard"), "item", "length"
    )
    none = F.lit(None).cast("int")
    state = dealt.select(
        "shard", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("island"), "item", "length",
        none.alias("own"), none.alias("guest"),
    )
    for epoch in range(EPOCHS):
        done = materialise(_epoch(state, capacity, epoch), "islands")
        if epoch + 1 < EPOCHS:  # every island takes in the elite of the one before it
            guest = done.select(
                "shard", ((F.col("island") + 1) % ISLANDS).alias("island"), "item", F.col("bin").alias("guest")
            )
            own = done.select("shard", "island", "item", "length", F.col("bin").alias("own"))
            state = own.join(guest, ["shard", "island", "item"]).select(*state.columns)
    best = done.groupBy("shard").agg(F.min(F.struct("bins", -F.col("score"), "island")).alias("best"))
    best = best.select("shard", F.col("best.island").alias("island"))
    return done.join(best, ["shard", "island"]).select("shard", "item", "length", "bin", "offset", "fill")


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Place items, each with a unique ``item`` number and a ``length`` of 1 to ``capacity``.

    Returns (item, sequence_id, offset). An item that fills a sequence has it alone, numbered below zero.
    """
    whole = items.where(F.col("length") == capacity)
    out = whole.select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = items.where(F.col("length") < capacity).select("item", "length")
    for turn in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        found = materialise(_settle(rest, n, capacity, turn), "settled")
        last = turn == ROUNDS - 1 or n <= SHARD_ITEMS
        settled = found if last else found.where(F.col("fill") >= capacity - SETTLED_WASTE)
        # shards stay below 2^40 and bins of a shard below 2^20
        number = F.lit(turn << 60) + F.shiftleft("shard", 20) + F.col("bin")
        out = out.unionByName(settled.select("item", number.alias("sequence_id"), "offset"))
        if last:
            break
        rest = found.where(F.col("fill") < capacity - SETTLED_WASTE).select("item", "length")
    return out


def packed(docs: DataFrame, capacity: int = CAPACITY, ranks_path: str | None = None, remembered: int = REMEMBERED) -> DataFrame:
    """Pack every document: doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. Null and empty texts
    are one closing id; null ids and repeated rows are packed like all others, a row each time it
    occurs. Only documents of over ``capacity`` tokens are cut, however long they are: all their pieces
    but the first are full. An empty table gives no rows. A worker holds up to twice ``remembered`` words with
    their ids: fewer take less memory and more time, with the same result.
    """
    with small_batches(docs.sparkSession):
        pieces = materialise(pieces_of(docs, capacity, ranks_path, remembered).withColumn("item", F.monotonically_increasing_id()), "pieces")
    return pieces.join(pack(pieces, capacity), "item").drop("item")
