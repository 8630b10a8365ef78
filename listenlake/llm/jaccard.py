"""Near duplicates by a parity-sketch join.

A document is its set of word shingles. Every shingle flips one bit of a sketch (exclusive or), so two
sketches differ in at most as many bits as the sets differ in shingles. Sets of similarity t or more
and sizes a and b differ in at most (1 - t) / (1 + t) * (a + b) shingles. Both facts are used:

* Pigeonhole. In a band of set sizes the sketch is cut into parts. A part that no differing shingle
  falls into is equal in both documents, so similar documents share a part that isn't empty, unless
  all those parts are fewer than the differences can spoil. Each document gives the contents of its
  first D + 1 parts that aren't empty as keys, D being the most shingles that a similar set can differ by;
  one of them is then untouched. Content is compared by the exclusive or of the shingles' 64-bit hashes,
  a sketch so wide that no two shingles share a bit. A band reaches from T / 4 to T shingles; sizes that can
  be similar to some in the next band give keys for that one too.
* A document of few shingles may fill fewer than D + 1 parts, all of which it gives as keys. It meets every
  document that fills enough. For two that both don't, single shingles are the keys: the first so many in
  hash order that similar sets must share one.
* Bound. Pairs are dropped by their sizes and by the distance of sketches of 1,024 bits before any set
  is read, then verified on the sets.

Documents with equal sets form a class, which is compared once. Copies that differ never meet as all
pairs: within a key each class is first compared with two representatives; links join components;
and only classes of one key that are still in different components are compared with each other. So
every link between components is looked for, and a large group costs its size, not its square. Keys that very
many classes share, as passages do that stand in texts of all kinds, are mostly left out of this: a class
gives more keys than it needs, and may then leave out its most common ones.

Shingles, sets and parts are told apart by 64-bit hashes: two texts of a hundred billion would be
taken for one set with a probability of about one in a few, two texts of a billion with one in 37.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.components import components
from listenlake.llm.columns import tagged, text_of
from listenlake.llm.memory import let_go, slices
from listenlake.operators.durable import materialise

SHINGLE = 5
PERCENT = 75  # similarity from which two documents link
BAND = 4  # the largest size of a band over its smallest
SHORT, SPARE = 64, 10  # a set gives keys of all its parts if it is short, else a tenth more than it needs
PER_PART = 2.2  # shingles a part holds on average at the upper end of a band
REMEMBERED = 400_000


# One random number a byte, and an odd base whose powers tell places apart: the hash of a word is the sum of
# its bytes' numbers times the powers of the base, so all words of a text are hashed by one running sum.
OF_BYTE = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 64, 256, np.uint64)
WHITE_BYTE = np.zeros(256, bool)
WHITE_BYTE[[32, *range(9, 14)]] = True
BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of the base and of its inverse, as many as the longest text has asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size, inverse = 2 * n, pow(BASE, -1, 1 << 64)
            self.up, self.down = (
                np.multiply.accumulate(np.append(np.uint64(1), np.full(size - 1, np.uint64(x)))) for x in (BASE, inverse)
            )
        return self.up[:n], self.down[:n]


POWERS = Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number spread over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """A number for each word, letters A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    inside = ~WHITE_BYTE[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = POWERS(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(OF_BYTE[data] * up[:-1], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


# odd numbers that tell the places in a shingle apart
PLACES = np.random.Generator(np.random.PCG64(21)).integers(1, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None, k: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(k, len(h))
    n = len(h) - k + 1
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out += h[i : i + n] * PLACES[i]
    out = mixed(out)
    out.sort()
    return out[np.append(True, out[1:] != out[:-1])]


def salted(n: int, place: int) -> np.uint64:
    return np.uint64(n * int(PLACES[place]) % (1 << 64))


def most_differences(n: int, other: int | None = None, percent: int = PERCENT) -> int:
    """Shingles in which a set of n and a similar set can differ, the other's size given or the largest."""
    if other is None:
        other = 100 * n // percent
    return (100 - percent) * (n + other) // (100 + percent)


def bands(n: int, percent: int = PERCENT) -> list[int]:
    """Upper ends T of the bands in which a set of n gives keys: its own, and the next if it reaches there."""
    top = BAND
    while top < n:
        top *= BAND
    return [top, top * BAND] if 100 * n // percent > top else [top]


KINDS = 32  # keys carry their kind in their lowest bits


def keys_of(s: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int, np.ndarray]]:
    """(kind, spare, keys): keys under which the set meets all similar ones.

    Similar sets share one key more than the ``spare`` of one of them, among keys of one kind. So each may leave
    out as many keys as it has to spare, as long as two sets are compared where either of them didn't.
    """
    n, out = len(s), []
    for top in bands(n, percent):
        need = most_differences(n, percent=percent) + 1
        parts = max(-(-top * 5 // int(PER_PART * 5)), min(top, 64))
        part = ((s >> np.uint64(20)) % np.uint64(parts)).astype(np.uint16 if parts < 1 << 16 else np.uint64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        most = n if n <= SHORT else need + n // SPARE
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[:most]
        stop = int(np.searchsorted(part, part[first[-1]], "right"))
        content = np.bitwise_xor.reduceat(s[order[:stop]], first)
        key = mixed(content + part[first].astype(np.uint64) * PLACES[0] + salted(parts, 1))
        kind = top.bit_length() // 2
        out.append((kind, max(len(key) - need, 0), key))
        if len(key) < need:  # too few parts to promise that one stays untouched
            shared = -(-percent * n // 100)
            out.append((KINDS // 2 + kind, 0, mixed(s[: n - shared + 1] + salted(top, 2))))
    low = np.uint64(KINDS - 1)
    return [(kind, spare, key & ~low | np.uint64(kind)) for kind, spare, key in out]


SKETCH_BITS = 1024


def sketch_of(s: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Parity sketch as 64-bit words: the bit of every hash that an odd number of shingles fall on is set."""
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view("<i8")


def wide_sketch_of(s: np.ndarray) -> np.ndarray | None:
    """A sketch with a bit a shingle at least, for sets that are too large for the short one."""
    return sketch_of(s, 1 << (len(s) - 1).bit_length()) if len(s) > SKETCH_BITS else None


def class_of(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _tag() -> Column:
    """What a row is known by again: a hash of its id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), text_of("text"))


class Seen(set):
    """Classes that a task has given already; forgets all at a bound, which only repeats work."""

    def new(self, found: int) -> bool:
        if found in self:
            return False
        if len(self) >= REMEMBERED:
            self.clear()
        self.add(found)
        return True


WIDE = (
    "class long, key long, near long,"
    " doc struct<doc_id: long, tag: long, n: long, sketch: array<long>, spare: array<int>, wide: array<long>>"
)


def sets_and_keys(docs: DataFrame) -> DataFrame:
    """One pass over the texts that gives two kinds of rows.

    A row of every document: its class and ``doc``, in which sketch and class are null for texts without
    words and ``spare`` counts, by kind, the keys that its class may leave out. And members of keys: class,
    key, near. A task gives the keys of a class once. Of the classes that one slice of a batch holds under a key, the
    first goes on as the slice's only row with a null ``near``; if there are several, all of them come as rows with the
    first as ``near`` too. So a hot key sends one row a slice, two megabytes of texts, to where all rows of the key meet.
    """
    names = ["class", "key", "near", "doc"]
    fields = [
        pa.field("doc_id", pa.int64()), pa.field("tag", pa.int64()), pa.field("n", pa.int64()),
        pa.field("sketch", pa.list_(pa.int64())), pa.field("spare", pa.list_(pa.int32())),
        pa.field("wide", pa.list_(pa.int64())),
    ]

    def members(key, member, near):
        for i in range(0, len(key), 50_000):
            at = slice(i, i + 50_000)
            last = pa.nulls(len(key[at]), pa.int64()) if near is None else pa.array(near[at])
            found = [pa.array(member[at]), pa.array(key[at]), last, pa.nulls(len(key[at]), pa.struct(fields))]
            yield pa.RecordBatch.from_arrays(found, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen = Seen()
        for batch in (part for whole in batches for part in slices(whole, 2)):
            counts, sketches, ids, spares, wides, keys, given = [], [], [], [], [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py())
                counts.append(len(s))
                sketches.append(sketch_of(s) if len(s) else None)
                wides.append(wide_sketch_of(s))
                ids.append(class_of(s) if len(s) else None)
                found = keys_of(s) if len(s) else []
                spare = np.zeros(KINDS, np.int32)
                for kind, n, _ in found:
                    spare[kind] = n
                spares.append(spare[: KINDS // 2])
                if len(s) and seen.new(ids[-1]):
                    keys += [k for _, _, k in found]
                    given += [(len(k), ids[-1]) for _, _, k in found]
            columns = [
                batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(sketches, pa.list_(pa.int64())),
                pa.array(spares, pa.list_(pa.int32())), pa.array(wides, pa.list_(pa.int64())),
            ]
            # rows of documents meet no other rows under their key
            own = [pa.array(ids, pa.int64()), batch.column(1), pa.array([0] * len(batch), pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, pa.StructArray.from_arrays(columns, fields=fields)], names)
            if not keys:
                continue
            key = np.concatenate(keys)
            order = np.argsort(key)
            key = key[order].view(np.int64)
            member = np.repeat(np.array([c for _, c in given]), [n for n, _ in given])[order]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(start, len(key)))
            several = np.repeat(size > 1, size)
            near = np.repeat(member[start], size)[several]
            yield from members(key[start], member[start], None)
            yield from members(key[several], member[several], near)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _tag().alias("tag"), text_of("text").alias("text"))
    return plain.mapInArrow(run, WIDE)


def rows_and_members(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, tag, n, sketch, spare, wide, class) per row of ``docs``; and (key, class, near) of all keys with several classes.

    ``near`` is a class of the same key: the smallest of those that go to where the key's rows meet, or
    the slice's first.
    """
    meet = Window.partitionBy("key", "near")
    wide = sets_and_keys(docs).withColumns({"low": F.min("class").over(meet), "high": F.max("class").over(meet)})
    kept = wide.where(F.col("near").isNotNull() | (F.col("low") < F.col("high")))
    kept = kept.select("class", "key", F.coalesce("near", "low").alias("near"), "doc")
    kept = materialise(kept, "rows-and-members")
    return kept.where("doc IS NOT NULL").select("doc.*", "class"), kept.where("doc IS NULL").select("key", "class", "near")


FILTER_WORDS = 1 << 18  # of 64 bits: two megabytes, whatever the data


def class_filter(wanted: DataFrame) -> np.ndarray:
    """Bits of the wanted classes, in a table of fixed size; a class that isn't there is surely unwanted."""
    place = F.pmod(F.col("class"), F.lit(64 * FILTER_WORDS))
    words = wanted.groupBy(F.shiftright(place, 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(pmod(class, 64) AS int))")).alias("bits")
    )
    found, out = words.toArrow(), np.zeros(FILTER_WORDS, np.int64)
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out


def class_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, set) of the classes in ``wanted``, once each.

    What the fixed filter lets through without need only costs a shuffle; the join decides.
    """

    bits = class_filter(wanted)

    def may(c: int) -> bool:
        place = c % (64 * FILTER_WORDS)
        return bool(int(bits[place >> 6]) >> (place & 63) & 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        seen = Seen()
        for batch in (part for whole in batches for part in slices(whole, 0)):
            sets = (shingles(text.as_py()) for text in batch.column(0))
            found = [(c, s.view(np.int64)) for s in sets if len(s) and may(c := class_of(s)) and seen.new(c)]
            classes, sets = [c for c, _ in found], [s for _, s in found]
            columns = [pa.array(classes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["class", "set"])

    sets = docs.select(text_of("text").alias("text")).mapInArrow(run, "class long, set array<long>")
    return sets.join(wanted, "class", "left_semi").dropDuplicates(["class"])


def similar(percent: int = PERCENT) -> Column:
    """Whether the sets ``set`` and ``near_set`` link."""
    common = F.size(F.array_intersect("set", "near_set"))
    return 100 * common >= percent * (F.size("set") + F.size("near_set") - common)


def may_be_similar(percent: int = PERCENT) -> Column:
    """By sizes and sketches alone, for columns n and sketch, near_n and near_sketch; false only if no link.

    Sketches of one length for all sets keep this a plain expression, quick enough for a join. They tell
    sets of up to about 1,800 shingles apart; ``wide_may_be_similar`` does so for larger ones.
    """
    c = F.col
    sizes = percent * F.greatest("n", "near_n") <= 100 * F.least("n", "near_n")
    distance = sum((F.bit_count(c("sketch")[i].bitwiseXOR(c("near_sketch")[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    return sizes & (distance * (100 + percent) <= (100 - percent) * (c("n") + c("near_n")))


def wide_may_be_similar(percent: int = PERCENT) -> Column:
    """The same by the wide sketches of large sets. One of twice the length folds onto the shorter one."""
    m = F.least(F.size("wide"), F.size("near_wide"))

    def folded(name: str) -> Column:
        upper = F.slice(name, m + 1, m)
        return F.when(F.size(name) > m, F.zip_with(F.slice(name, 1, m), upper, lambda x, y: x.bitwiseXOR(y))).otherwise(F.col(name))

    bits = F.zip_with(folded("wide"), folded("near_wide"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    distance = F.aggregate(bits, F.lit(0), lambda a, x: a + x)
    near = distance * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("near_n"))
    return F.col("wide").isNull() | F.col("near_wide").isNull() | near


def _with_sides(pairs: DataFrame, table: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (class, near) with the given columns of both."""
    near = table.select(F.col("class").alias("near"), *[F.col(c).alias(f"near_{c}") for c in columns])
    return pairs.join(table.select("class", *columns), "class").join(near, "near")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (class, near) that link."""
    wanted = pairs.select("class").unionByName(pairs.select(F.col("near").alias("class"))).distinct()
    sets = materialise(class_sets(docs, materialise(wanted, "wanted")), "sets")
    return materialise(_with_sides(pairs, sets, ["set"]).where(similar()).select("class", "near"), "linked")


def _components(links: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, root) for all classes."""
    roots = components(links.select(F.col("class").alias("a"), F.col("near").alias("b")))
    roots = roots.withColumnRenamed("node", "class")
    return materialise(classes.select("class").join(roots, "class", "left").select("class", F.coalesce("root", "class").alias("root")), "roots")


def linked_classes(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """(class, root): components of the classes under all links."""
    near = members.where(F.col("class") != F.col("near")).groupBy("class", "near").agg(F.count(F.lit(1)).alias("shared"))
    near = materialise(near, "near")
    # first one link for each class, with the representative that it shares most keys with
    able = _with_sides(near, classes, ["n", "sketch", "wide"]).where(may_be_similar()).where(wide_may_be_similar())
    able = materialise(able.select("class", "near", "shared"), "able")
    best = able.groupBy("class").agg(F.max(F.struct("shared", "near")).alias("best")).select("class", F.col("best.near").alias("near"))
    links = verified(docs, materialise(best, "best"))
    roots = _components(links, classes)
    # then the other representatives, where they may join components: pieces of one group become one here,
    # so that its members needn't be compared with each other below
    more = _with_sides(able.select("class", "near"), roots, ["root"]).where("root != near_root").select("class", "near")
    more = materialise(more.distinct(), "more")
    if not more.isEmpty():
        links = links.unionByName(verified(docs, more))
        roots = _components(links, classes)
    # keys whose classes are not all in one component yet: these classes are compared with each other
    apart = _with_sides(near.select("class", "near"), roots, ["root"]).where("root != near_root").select("class", "near")
    keys = members.join(materialise(apart, "apart"), ["class", "near"], "left_semi").select("key").distinct()
    open_ = members.join(keys, "key", "left_semi").select("key", "class").distinct()
    open_ = materialise(open_, "open")
    # a class leaves out its most common keys, as many as it has to spare: what many texts share by the way
    often = open_.groupBy("key").agg(F.count(F.lit(1)).alias("often"))
    kind = F.pmod("key", F.lit(KINDS)).cast("int")
    rank = F.row_number().over(Window.partitionBy("class", kind).orderBy(F.desc("often"), "key"))
    ranked = open_.join(often, "key").withColumn("rank", rank).join(classes.select("class", "spare"), "class")
    kept = F.col("rank") > F.coalesce(F.get("spare", kind), F.lit(0))
    ranked = materialise(ranked.select("key", "class", kept.alias("kept")), "ranked")
    # what no class of a key keeps is compared under other keys
    open_ = ranked.join(ranked.where("kept").select("key").distinct(), "key", "left_semi").join(roots, "class")
    open_ = materialise(open_.join(classes.select("class", "n", "sketch"), "class"), "open-sets")
    other = open_.select("key", *[F.col(c).alias("near" if c == "class" else f"near_{c}") for c in ("class", "root", "n", "sketch", "kept")])
    # of two that keep the key the larger is the class; else the one that keeps it
    once = ~F.col("near_kept") | (F.col("class") > F.col("near"))
    pairs = open_.where("kept").join(other, (open_.key == other.key) & once & (F.col("root") != F.col("near_root")) & may_be_similar())
    pairs = pairs.select(F.greatest("class", "near").alias("class"), F.least("class", "near").alias("near")).distinct()
    left = _with_sides(pairs, classes, ["n", "wide"]).where(wide_may_be_similar()).select("class", "near")
    left = materialise(left, "left")
    if left.isEmpty():
        return roots
    return _components(links.unionByName(verified(docs, left)), classes)


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, n, component_id) per row, and ``root`` for texts with words."""
    rows, members = rows_and_members(docs)
    classes = rows.where("n > 0").groupBy("class").agg(
        F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
        F.first("spare").alias("spare"), F.first("wide").alias("wide"),
    )
    classes = materialise(classes, "classes")
    roots = linked_classes(docs, classes, members)
    least = classes.join(roots, "class").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = materialise(roots.join(least, "root").select("class", "root", "component_id"), "named")
    full = rows.where("n > 0").join(named, "class").select("doc_id", "tag", "n", "component_id", "root")
    none = rows.where("n = 0").select("doc_id", "tag", "n", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"))
    return full.unionByName(none)


def near_groups(docs: DataFrame) -> DataFrame:
    """Components of similar documents: doc_id, n_shingles, component_id per row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. ``component_id`` is the
    smallest id of the component; null ids never are it unless all are null. Texts without words (null,
    empty, white space) have no shingles and are linked with nothing; texts under five words are one
    shingle. Repeated rows are in one component. An empty table gives no rows.
    """
    return _grouped(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def drop_near(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one with the smallest id.

    A row without an id stays only if its whole component has none. Texts without words are no one's
    duplicates and stay, but of rows that agree in id and text one stays.
    """
    known = _grouped(docs)
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "tag")
    first = known.where("n > 0").groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.tag").alias("_tag"))
    stay = materialise(first.unionByName(known.where("n = 0").select(F.col("tag").alias("_tag"))).distinct(), "kept")
    return tagged(docs, _tag()).join(stay, "_tag", "left_semi").dropDuplicates(["_tag"]).select("_row.*")
