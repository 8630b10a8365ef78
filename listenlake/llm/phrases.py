"""Phrase mining by a sample, its negative border and full counts.

A sample proposes phrases. A full pass then counts the proposed ones and their negative border: all phrases that
were not proposed though both their parts (all but the last word, all but the first) were. Every word belongs to one
of the two. If no phrase of the border turns out to be frequent, nothing can have been missed. Otherwise the border
has failed there: what is frequent joins the known phrases, and another pass counts the border that this opens, until
none fails. A phrase of k words is known after k passes at the latest.

These passes count 64-bit hashes, most of which are rare: two phrases of one hash can only count too much. A last
pass counts what has passed by the phrases themselves, so that the result is exact. Where the failures have few
occurrences, it also counts all that they and their extensions open, and no pass is needed between.

Known and frequent phrases go to the tasks as bits at places given by their hash, filters of fixed size. Phrases
that share a bit only make a pass count more than it must.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of
from listenlake.operators.durable import materialise

# What ends a piece, what ends a word, the language of rows without one, and what makes a phrase.
BREAKS, BLANKS, NO_LANG = b".,;:!?\x0a\x0b\x0c\x0d", b"\x20\x09", "und"
LONGEST, LEAST, TOP = 5, 100, 2000
# The sample: its share of the rows, and the part of the expected count that is enough to propose a phrase.
SHARE, LOWERED, SEED = 1 / 16, 0.4, 11
# share of all words up to which the failures of a border may occur if all that they open is to be counted at once
FEW = 1 / 16
# places of a filter: 8 MB of bits, whatever the size of the data
PLACES = 1 << 26
# bytes of text that are counted together before they go to Spark's own aggregation
CHUNK = 2 << 20

_BYTES = pa.large_binary()
_KIND = np.zeros(256, "u1")
_KIND[list(BLANKS)], _KIND[list(BREAKS)] = 1, 2
_LOWER = np.arange(256, dtype="u1")
_LOWER[ord("A") : ord("Z") + 1] += 32
_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def _hashes(values: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(v) for v in values.to_pylist()], "u8")


class Words:
    """The words of some texts: ``ids`` into ``names``, their piece, the language code, and a hash of both."""

    def __init__(self, langs: pa.Array, texts: pa.Array):
        # a break after every text, so that no phrase runs from one into the next
        texts = pc.binary_join_element_wise(texts.cast(_BYTES), pa.scalar(b"", _BYTES), pa.scalar(b"\n", _BYTES))
        ends = np.frombuffer(texts.buffers()[1], "i8")[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", "u1")[ends[0] : ends[-1]]
        kind = _KIND[data]
        inside = kind == 0
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, widths = edges[::2], edges[1::2] - edges[::2]
        letters = _LOWER[data[inside]]
        offsets = np.concatenate([[0], np.cumsum(widths)])
        words = pa.Array.from_buffers(_BYTES, len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
        words, langs = words.dictionary_encode(), langs.dictionary_encode()
        self.names, self.ids = words.dictionary, words.indices.to_numpy()
        self.texts = np.searchsorted(ends[1:] - ends[0], starts, "right")
        self.pieces = np.searchsorted(np.flatnonzero(kind == 2), starts)
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy(zero_copy_only=False)[self.texts]
        self.hashes = _hashes(self.names)[self.ids]
        self.seeds = _hashes(self.langs)[self.lang] if len(starts) else self.hashes

    def rolled(self) -> Iterator[np.ndarray]:
        """For 1 word, 2 words and so on: a hash of the phrase that begins at each word, piece borders ignored.

        The lowest three bits are the number of words.
        """
        h = _mixed(self.seeds * _STEP + self.hashes)
        for k in range(1, LONGEST + 1):
            yield h & ~np.uint64(7) | np.uint64(k)
            h = _mixed(h[:-1] * _STEP + self.hashes[k:])

    def phrases(self, k: int, at: np.ndarray) -> pa.Array:
        """The phrases of ``k`` words that begin at the words ``at``."""
        parts = [self.names.take(pa.array(self.ids[at + j])) for j in range(k)]
        return pc.binary_join_element_wise(*parts, pa.scalar(b" ", _BYTES)).cast(pa.string()) if k > 1 else parts[0].cast(pa.string())

    def grouped(self, k: int, at: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where distinct phrases of ``k`` words begin, one each, and how often they do among ``at``."""
        coded = pa.array(h[at]).dictionary_encode()
        codes, found = coded.indices.to_numpy(), coded.dictionary
        first = np.empty(len(found), at.dtype)
        first[codes[::-1]] = at[::-1]
        same = self.lang[at] == self.lang[first[codes]]
        for j in range(k):
            same &= self.ids[at + j] == self.ids[first[codes] + j]
        if same.all():
            return first, np.bincount(codes, minlength=len(found))
        # two phrases of one hash: told apart by their words
        rows = np.stack([self.lang[at], *(self.ids[at + j] for j in range(k))], 1)
        _, index, counts = np.unique(rows, axis=0, return_index=True, return_counts=True)
        return at[index], counts


def _held(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    place = h & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype("u1")) & np.uint8(1) != 0


def _opened(words: Words, k: int, h: np.ndarray, was: np.ndarray | None, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a pass with the filter ``before`` has counted phrases of ``k`` words, and where it let longer ones through.

    ``was`` is the second of these for phrases of one word less. A phrase that shares its bit with a known one opened nothing
    then if that pass had not come to it.
    """
    counted = words.pieces[: len(h)] == words.pieces[k - 1 :]
    if k > 1:
        counted &= was[:-1] & was[1:]
    return counted, counted & _held(before, h)


def border(words: Words, known: np.ndarray | None, before: np.ndarray | None = None) -> Iterator[np.ndarray]:
    """Hashes, as they occur, of the phrases whose parts are both ``known``, but were not both ``before``.

    Without ``known`` these are all phrases; without ``before``, all words are among them.
    """
    open_ = was = None
    for k, h in enumerate(words.rolled(), 1):
        take = words.pieces[: len(h)] == words.pieces[k - 1 :]
        if k > 1 and known is not None:
            take &= open_[:-1] & open_[1:]
        if known is not None:
            open_ = take & _held(known, h)
        if before is not None:
            then, was = _opened(words, k, h, was, before)
            take &= ~then
        yield h[take]


def exact(words: Words, wanted: np.ndarray, known: np.ndarray | None, before: np.ndarray | None) -> Iterator[tuple]:
    """(k, places, counts) of the ``wanted`` phrases of k words.

    With ``known`` and ``before``, of all that a ``border`` of them holds as well. What that holds may be part of others,
    as nothing says yet that it is rare.
    """
    open_ = was = None
    for k, h in enumerate(words.rolled(), 1):
        inside = words.pieces[: len(h)] == words.pieces[k - 1 :]
        take = inside & _held(wanted, h)
        if known is not None:
            then, was = _opened(words, k, h, was, before)
            new = np.zeros(len(h), bool) if k == 1 else inside & open_[:-1] & open_[1:] & ~then
            open_ = inside & (_held(known, h) | new)
            take |= new
        at = np.flatnonzero(take)
        if len(at):
            yield k, *words.grouped(k, at, h)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Rows of language and text, gathered or parted to about ``CHUNK`` bytes; a longer text is a chunk of its own."""
    for batch in batches:
        langs, texts = batch.columns
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > CHUNK:
                yield Words(langs.slice(start, i - start), texts.slice(start, i - start))
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield Words(langs.slice(start), texts.slice(start))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(F.col("text").cast("string")).alias("text"))


def tallied(texts: DataFrame, least: float, known: np.ndarray | None, before: np.ndarray | None = None) -> DataFrame:
    """(hash, f) of what ``border`` gives, where f is ``least`` or more; hash 0 has the number of words."""
    sent = texts.sparkSession.sparkContext.broadcast((known, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, then = sent.value
        for words in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([len(words.ids)])], ["hash", "f"])
            for h in border(words, now, then):
                found, f = pa.array(h.view("i8")).value_counts().flatten()
                yield pa.RecordBatch.from_arrays([found, f], ["hash", "f"])

    found = texts.mapInArrow(run, "hash long, f long")
    return found.groupBy("hash").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("hash") == 0))


def counts(texts: DataFrame, least: int, wanted: np.ndarray, known: np.ndarray | None, before: np.ndarray | None) -> DataFrame:
    """(lang, phrase, f) of what ``exact`` gives, where f is ``least`` or more; f of the empty phrase is the number of words."""
    sent = texts.sparkSession.sparkContext.broadcast((wanted, known, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _chunks(batches):
            n = np.bincount(words.lang, minlength=len(words.langs))
            yield pa.RecordBatch.from_arrays([words.langs.cast(pa.string()), pa.array([""] * len(n)), pa.array(n)], ["lang", "phrase", "f"])
            for k, at, f in exact(words, *sent.value):
                langs = words.langs.take(pa.array(words.lang[at])).cast(pa.string())
                yield pa.RecordBatch.from_arrays([langs, words.phrases(k, at), pa.array(f)], ["lang", "phrase", "f"])

    found = texts.mapInArrow(run, "lang string, phrase string, f long")
    return found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))


def failures(tally: DataFrame, known: np.ndarray) -> DataFrame:
    """(hash, f) of frequent phrases that were not known and may be parts of others."""
    sent = tally.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy().view("u8")
            k = h & np.uint64(7)
            yield batch.filter(pa.array((k > 0) & (k < LONGEST) & ~_held(sent.value, h)))

    return tally.mapInArrow(run, "hash long, f long")


def bits_of(hashes: DataFrame, places: int = PLACES) -> np.ndarray:
    """The filter of some hashes: made in pieces by Spark, at most ``places`` bits in all."""
    place = F.col("hash").bitwiseAND(F.lit(places - 1)) + 1
    maps = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(max(places // 8, 4096), "u1")
    for row in maps.toLocalIterator():
        out[(row.bucket - 1) * 4096 : row.bucket * 4096] |= np.frombuffer(row.bits, "u1")
    return out[: places // 8]


def frequent_phrases(docs: DataFrame, least: int = LEAST, share: float = SHARE, places: int = PLACES, few: float = FEW) -> DataFrame:
    """(lang, phrase, f) of all phrases of 1 to 5 words with f of ``least`` or more, and of the empty phrase, exactly."""
    texts = _plain(docs)
    proposed = tallied(texts.sample(share, SEED), max(2, LOWERED * share * least), None)
    known, before, wanted = bits_of(proposed, places), None, np.uint8(0)
    while True:
        tally = materialise(tallied(texts, least, known, before), "phrase-hashes")
        wanted = wanted | bits_of(tally, places)
        failed = materialise(failures(tally, known), "border")
        seen, total = failed.agg(F.sum("f")).first()[0], tally.where("hash = 0").agg(F.sum("f")).first()[0]
        if seen is None:
            known = before = None  # closed: no border is left
            break
        known, before = known | bits_of(failed, places), known
        if seen <= few * total:
            break
    return materialise(counts(texts, least, wanted, known, before), "phrases")


# ranks are given in two steps, the first over so many parts of a language
PARTS = 64


def phrases(docs: DataFrame, least: int = LEAST, top: int = TOP, share: float = SHARE, places: int = PLACES, few: float = FEW) -> DataFrame:
    """Each language's collocations: lang, rank, phrase, a, l, r, n, score, as the contract of the query defines them.

    Needs ``lang`` and ``text``; other columns, whatever their names, are ignored. A null text is empty, a null
    language is ``und`` and one with rows of that name. Repeated rows count as often as they occur. A very long text is
    read in one go, at about fifteen times its size in memory. Ties in score and count are settled by the phrase, so ranks
    are the same in every run. A language without a phrase has no rows, nor has an empty table.
    """
    known = frequent_phrases(docs, least, share, places, few)
    f = known.where("phrase <> ''")
    total = known.where("phrase = ''").select("lang", F.col("f").alias("n"))
    many = f.where(F.instr("phrase", " ") > 0).select("lang", "phrase", F.col("f").alias("a"))
    # a longer phrase is at most as frequent, and so are all between: one word more tells
    parts = F.array(F.regexp_replace("phrase", " [^ ]*$", ""), F.regexp_replace("phrase", "^[^ ]* ", ""))
    inside = many.select("lang", F.explode(parts).alias("phrase"), "a")
    words = F.split("phrase", " ")

    def part(start, length):
        return F.concat_ws(" ", F.slice("words", start, length))

    cuts = (
        many.join(inside, ["lang", "phrase", "a"], "left_anti")
        .withColumn("words", words)
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1)))
        .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.size("words") - F.col("k")).alias("right"))
    )
    cut = (
        cuts.join(f.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(f.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(total, "lang")
    )
    # counts of up to 18 digits: no product overflows
    score = F.expr("(CAST(1000 * a AS DECIMAL(19,0)) * CAST(n AS DECIMAL(18,0))) DIV (CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))")
    worst = cut.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = scored.withColumn("part", salt).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    best = some.where(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return best.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
