"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one on ordinary text, one that goes on with segments of toxic
text. Both have the same length and the same common part at the same distance, so a window that
neither explains compresses alike under both, and the difference of the two lengths is what the toxic
part explains. A window is one word with the spaces around it behind a fixed opening that both
dictionaries hold: short enough that a single word tells, and frequent enough to be remembered.

Calibrated thresholds turn the lengths into a score: each window falls into a class by the bytes saved
and by the share of the word that they make; how often each class occurs in the text, and for what
part of its windows, feeds a logistic model fitted to the same labelled sample.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of
from listenlake.llm.memory import Memory, give_back, held

OPENING = b" the of and to  the of and to "
PUNCTUATION = bytes(range(33, 48)) + b":;<=>?@[\\]^_`{|}~"
LEVEL = 13
COMMON_BYTES, TOXIC_BYTES = 4096, 4096
MOST_SAVED = 8
SHARES = (0.25, 0.4, 0.55, 0.7)
CLASSES = (MOST_SAVED + 1) * (len(SHARES) + 1)
REMEMBERED = 200_000


@dataclass(frozen=True)
class Model:
    """Dictionaries and weights; a model without weights scores every text with its share of toxic rows."""

    ordinary: bytes = b""
    toxic: bytes = b""
    segments: bytes = b""
    weights: tuple[float, ...] = ()
    share: float = 0.0


def words_of(text: str | None) -> list[bytes]:
    """White-space separated words, letters A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").lower().split()


class Windows(Memory):
    """Class of each word by the lengths of its window."""

    def __init__(self, model: Model):
        super().__init__(self.classed, REMEMBERED)
        self.compressors = [
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            ).compress
            for d in (model.ordinary, model.toxic)
        ]
        self.opening = len(self.compressors[0](OPENING))
        # a window without four bytes in a row of any toxic segment can't be explained by one
        self.parts = {model.segments[i : i + 4] for i in range(len(model.segments) - 3)}

    def classed(self, word: bytes) -> int:
        window, found = b" " + word.strip(PUNCTUATION) + b" ", 0
        parts = self.parts
        if any(window[i : i + 4] in parts for i in range(len(window) - 3)):
            ordinary, toxic = (len(f(OPENING + window)) for f in self.compressors)
            saved = min(max(ordinary - toxic, 0), MOST_SAVED)
            share = (ordinary - toxic) / max(ordinary - self.opening, 1)
            found = saved * (len(SHARES) + 1) + sum(share >= s for s in SHARES) * (saved >= 2)
        return found


def features(text: str | None, windows: Windows) -> np.ndarray:
    words = words_of(text)
    counts = np.zeros(CLASSES)
    for k, n in Counter(map(windows.__getitem__, words)).items():
        counts[k] = n
    grid = counts.reshape(MOST_SAVED + 1, len(SHARES) + 1)
    by_saved = grid[1:].sum(1)
    by_share = grid[2:, ::-1].sum(0).cumsum()[::-1][1:]
    seen = np.concatenate([by_saved, by_share])
    return np.concatenate([np.log1p(seen), np.sqrt(seen / max(len(words), 1)), [math.log1p(len(words))]])


def _ratio(k1: int, n1: int, k0: int, n0: int) -> float:
    """Log-likelihood ratio of a word's document rates in toxic and in ordinary rows."""

    def fit(k: int, n: int, p: float) -> float:
        return (k * math.log(p) if k else 0.0) + ((n - k) * math.log(1 - p) if n > k else 0.0)

    both = (k1 + k0) / (n1 + n0)
    return 2 * (fit(k1, n1, k1 / n1) + fit(k0, n0, k0 / n0) - fit(k1, n1, both) - fit(k0, n0, both))


def toxic_segments(inside: Counter, n1: int, outside: Counter, n0: int) -> list[bytes]:
    """Words that toxic rows hold far more often, the clearest first; given how many of ``n1`` toxic and ``n0`` ordinary rows hold them."""
    found = []
    for word, k in inside.items():
        if word and k >= 3 and k / n1 > 8 * outside[word] / n0:
            if (score := _ratio(k, n1, outside[word], n0)) > 20:
                found.append((-score, word))
    return [w for _, w in sorted(found)]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: they are the dictionary
        return b"".join(samples)[:size]


def fit(
    rows: list[tuple[str, int]], whole: tuple[int, int] | None = None, common_bytes: int = COMMON_BYTES, toxic_bytes: int = TOXIC_BYTES
) -> Model:
    """Train on (text, toxic) rows, drawn from ``whole`` ordinary and toxic ones.

    The common part of the dictionaries has up to ``common_bytes``, the toxic one the clearest segments in ``toxic_bytes``.

    Where the two are drawn in other proportions than they occur, scores are set right by the odds.
    """
    # rows that hold a word, and rows themselves, as ordinary [0] and toxic [1]
    held, n = (Counter(), Counter()), [0, 0]
    for text, toxic in rows:
        held[toxic].update({w.strip(PUNCTUATION) for w in words_of(text)})
        n[toxic] += 1
    all_ordinary, all_toxic = whole or n
    share = all_toxic / max(all_ordinary + all_toxic, 1)
    segments = toxic_segments(held[1], n[1], held[0], n[0]) if all(n) else []
    if not segments:
        return Model(share=share)
    del held
    samples = [b" ".join([b"", *words_of(text), b""]) for text, toxic in rows if not toxic]
    common = _dictionary(samples, common_bytes)
    # the clearest segments lie last, next to the opening
    part = b"".join(b" " + w + b" " for w in reversed(segments))[-toxic_bytes:]
    filler = b""
    for sample in samples:
        if len(filler) >= len(part):
            break
        filler += sample
    del samples
    filler = filler[: len(part)].ljust(len(part))
    model = Model(common + filler + OPENING, common + part + OPENING, part)
    windows = Windows(model)
    x = np.array([features(text, windows) for text, _ in rows])
    y = np.array([toxic for _, toxic in rows], float)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    x = np.c_[np.ones(len(x)), (x - mean) / spread]
    weights, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [3.0] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ weights))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (p - y) + ridge @ weights)
        weights -= step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))
    slopes = weights[1:] / spread
    drawn = math.log(n[1] / n[0])
    start = weights[0] - slopes @ mean + math.log(all_toxic / all_ordinary) - drawn
    return Model(model.ordinary, model.toxic, part, (start, *slopes), share)


def score(text: str | None, model: Model) -> float:
    if not model.weights:
        return model.share
    z = model.weights[0] + float(np.dot(features(text, held("windows", model, lambda: Windows(model))), model.weights[1:]))
    return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learnt from; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def train(
    docs: DataFrame,
    labels: DataFrame,
    most_toxic: int = 3000,
    most_ordinary: int = 6000,
    longest: int = 200_000,
) -> Model:
    """Fit on a bounded sample of the labelled rows that aren't held out.

    The sample holds ``most_toxic`` and ``most_ordinary`` rows at most, drawn by a hash of the id, and no
    text of over ``longest`` code points. A row with both labels counts as toxic; null labels are skipped.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("_toxic"))
    known = known.where(F.col("_toxic").isin(0, 1) & F.col("_id").isNotNull() & ~held_out("_id"))
    known = known.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    found = dict(known.groupBy("_toxic").count().collect())  # two rows at most
    drawn = [
        known.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(n)
        for y, n in ((1, most_toxic), (0, most_ordinary))
    ]
    # the sample has a fixed number of rows at most, so it may be broadcast and its texts be gathered
    plain = docs.select(F.col("doc_id").cast("long").alias("_id"), text_of("text").alias("_text"))
    texts = plain.where(F.length("_text") <= longest).join(F.broadcast(drawn[0].unionByName(drawn[1])), "_id")
    rows = texts.dropDuplicates(["_id"]).select("_id", "_text", "_toxic").toArrow().sort_by("_id")
    model = fit(list(zip(rows["_text"].to_pylist(), rows["_toxic"].to_pylist())), (found.get(0, 0), found.get(1, 0)))
    del rows
    give_back()
    return model


def scored(text: Column, model: Model) -> Column:
    """Score of a text in 0 to 1, from the whole text alone; a null counts as empty. Only the text goes to Python."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([score(x.as_py(), model) for x in texts], pa.float64())

    return run(text)


def toxicity(docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """Score every row of ``docs``: doc_id, held_out, score, predicted.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. Null and empty texts are
    scored as texts without words. Repeated rows get equal scores. Without toxic labels, or without
    other ones, nothing can be learnt and every row gets the share of toxic ones (0 with no labels at all).
    """
    model = train(docs, labels, **bounds)
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), scored(F.col("text"), model).alias("score"))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, with their columns, whatever their names."""
    return docs.where(scored(F.col("text"), train(docs, labels)) < limit)
