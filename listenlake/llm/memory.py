"""A memory of computed values that is bounded and keeps what is asked for often, and what a worker keeps at all."""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession


class Memory(dict):
    """``memory[key]`` is ``compute(key)``; at most twice ``most`` values are held.

    When the young half is full it becomes the old half, whose values return to the young one as they are
    asked for; what is asked for rarely goes with the next change.
    """

    def __init__(self, compute: Callable[[Hashable], object], most: int, longest: int = 48):
        super().__init__()
        self.compute, self.most, self.longest, self.old = compute, most, longest, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


def give_back() -> None:
    """Return what nothing holds any more to the system, for what comes next in this process or beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()


_held: dict = {}


def held(kind: str, key: Hashable, make: Callable[[], object]):
    """``make()``, or what it gave when this worker was last asked for the same ``kind`` and ``key``.

    Worker processes live on from stage to stage. A worker keeps the things of one kind only, two at most, and
    gives back what an earlier stage of another kind has left.
    """
    if (kind, key) not in _held:
        if len(_held) >= 2 or any(other != kind for other, _ in _held):
            _held.clear()
        give_back()  # also what stages have left that keep nothing here
        _held[kind, key] = make()
    return _held[kind, key]


def let_go() -> None:
    """Give back what earlier stages have left in this worker, before one that keeps nothing there itself."""
    if _held:
        _held.clear()
        give_back()


AT_ONCE = 2_000_000  # bytes of texts


def slices(batch: pa.RecordBatch, texts: int, most: int = AT_ONCE) -> Iterator[pa.RecordBatch]:
    """The whole batch in parts whose column of texts holds ``most`` bytes each, or one text; an empty batch as it is.

    Spark bounds a batch by rows, so what is made of its texts at once would else grow with their length.
    """
    start, bytes_ = 0, 0
    for i, size in enumerate(pc.binary_length(batch.column(texts)).to_pylist()):
        if i > start and bytes_ + (size or 0) > most:
            yield batch.slice(start, i - start)
            start, bytes_ = i, 0
        bytes_ += size or 0
    yield batch.slice(start)


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, most: int = AT_ONCE) -> Iterator[None]:
    """Arrow batches of what runs meanwhile hold about ``most`` bytes, or one row, unless the session has set a bound itself.

    Else they are bounded by rows only: executor and worker each hold ten thousand texts at a time, or twice that
    while a buffer grows or the next batch is read.
    """
    own = spark.conf.get(BATCH_BYTES, None)
    if own is None:
        spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(BATCH_BYTES)
