"""Token counts of documents in flat token files without an index.

A file is a row of token ids in which an end-of-document id closes each document. It is cut into
blocks of equal size that tasks search on their own, whatever documents lie across their borders. A
prefix scan over what the blocks report (how many separators, where the last one is) gives each block
the number of documents before it and the start of the document it opens with. The scan has two
levels, blocks in groups and groups in a file, so that no task holds more than one group's blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from listenlake.llm.columns import text_of
from listenlake.llm.files import opened
from listenlake.llm.tokenizer import END_OF_TEXT_ID, encoder
from listenlake.operators.durable import materialise, scratch_path

BLOCK_TOKENS = 1 << 20
GROUP_BLOCKS = 1024


def write_token_files(docs: DataFrame, folder: str, ranks_path: str | None = None) -> DataFrame:
    """Write all texts as files of unsigned 16-bit ids; returns (file, ordinal, doc_id) of what went where.

    A task writes one file under a name of its own; what a failed or repeated attempt leaves behind is in no
    row of the result. The mark's text inside a document is ordinary text, so the closing id
    occurs nowhere else. A null text is an empty document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(ranks_path, special=False).encode, np.array([END_OF_TEXT_ID], "<u2").tobytes()
        system, path = opened(folder)
        system.create_dir(path, recursive=True)
        name, ordinal, file = f"{uuid.uuid4().hex}.bin", 0, None
        try:
            for batch in batches:
                file = file or system.open_output_stream(f"{path}/{name}")
                for text in batch.column(1):
                    file.write(np.frombuffer(encode(text.as_py()), "<u4").astype("<u2").tobytes() + end)
                n = len(batch)
                at = pa.array(np.arange(ordinal, ordinal + n))
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), at, batch.column(0)], ["file", "ordinal", "doc_id"])
                ordinal += n
        finally:
            if file:
                file.close()

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return materialise(plain.mapInArrow(run, "file string, ordinal long, doc_id long"), "token-rows")


def _separators(blocks: DataFrame, folder: str, block: int, separator: int, kind: str) -> DataFrame:
    """Places of the separators in each block: absolute, in tokens."""
    width = np.dtype(kind).itemsize

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = opened(folder)
        for batch in batches:
            for name, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{path}/{name}") as file:
                    file.seek(k * block * width)
                    data = file.read(block * width)
                ids = np.frombuffer(data, kind, len(data) // width)
                found = np.flatnonzero(ids == separator) + k * block
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([k]), pa.array([found.astype(np.int64)], pa.list_(pa.int64()))],
                    ["file", "block", "at"],
                )

    return blocks.mapInArrow(run, "file string, block long, at array<long>")


def count_tokens(
    spark, folder: str, separator: int = END_OF_TEXT_ID, block: int = BLOCK_TOKENS, kind: str = "<u2"
) -> DataFrame:
    """Documents of all files in ``folder``: file, ordinal, start, n_tokens, closed.

    ``start`` is the place of the first token in its file and ``n_tokens`` leaves out the separator. Two
    separators in a row are an empty document. Tokens after the last separator are a document that isn't
    closed. Empty files and folders have no documents; bytes that make no whole id at a file's end are ignored.
    """
    width = np.dtype(kind).itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select(
        F.element_at(F.split("path", "/"), -1).alias("file"), F.floor(F.col("length") / width).alias("tokens")
    ).where("tokens > 0")
    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / block))).alias("block"))
    # dealt by name and number, as one large file may hold most blocks
    dealt = blocks.repartition(F.col("file"), F.col("block"))
    found = materialise(_separators(dealt, folder, block, separator, kind), "separators")
    brief = found.select(
        "file", "block", F.floor(F.col("block") / GROUP_BLOCKS).alias("group"),
        F.size("at").cast("long").alias("n"), F.array_max("at").alias("last"),
    )
    before = (Window.unboundedPreceding, -1)
    groups = brief.groupBy("file", "group").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    over = Window.partitionBy("file").orderBy("group").rowsBetween(*before)
    groups = groups.select("file", "group", F.sum("n").over(over).alias("group_n"), F.max("last").over(over).alias("group_last"))
    within = Window.partitionBy("file", "group").orderBy("block").rowsBetween(*before)
    scan = brief.select("file", "group", "block", F.sum("n").over(within).alias("in_n"), F.max("last").over(within).alias("in_last"))
    carry = scan.join(groups, ["file", "group"]).select(
        "file", "block",
        (F.coalesce("group_n", F.lit(0)) + F.coalesce("in_n", F.lit(0))).alias("documents"),
        F.coalesce("in_last", "group_last", F.lit(-1)).alias("previous"),
    )
    starts = F.concat(F.array(F.col("previous") + 1), F.transform("at", lambda x: x + 1))
    # each separator closes what began after the one before it; the last start is closed by a later block
    spans = F.posexplode(F.arrays_zip(F.col("at").alias("end"), starts.alias("start"))).alias("k", "span")
    rows = found.join(carry, ["file", "block"]).select("file", "documents", spans).where("span.end IS NOT NULL")
    closed = rows.select(
        "file", (F.col("documents") + F.col("k")).alias("ordinal"), "span.start",
        (F.col("span.end") - F.col("span.start")).alias("n_tokens"), F.lit(True).alias("closed"),
    )
    ends = brief.groupBy("file").agg(F.sum("n").alias("ordinal"), (F.coalesce(F.max("last"), F.lit(-1)) + 1).alias("start"))
    open_ = files.join(ends, "file").where("tokens > start").select(
        "file", "ordinal", "start", (F.col("tokens") - F.col("start")).alias("n_tokens"), F.lit(False).alias("closed")
    )
    return closed.unionByName(open_)


def document_tokens(docs: DataFrame) -> DataFrame:
    """Tokens of every row of ``docs``, by way of flat files: doc_id, n_tokens, file, ordinal, start.

    Needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. Null ids and repeated rows
    are documents of their own. An empty table gives no rows.
    """
    folder = scratch_path(docs.sparkSession, "tokens")
    rows = write_token_files(docs, folder)
    if rows.isEmpty():
        return rows.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "file", "ordinal", F.lit(0).cast("long").alias("start"))
    counts = count_tokens(docs.sparkSession, folder)
    return rows.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
