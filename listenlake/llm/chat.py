"""Chat formatting: whole conversations as text and ids, with a loss mask that is aligned by offsets.

A conversation is rendered with control strings round its turns and encoded once. The encoder's ids have known
widths, so their running sum gives each token's span of bytes; the spans of the turns are known from rendering.
Both are sorted, so binary search finds the tokens of the assistant's turns.

Control strings are single ids to the encoder and end whatever it was merging, so no token crosses the border
of a turn, and a conversation may be rendered in segments of whole turns. That is how one with very
many turns is spread: rows are range-partitioned by conversation and turn, and each task renders the turns
it has. What a control string would be inside a text is escaped, and unescaped when the output is read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listenlake.llm.tokenizer import marked_encoder

# The control strings of the template, and the role whose turns are learnt.
ROLE, TEXT, END = "[INST]", "[/INST]", "</s>"
CONTROLS = (ROLE, TEXT, END)
LEARNT = "assistant"
# code points after which a segment ends with its turn, and which are handed on together
SEGMENT, BATCH = 1 << 18, 1 << 21

# What could be read as a control string of this or the vocabulary's own kind, with any number of backslashes after
# its first character: rendering adds one, reading takes one away.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|\|endoftext\|>)")
_TURN = re.compile(r"\[INST\](.*?)\[/INST\](.*?)</s>", re.DOTALL)


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of some turns, and the spans of its UTF-8 bytes that are learnt, in order."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{ROLE}{escape(role)}{TEXT}", escape(text)
        start = at + len(head.encode())
        at = start + len(body.encode())
        if role == LEARNT:
            spans.append((start, at))
        parts += head, body, END
        at += len(END)
    return "".join(parts), spans


def masked(widths: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens, each ``widths`` bytes long, have a byte in one of the sorted ``spans``."""
    ends = np.cumsum(widths)
    out = np.zeros(len(ends), bool)
    if spans:
        begun, done = np.array(spans).T
        # an empty span has no token
        for a, b in zip(np.searchsorted(ends, begun, "right"), np.searchsorted(ends - widths, done, "left")):
            out[a:b] = True
    return out


FORMATTED = "conv_id long, part int, at long, whole boolean, text string, ids array<int>, mask array<boolean>"
READ = """conv_id long, part int, at long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string,
    formatted_chars long, turns string, loss string"""
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
_TYPES |= {"array<int>": pa.list_(pa.int32()), "array<boolean>": pa.list_(pa.bool_())}


def _batch(rows: list[tuple], kind: str) -> pa.RecordBatch:
    names, types = zip(*map(str.split, kind.split(",")))
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[t]) for c, t in zip(columns, types)], list(names))


def _values(column: pa.Array) -> list:
    """Python values; lists as arrays."""
    if pa.types.is_list(column.type):
        return [x.values.to_numpy(zero_copy_only=False) for x in column]
    return column.to_pylist()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows, of which a few at a time are Python objects."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            yield from zip(*map(_values, batch.slice(start, 64).columns))


def _batches(rows: Iterator[tuple[tuple, int]], kind: str) -> Iterator[pa.RecordBatch]:
    """Rows, each with its weight in code points, gathered to about ``BATCH``."""
    held, weight = [], 0
    for row, size in rows:
        held.append(row)
        weight += size + 100
        if weight >= BATCH:
            yield _batch(held, kind)
            held, weight = [], 0
    if held:
        yield _batch(held, kind)


def formatted(conversations: DataFrame, segment: int = SEGMENT, ranks_path: str | None = None) -> DataFrame:
    """Conversations rendered and encoded: (conv_id, part, at, whole, text, ids, mask), the turns in order.

    Needs ``conv_id, turn, role, text``; other columns, whatever their names, are ignored. Turns come in order of
    ``turn``, a null one first; rows of one turn in order of a hash of role and text. A null role or text is an
    empty one. Rows without ``conv_id`` are one conversation. A conversation is one row, unless it runs over ``segment``
    code points or over the border of a partition: then it has several, in order of ``part`` and ``at``, and their
    texts, ids and masks are to be joined. ``whole`` is true where it is known to have one row. An empty
    table gives no rows.
    """

    def segments(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        encoder, part = marked_encoder(CONTROLS, ranks_path), TaskContext.get().partitionId()
        turns, size, conv, at, alone = [], 0, None, 0, False

        def close(whole: bool) -> tuple[tuple, int]:
            text, spans = render(turns)
            ids = np.frombuffer(encoder.encode(text), "<u4").astype("i4")
            return (conv, part, at, whole, text, ids, masked(encoder.widths[ids], spans)), len(text)

        for other, role, text in rows:
            if turns and (other != conv or size >= segment):
                yield close(alone and other != conv)
                # the first conversation of a partition may have begun in the one before
                alone = other != conv
                turns, size, at = [], 0, at + 1
            conv = other
            turns.append((role or "", text or ""))
            size += len(turns[-1][0]) + len(turns[-1][1])
        if turns:
            yield close(False)

    plain = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    ).withColumn("tie", F.xxhash64("role", "text"))
    place = ["conv_id", "turn", "tie"]
    # the id of an input row lets many repeated rows be split
    dealt = plain.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*place, "row")
    ordered = dealt.sortWithinPartitions(*place, "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(lambda batches: _batches(segments(_rows(batches)), FORMATTED), FORMATTED)


def turns_of(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered text."""
    found = list(_TURN.finditer(text))
    if sum(m.end() - m.start() for m in found) != len(text):
        raise ValueError("a formatted conversation has text outside its turns")
    return [(unescape(m[1]), unescape(m[2])) for m in found]


def learnt(data: bytes, widths: np.ndarray, mask: np.ndarray) -> list[str]:
    """The text of each run of tokens under the mask, as it was before rendering."""
    ends = np.concatenate([[0], np.cumsum(widths)])
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype("i1"), [0]])))
    return [unescape(data[ends[a] : ends[b]].decode()) for a, b in zip(edges[::2], edges[1::2])]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def read_back(segments: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """Digests of what ``formatted`` made, from its output alone: ``DIGESTS``, a row per conversation.

    Ids are decoded and must give the text. Conversations of one row are digested where they are read. The
    digest of one that has several runs over their texts in order, as SHA-256 has to: these are streamed
    through one task a row at a time, which holds no more than that row.
    """

    def read(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        encoder = marked_encoder(CONTROLS, ranks_path)
        for conv, part, at, whole, text, ids, mask in rows:
            data = encoder.decode(ids)
            if data != text.encode():
                raise ValueError(f"the ids of conversation {conv} are not those of its text")
            turns = turns_of(text)
            said = "".join(f"{r}\n{t}\n" for r, t in turns)
            loss = "".join(learnt(data, encoder.widths[ids], mask))
            counts = len(loss), len(text)
            if whole:
                yield (conv, part, at, len(turns), _sha(said), counts[0], _sha(loss), counts[1], None, None), 0
            else:
                yield (conv, part, at, len(turns), None, counts[0], None, counts[1], said, loss), len(said) + len(loss)

    def stitch(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        conv, sums = None, None
        for other, _, _, n, turns_sha, loss_chars, loss_sha, chars, said, loss in rows:
            if sums and (other != conv):
                yield (conv, sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2]), 0
                sums = None
            if said is None:
                yield (other, n, turns_sha, loss_chars, loss_sha, chars), 0
                continue
            if not sums:
                conv, sums, hashes = other, [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
            sums = [a + b for a, b in zip(sums, (n, loss_chars, chars))]
            hashes[0].update(said.encode())
            hashes[1].update(loss.encode())
        if sums:
            yield (conv, sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2]), 0

    found = segments.mapInArrow(lambda batches: _batches(read(_rows(batches)), READ), READ)
    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at")
    return ordered.mapInArrow(lambda batches: _batches(stitch(_rows(batches)), DIGESTS), DIGESTS)


def chat_digests(conversations: DataFrame, segment: int = SEGMENT, ranks_path: str | None = None) -> DataFrame:
    """Format all conversations and read the output back: ``DIGESTS``, one row per conversation."""
    return read_back(formatted(conversations, segment, ranks_path), ranks_path)
