"""Token ids, counts by separator scan, and packing."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from fixtures import SCHEMA, awkward, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from listenlake.llm.packing import Packing, evolve, packed
from listenlake.llm.tokenizer import encoder
from listenlake.llm.tokens import count_tokens, document_tokens

WHOLE = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
PARTS = ["a", "b's", " ", "  ", "\n", "\t", "é", "日本", "12", "<|endoftext|>", ".", "\x1c", " ", "x" * 60]


def ids(text):
    return WHOLE.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(encoder().encode(text), "<u4").tolist() == ids(text)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_separators_are_found_across_blocks(spark, tmp_path, block):
    files = {"a.bin": [1, 2, 0, 0, 3, 0, 4, 5, 6, 7, 8, 9, 10, 0], "b.bin": [0], "c.bin": [1, 2, 3], "d.bin": [], "e.bin": [5, 0, 6]}
    for name, data in files.items():
        (tmp_path / name).write_bytes(np.array(data, "<u2").tobytes() + b"\x01" * (name == "e.bin"))
    want = []
    for name, data in files.items():
        start = ordinal = 0
        for i, x in enumerate(data):
            if x == 0:
                want.append((name, ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < len(data):
            want.append((name, ordinal, start, len(data) - start, False))
    found = count_tokens(spark, str(tmp_path), separator=0, block=block)
    assert sorted(map(tuple, found.select("file", "ordinal", "start", "n_tokens", "closed").collect())) == sorted(want)


def test_counts_of_awkward_documents(spark):
    texts = awkward() + [(30, "the mark <|endoftext|> is text here")]
    plain = encoder(None, False)
    want = Counter((i, len(plain.encode(t or "")) // 4) for i, t in texts)
    found = document_tokens(spark.createDataFrame(rows(texts), SCHEMA).repartition(3))
    assert Counter((r.doc_id, r.n_tokens) for r in found.collect()) == want
    assert document_tokens(spark.createDataFrame([], SCHEMA)).count() == 0


def check_packing(found, texts, capacity):
    by_sequence, pieces = defaultdict(list), Counter()
    for r in found:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    want = Counter()
    for doc, text in texts:
        x = [*ids(text or ""), 0]
        start, end = 0, (len(x) - 1) % capacity + 1
        piece = 0
        while start < len(x):
            data = np.array(x[start:end], "<u4").tobytes()
            want[(doc, piece, start, end - start, zlib.crc32(data))] += 1
            start, end, piece = end, end + capacity, piece + 1
    assert pieces == want
    return len(by_sequence)


def test_every_piece_has_its_place(spark):
    texts = awkward() + [(i, "word " * (7 * i % 900)) for i in range(100, 160)]
    found = packed(spark.createDataFrame(rows(texts), SCHEMA)).collect()
    n = check_packing(found, texts, 2048)
    assert n <= -(-sum(len(ids(t or "")) + 1 for _, t in texts) // 2048) + 1
    assert packed(spark.createDataFrame([], SCHEMA)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=60), st.integers(0, 99))
def test_evolution_keeps_every_item_and_never_loses_to_best_fit(sizes, seed):
    plain = Packing(sizes, 100)
    plain.insert(sorted(range(len(sizes)), key=lambda i: -sizes[i]))
    best = evolve(sizes, 100, seed, [])
    assert sorted(i for b in best.bins for i in b) == list(range(len(sizes)))
    assert max(best.fills()) <= 100 and len(best.bins) <= len(plain.bins)
    assert evolve(sizes, 100, seed, [best.bins]).fitness() >= best.fitness()
