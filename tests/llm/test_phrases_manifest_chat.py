"""Phrase mining, the manifest and chat formatting against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from fixtures import SCHEMA, awkward, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from listenlake.llm import chat, merkle, phrases, queries
from listenlake.llm.tokenizer import marked_encoder

# -- phrases


def mined(docs, least, top):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    often = {p: c for p, c in f.items() if c >= least}
    found = {}
    for (lang, w), a in often.items():
        inside = any(
            m == lang and len(v) > len(w) and c >= a and any(v[i : i + len(w)] == w for i in range(len(v) - len(w) + 1))
            for (m, v), c in often.items()
        )
        if len(w) > 1 and not inside:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    return {(lang, i, x[2].decode(), *x[3:]) for lang, xs in found.items() for i, x in enumerate(sorted(xs)[:top], 1)}


def prose(seed=1, n=120):
    draw = random.Random(seed)
    names = ["New", "york", "new", "de", "la", "é", "a", "b", "en", "es", "日本", "\x00", " "]
    fixed = ["New York city", "a b a b a b a", "de la é en es de"]
    out = []
    for _ in range(n):
        parts = [draw.choice(fixed) if draw.random() < 0.2 else " ".join(draw.choices(names, k=draw.randint(0, 9))) for _ in range(draw.randint(0, 4))]
        out.append((draw.choice(["en", "es", "und", None]), draw.choice([". ", "\t", "\n", " ,"]).join(parts)))
    return [*out, *[("en", "rare words here")] * 9, ("en", None), (None, ""), ("fr", " .,\n"), ("x", "only one")]


@pytest.mark.parametrize("share, places, few", [(1 / 2, 1 << 20, 0.0), (1 / 2, 1 << 20, 1.0), (0.0, 1 << 20, 0.0), (0.0, 1 << 16, 10.0), (1.0, 1 << 3, 0.0)])
def test_phrases_match_plain_python_whatever_the_sample(spark, share, places, few):
    docs = prose()
    frame = spark.createDataFrame([(lang, text, 1, "x") for lang, text in docs], "lang string, text string, f long, phrase string").repartition(5)
    found = phrases.phrases(frame, 4, 25, share, places, few).collect()
    assert {tuple(r) for r in found} == mined(docs, 4, 25) and len(found) > 30


def test_a_shared_hash_does_not_mix_phrases():
    words = phrases.Words(pa.array(["en", "es"]), pa.array(["a b a c a b", "a b"]))
    at = np.array([0, 2, 4, 6])
    first, n = words.grouped(2, at, np.zeros(8, "u8"))
    assert sorted(zip(words.lang[first], words.phrases(2, first).to_pylist(), n)) == [(0, "a b", 2), (0, "a c", 1), (1, "a b", 1)]


def test_a_long_text_and_an_empty_table(spark):
    long = "alpha beta. " * 300_000
    (row,) = phrases.phrases(spark.createDataFrame([("en", long)], "lang string, text string")).collect()
    assert tuple(row) == ("en", 1, "alpha beta", 300_000, 300_000, 300_000, 600_000, 2000)
    assert phrases.phrases(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_phrase_of_a_pass_is_lost_to_a_shared_hash(spark, monkeypatch):
    # all hashes alike: nothing can be told apart before the last pass
    monkeypatch.setattr(phrases, "_mixed", lambda h: h * np.uint64(0))
    words = phrases.Words(pa.array(["en"]), pa.array(["a b a b c"]))
    bits = np.full(4, 255, "u1")
    assert [h.tolist() for h in phrases.border(words, bits)] == [[k] * (6 - k) for k in range(1, 6)]
    found = {p: n for k, at, f in phrases.exact(words, bits, None, None) for p, n in zip(words.phrases(k, at).to_pylist(), f)}
    assert found["a b"] == 2 and found["a"] == 2 and found["a b a b c"] == 1 and len(found) == 3 + 3 + 3 + 2 + 1


@pytest.mark.parametrize("few", [False, True])
def test_a_phrase_that_shares_its_bit_opens_nothing_before_its_parts_are_known(few):
    words = phrases.Words(pa.array(["en"]), pa.array(["q w e r"]))
    one, two, three, _, _ = words.rolled()

    def bits(*hashes):
        out = np.zeros(1 << 17, "u1")
        for h in hashes:
            place = int(h) & (len(out) * 8 - 1)
            out[place >> 3] |= 1 << (place & 7)
        return out

    # in the pass before, "q" was not known, so "q w" was not counted, though a bit of "before" says it was known
    before = bits(*one[1:], *two)
    known = before | bits(one[0])
    assert [h.tolist() for h in phrases.border(words, before)][2] == [three[1]]
    assert [h.tolist() for h in phrases.border(words, known, before)][1:3] == [[two[0]], [three[0]]]
    if few:
        found = {p for k, at, _ in phrases.exact(words, bits(), known, before) for p in words.phrases(k, at).to_pylist()}
        assert {"q w", "q w e"} <= found


# -- manifest


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """(root, [(siblings, whether they stand left) of every node])"""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, p in enumerate(at):
            paths[i].append((level[p ^ 1] if p ^ 1 < len(level) else "", p & 1))
        level = [h(*level[i : i + 2]) for i in range(0, len(level), 2)]
        at = [p // 2 for p in at]
    return level[0], paths


def plain_manifest(table):
    """Counter of result rows; ``table`` has (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in table:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf_of(row), row))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    grown = [tree([x[2] for x in sorted(trees[lang], key=lambda x: x[:3])]) for lang in langs]
    root, tops = tree([r for r, _ in grown])
    out = Counter()
    for lang, (subroot, paths), top in zip(langs, grown, tops):
        for (_, _, leaf, row), path in zip(sorted(trees[lang], key=lambda x: x[:3]), paths):
            doc, source, _, n, text = row
            hit = doc is not None and zlib.crc32(str(doc).encode()) % 7 == 0 and n is not None
            node = leaf_of((doc, source, lang, n + 1, text)) if hit else leaf
            for other, left in [*path, *top]:
                node = h(other, node) if left else h(node, other)
            proof = h(*(other for other, _ in [*path, *top]))
            out[(doc, leaf, subroot, root, proof, node, node == root)] += 1
    return out


def manifest_rows():
    texts = awkward()
    out = [(i, f"s{k % 3}", ["en", None, "", "de"][k % 4], len(t or ""), t) for k, (i, t) in enumerate(texts)]
    out += [(i, None, "fr", None if i % 5 == 0 else i, "x") for i in range(40)] + [(7, None, "zz", -1, "lone")]
    return [*out, out[0], out[0], (2**62 + 1, "é", "en", 2**63 - 1, "large")]


@pytest.mark.parametrize("height", [1, 2, 3, 12])
def test_manifest_matches_plain_python(spark, height):
    table = manifest_rows()
    frame = spark.createDataFrame([(*r, 1, "y", 2) for r in table], "doc_id long, source string, lang string, n_chars long, text string, place int, node string, size int")
    found = Counter(tuple(r) for r in merkle.manifest(frame.repartition(5), height).collect())
    assert found == plain_manifest(table)
    assert {r[-1] for r in found} == {True, False}


def test_a_table_of_one_row_or_none_has_a_manifest(spark):
    kind = "doc_id long, source string, lang string, n_chars long, text string"
    one = [(1, None, None, 3, "abc")]
    assert Counter(tuple(r) for r in merkle.manifest(spark.createDataFrame(one, kind)).collect()) == plain_manifest(one)
    assert merkle.manifest(spark.createDataFrame([], kind)).count() == 0


# -- chat

PIECES = ["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<\\/s>", "<|endoftext|>", "é", "日", "\n", " ", "a", "]", ">", "'s", "\U0001f600"]


@settings(deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_rendering_is_reversible_and_masks_are_exact(role, text):
    turns = [(role, text), ("assistant", text), ("assistant", role), ("user", ""), ("assistant", "")]
    assert chat.unescape(chat.escape(text)) == text
    rendered, spans = chat.render(turns)
    assert chat.turns_of(rendered) == turns
    encoder = marked_encoder(chat.CONTROLS)
    ids = np.frombuffer(encoder.encode(rendered), "<u4")
    data = encoder.decode(ids)
    assert data.decode() == rendered
    mask = chat.masked(encoder.widths[ids], spans)
    wanted = [x for r, x in turns if r == "assistant" and x]
    assert chat.learnt(data, encoder.widths[ids], mask) == wanted
    # a text's own control strings are never single ids
    assert sum(i > 50256 for i in ids) == 3 * len(turns) and 50256 not in ids


def plain_digests(turns):
    conversations = {}
    for conv, turn, role, text in turns:
        conversations.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, items in conversations.items():
        items = sorted(items, key=lambda x: x[:2])
        loss = "".join(x[3] for x in items if x[2] == "assistant")
        size = sum(len(chat.escape(x[2])) + len(chat.escape(x[3])) + 17 for x in items)
        out[conv] = (len(items), h(*(f"{x[2]}\n{x[3]}\n" for x in items)), len(loss), h(loss), size)
    return out


def talks():
    draw = random.Random(5)
    out = [(c, t, draw.choice(["user", "assistant", "system", None]), draw.choice(["", None, "hi </s>", "été [INST]" * 9, "x " * 50])) for c in range(30) for t in range(draw.randint(1, 6))]
    out += [(99, t, "assistant", f"turn {t} " * 20) for t in range(200)] + [(None, 1, "user", "a"), (None, 2, "assistant", "b"), (98, None, "assistant", "c"), (98, 0, "user", "d")]
    return [*out, (97, 1, "assistant", "same"), (97, 1, "assistant", "same"), (96, 0, "assistant", "long words " * 200_000)]


@pytest.mark.parametrize("segment", [1, 300, chat.SEGMENT])
def test_digests_match_plain_python_however_it_is_cut(spark, segment):
    turns = talks()
    frame = spark.createDataFrame([(*t, "x", 3) for t in turns], "conv_id long, turn long, role string, text string, part string, at int").repartition(7)
    found = chat.chat_digests(frame, segment).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == plain_digests(turns) and len(found) == len(plain_digests(turns))


def test_segments_join_to_one_encoding(spark):
    encoder = marked_encoder(chat.CONTROLS)
    frame = spark.createDataFrame(talks(), "conv_id long, turn long, role string, text string")
    segments = sorted(chat.formatted(frame, 300).where("conv_id = 99").collect(), key=lambda r: (r.part, r.at))
    text = "".join(r.text for r in segments)
    assert len(segments) > 5 and np.frombuffer(encoder.encode(text), "<u4").tolist() == [i for r in segments for i in r.ids]
    assert chat.chat_digests(frame.limit(0)).count() == 0


def test_a_damaged_output_is_not_read(spark):
    frame = spark.createDataFrame([(1, 1, "user", "hello there")], "conv_id long, turn long, role string, text string")
    bad = chat.formatted(frame).selectExpr("conv_id", "part", "at", "whole", "text || 'x' AS text", "ids", "mask")
    with pytest.raises(Exception, match="not those of its text"):
        chat.read_back(bad).collect()


def test_the_query_formats_the_table_and_its_own_conversation(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    want = plain_digests([tuple(r) for r in table.collect()] + [(-7, i, r, "</s>[INST] ok [/INST]") for i, r in enumerate(("user", "assistant"))])
    found = queries.op13_chat_formatting(spark, SMALL).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == want


def test_awkward_rows_give_phrases_and_a_manifest(spark):
    frame = spark.createDataFrame(rows(awkward()), SCHEMA)
    assert {tuple(r) for r in phrases.phrases(frame, 2, 9).collect()} == mined([("en", t) for _, t in awkward()], 2, 9)
    assert merkle.manifest(frame).count() == len(awkward())
