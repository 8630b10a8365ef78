"""The similarity join: its guarantees on sets, and all rows against a comparison of all pairs."""

import random
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, awkward, components, near_copies, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from listenlake.llm import components as cc
from listenlake.llm import jaccard as J


def some(draw: random.Random, n: int) -> set:
    return {draw.getrandbits(64) for _ in range(n)}


def arr(s: set) -> np.ndarray:
    return np.array(sorted(s), np.uint64)


def meet(a: set, b: set) -> bool:
    """Whether both share a key that one of them keeps, whatever keys each leaves out."""
    for kind, spare, keys in J.keys_of(arr(a)):
        for kind2, spare2, keys2 in J.keys_of(arr(b)):
            if kind == kind2 and len(set(keys) & set(keys2)) > min(spare, spare2):
                return True
    return False


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 900), st.floats(0, 1))
def test_similar_sets_always_share_a_key(seed, n, how):
    draw = random.Random(seed)
    a = some(draw, n)
    b = set(a)
    # as different as a link allows, by any mixture of lost and new shingles
    while True:
        c = set(b)
        if draw.random() < how:
            c.discard(draw.choice(sorted(c)))
        else:
            c.add(draw.getrandbits(64))
        if 100 * len(a & c) < 75 * len(a | c):
            break
        b = c
    assert meet(a, b)
    assert len(a ^ b) <= J.most_differences(len(a), len(b))


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 6))
def test_small_sets_always_share_a_key(seed, n):
    draw = random.Random(seed)
    a = some(draw, n)
    for extra in range(n // 3 + 1):
        b = a | some(draw, extra)
        if 100 * len(a & b) >= 75 * len(a | b):
            assert meet(a, b)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(0, 200), st.integers(0, 200))
def test_sketches_never_differ_in_more_bits_than_the_sets(seed, common, left, right):
    draw = random.Random(seed)
    shared = some(draw, common)
    a, b = shared | some(draw, left), shared | some(draw, right)
    x, y = J.sketch_of(arr(a)).view(np.uint64), J.sketch_of(arr(b)).view(np.uint64)
    assert int(np.bitwise_count(x ^ y).sum()) <= len(a ^ b)


def test_wide_sketches_fold(spark):
    draw = random.Random(8)
    shared = some(draw, 2000)
    sets = [shared | some(draw, n) for n in (10, 60, 300)] + [some(draw, 2040), some(draw, 1100)]
    data = [(i, len(s), J.wide_sketch_of(arr(s)).tolist()) for i, s in enumerate(sets)]
    one = spark.createDataFrame(data, "i int, n long, wide array<long>")
    two = one.selectExpr("i AS j", "n AS near_n", "wide AS near_wide")
    found = {(r.i, r.j) for r in one.join(two, one.i < two.j).where(J.wide_may_be_similar()).collect()}
    assert found == {(0, 1), (0, 2), (1, 2)}


def test_components_match_a_comparison_of_all_pairs(spark):
    texts = near_copies() + awkward() + [(900, "a b c d"), (901, "A  b C d"), (902, "a b c"), (903, "a b c d e")]
    found = J.near_groups(spark.createDataFrame(rows(texts), SCHEMA).repartition(5))
    assert Counter(map(tuple, found.collect())) == Counter(components(texts))


def test_dropping_keeps_the_smallest_id_of_each_component(spark):
    texts = [x for x in near_copies(5) + awkward() if x[0] is not None]
    docs = spark.createDataFrame(rows(texts), SCHEMA)
    out = J.drop_near(docs)
    assert out.columns == docs.columns
    want = {c for i, n, c in components(texts) if n} | {i for i, n, _ in components(texts) if not n}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_an_empty_table_gives_no_rows(spark):
    assert J.near_groups(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_chains_and_stars(spark, seed):
    draw = random.Random(seed)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(-5, 3), (200, 201), (201, 200), (7, 7)]
    draw.shuffle(edges)
    found = {r.node: r.root for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: -5 for i in [-5, *range(41)]}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}
