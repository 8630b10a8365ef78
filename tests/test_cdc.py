import random

import pytest
from pyspark.sql import functions as F

from listenlake.operators import cdc

EVENT = "k long, at long, v string, note string, tie long"


def random_events(seed, keys=12, n=400, span=60):
    rng = random.Random(seed)
    return [
        (rng.randint(1, keys), rng.randint(1, span), rng.choice("ab"), rng.choice("xyz"), i)
        for i in range(n)
    ]


def cut(events, seed, pieces=3):
    rng = random.Random(seed)
    out = [[] for _ in range(pieces)]
    for e in events:
        rng.choice(out).append(e)
    return out


def last_by_time(batches):
    """Newest event per (key, time): a later batch wins, then the higher tie."""
    best = {}
    for i, batch in enumerate(batches):
        for e in batch:
            rank = (i, e[4])
            if (e[0], e[1]) not in best or rank > best[e[0], e[1]][0]:
                best[e[0], e[1]] = (rank, e)
    return {key: e for key, (_, e) in best.items()}


def history(batches, tracked):
    """Versions as a plain loop over sorted events."""
    out, open_version, state = [], None, None
    for (k, at), e in sorted(last_by_time(batches).items()):
        if open_version and open_version[0] != k:
            out.append((*open_version, None))
            open_version = None
        now = tuple(e[i] for i in tracked)
        if open_version is None or now != state:
            if open_version:
                out.append((*open_version, at))
            open_version = (k, e[2], at)
        state = now
    if open_version:
        out.append((*open_version, None))
    return sorted(out, key=repr)


def run_history(spark, batches, except_cols, hot_rows):
    state = None
    for batch in batches:
        df = spark.createDataFrame(batch, EVENT)
        state = cdc.apply_history(state, df, ["k"], "at", ["tie"], except_cols, hot_rows)
    rows = cdc.versions(state).collect()
    return sorted(((r.k, r.v, r.start_at, r.end_at) for r in rows), key=repr)


@pytest.mark.parametrize("hot_rows", [cdc.HOT_ROWS, 0])
@pytest.mark.parametrize("keys", [1, 12])
def test_history_equals_a_loop_however_it_is_cut(spark, hot_rows, keys):
    events = random_events(5, keys=keys)
    for pieces in (1, 3):
        batches = cut(events, 6, pieces)
        got = run_history(spark, batches, ("at", "note", "tie"), hot_rows)
        assert got == history(batches, tracked=[2])


def test_every_time_opens_a_version_when_all_columns_are_tracked(spark):
    batches = cut(random_events(7), 8)
    got = run_history(spark, batches, (), cdc.HOT_ROWS)
    assert len(got) == len(last_by_time(batches))
    assert got == history(batches, tracked=[1, 2, 3, 4])


def test_a_late_event_splits_an_interval(spark):
    first = [(1, 10, "a", "x", 1), (1, 30, "a", "x", 2)]
    late = [(1, 20, "b", "x", 3)]
    got = run_history(spark, [first, late], ("at", "note", "tie"), cdc.HOT_ROWS)
    assert got == [(1, "a", 10, 20), (1, "a", 30, None), (1, "b", 20, 30)]


def test_keys_not_named_by_the_batch_are_left_alone(spark):
    first = [(1, 10, "a", "x", 1), (2, 10, "a", "x", 2)]
    state = cdc.apply_history(None, spark.createDataFrame(first, EVENT), ["k"], "at", ["tie"])
    again = spark.createDataFrame([(2, 11, "b", "x", 3)], EVENT)
    rows = cdc.apply_history(state, again, ["k"], "at", ["tie"]).orderBy("k", "at").collect()
    assert [(r.k, r.start_at, r.end_at) for r in rows] == [(1, 10, None), (2, 10, 11), (2, 11, None)]


def test_segments_agree_with_key_windows_for_two_key_columns(spark):
    rng = random.Random(11)
    rows = [
        (rng.randint(1, 3), rng.choice("pq"), rng.randint(1, 500), rng.choice("ab")) for _ in range(900)
    ]
    df = spark.createDataFrame(rows, "k1 long, k2 string, at long, v string").withColumn(
        "tie", F.monotonically_increasing_id()
    )
    results = []
    for hot in (cdc.HOT_ROWS, 0):
        out = cdc.apply_history(None, df, ["k1", "k2"], "at", ["tie"], ("at", "tie"), hot)
        results.append(sorted((tuple(r) for r in cdc.versions(out).collect()), key=repr))
    assert results[0] == results[1]


def test_latest_keeps_the_highest_sequence_and_the_source_on_ties(spark):
    first = spark.createDataFrame([(1, 10, "old", "x", 1), (2, 10, "old", "x", 2)], EVENT)
    second = spark.createDataFrame(
        [(1, 9, "late", "x", 3), (2, 10, "same time", "x", 0), (3, 1, "new", "x", 5)], EVENT
    )
    state = cdc.apply_latest(None, first, ["k"], "at", ["tie"])
    rows = cdc.apply_latest(state, second, ["k"], "at", ["tie"]).orderBy("k").collect()
    assert [(r.k, r.v) for r in rows] == [(1, "old"), (2, "same time"), (3, "new")]


def test_latest_equals_a_loop_however_it_is_cut(spark):
    batches = cut(random_events(9, n=600), 10, 4)
    state = None
    for batch in batches:
        state = cdc.apply_latest(state, spark.createDataFrame(batch, EVENT), ["k"], "at", ["tie"])
    want = {}
    for (k, at), e in sorted(last_by_time(batches).items()):
        want[k] = e
    assert sorted(tuple(r) for r in state.collect()) == sorted(want.values())
