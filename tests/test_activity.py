"""Sessions by bitmaps against a plain fold."""

import random

import pytest

from corpusloom.operators.activity import activity_sessions

GAP = 240 * 60_000_000
DDL = "sender string, t bigint"


def plain(events, gap):
    by, out = {}, []
    for e, t in events:
        if e is not None and t is not None:
            by.setdefault(e, []).append(t)
    for e, ts in by.items():
        ts.sort()
        run = [ts[0], ts[0], 1]
        for t in ts[1:]:
            if t - run[1] > gap:
                out.append((e, *run))
                run = [t, t, 1]
            else:
                run = [run[0], t, run[2] + 1]
        out.append((e, *run))
    return sorted(out)


def got(spark, events, gap=GAP):
    df = spark.createDataFrame(events, DDL)
    return sorted((r[0], r[1], r[2], r[3]) for r in activity_sessions(df, "sender", "t", gap).collect())


@pytest.mark.parametrize("seed", range(3))
def test_random_events(spark, seed):
    rng = random.Random(seed)
    minute = 60_000_000
    events = []
    for e in range(40):
        t = rng.randrange(-5, 5) * 1440 * minute
        for _ in range(rng.randrange(1, 60)):
            t += rng.choice([0, 1, GAP - 1, GAP, GAP + 1, GAP - minute, GAP + minute, rng.randrange(GAP // 2), rng.randrange(3 * GAP), 7 * 1440 * minute])
            events.append((f"e{e}", t))
    rng.shuffle(events)
    assert got(spark, events) == plain(events, GAP)


def test_exact_gap_and_borders(spark):
    day = 1440 * 60_000_000
    events = [("a", 0), ("a", GAP), ("a", 2 * GAP + 1), ("b", day - 1), ("b", day - 1 + GAP), ("c", -1), ("c", GAP - 1), ("d", 59_999_999), ("d", 59_999_999 + GAP), ("d", 60_000_000 + 2 * GAP)]
    assert got(spark, events) == plain(events, GAP)


def test_nulls_ties_and_empty(spark):
    events = [(None, 5), ("a", None), ("a", 7), ("a", 7), ("a", 7)]
    assert got(spark, events) == [("a", 7, 7, 3)]
    assert got(spark, []) == []


def test_other_columns_and_clashing_names(spark):
    df = spark.createDataFrame([("a", 1, "x", 9), ("a", 2, "y", 9)], "sender string, t bigint, entity string, tick int")
    assert [tuple(r) for r in activity_sessions(df, "sender", "t", GAP).collect()] == [("a", 1, 2, 2)]


def test_bad_gap(spark):
    with pytest.raises(ValueError):
        activity_sessions(spark.createDataFrame([], DDL), "sender", "t", 7)


def test_many_entities_cross_batches(spark):
    events = [(f"s{i}", i * 1000 + k * (GAP + (i % 3) - 1)) for i in range(6000) for k in range(3)]
    assert got(spark, events) == plain(events, GAP)
