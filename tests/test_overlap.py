"""Overlapping spans and counts by level against brute force."""

import random
from collections import Counter
from datetime import datetime, timedelta
from itertools import combinations

import pytest

from lakeproof.operators.overlap import overlaps
from lakeproof.operators.split import counts_by_level

T0 = datetime(2024, 3, 30, 20)


def spans(rng, n, tag):
    out = []
    for i in range(n):
        start = T0 + timedelta(seconds=rng.randrange(-4000, 200_000), microseconds=rng.choice([0, 0, 1, 999_999]))
        length = rng.choice([0, 0, 1, 60, 3599, 3600, 3601, 7200, 86_400, 10 ** 6, 10 ** 8])
        out.append((rng.choice([1, 1, 1, 2, None]), f"{tag}{i}", start, start + timedelta(seconds=length)))
    return out + [out[0], (1, f"{tag}x", None, T0), (1, f"{tag}y", T0, None), (1, f"{tag}z", T0, T0 - timedelta(seconds=1)),
                  (1, f"{tag}old", datetime(1960, 1, 1), datetime(1969, 12, 31, 23, 59, 59))]


@pytest.mark.parametrize("bin_seconds", [1, 3600, 10 ** 6])
def test_overlaps_are_each_found_once(spark, bin_seconds):
    rng = random.Random(bin_seconds)
    a, b = spans(rng, 60, "a"), spans(rng, 50, "b")
    ok = [[r for r in side if None not in r and r[3] >= r[2]] for side in (a, b)]
    want = Counter((*x, *y[1:], (min(x[3], y[3]) - max(x[2], y[2])).total_seconds())
                   for x in ok[0] for y in ok[1] if x[0] == y[0] and max(x[2], y[2]) <= min(x[3], y[3]))
    left = spark.createDataFrame(a, "k int, a string, a_from timestamp_ntz, a_to timestamp_ntz")
    right = spark.createDataFrame(b, "k int, b string, b_from timestamp_ntz, b_to timestamp_ntz")
    found = overlaps(left, right, "k", ("a_from", "a_to"), ("b_from", "b_to"), bin_seconds)
    assert Counter(tuple(r) for r in found.collect()) == want and len(want) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert overlaps(left, right.limit(0), "k", ("a_from", "a_to"), ("b_from", "b_to")).count() == 0


def test_clashing_columns_are_refused(spark):
    df = spark.createDataFrame([], "k int, f timestamp, t timestamp")
    with pytest.raises(ValueError, match="both sides"):
        overlaps(df, df, "k", ("f", "t"), ("f", "t"))


def test_counts_by_level(spark):
    rows = [("r", None, "x")] * 3 + [("r", "e", "x"), (None, "e", "y"), (None, None, None)] * 2
    want = Counter()
    for keep in (c for n in range(4) for c in combinations(range(3), n)):
        level = sum(4 >> i for i in range(3) if i not in keep)
        want.update((*(r[i] if i in keep else None for i in range(3)), level) for r in rows)
    df = spark.createDataFrame(rows, "a string, b string, c string")
    for least in (1, 4):
        got = counts_by_level(df, ["a", "b", "c"], least).collect()
        assert {tuple(r) for r in got} == {(*k, n) for k, n in want.items() if n >= least}
        assert len(got) == sum(n >= least for n in want.values())
