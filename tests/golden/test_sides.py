"""Shifts and chains of recordings whose sides are held in one row."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessitura import plans
from tessitura.operators import timejoins


def plain_shift(left, right, low, high, step, tolerance):
    hits = Counter()
    for g, t in set(left):
        if g is not None:
            hits.update({k for k in range(low // step, high // step + 1) if any(h == g and abs(u - t - k * step) <= tolerance for h, u in right)})
    return max(((n, k * step) for k, n in hits.items()), default=None)


def recordings(seed, n):
    r = random.Random(seed)
    side = lambda: [(r.choice(["a", "b", "of the", None, "é"]), float(r.randrange(60))) for _ in range(r.randrange(40))]
    return [(k if k else None, side(), side()) for k in range(n)]


def test_shifts_of_sides_by_brute_force(spark, monkeypatch):
    rows = recordings(7, 40)
    df = spark.createDataFrame(rows, "slug int, left array<struct<g:string,t:double>>, right array<struct<g:string,t:double>>")
    got = {r.slug: (r.hits, r["shift"]) for r in timejoins.best_shift_of_sides(df, "slug", -20, 20, 2, 1.0).collect()}
    want = {k: plain_shift(a, b, -20, 20, 2, 1.0) for k, a, b in rows if k is not None}
    assert got == {k: v for k, v in want.items() if v}
    flat = [df.select("slug", F.explode(s).alias("x")).select("slug", F.col("x.g").alias("gram"), F.col("x.t").alias("at")) for s in ("left", "right")]
    again = {r.slug: (r.hits, r["shift"]) for r in timejoins.best_shift(*flat, "slug", "gram", "at", -20, 20, 2, 1.0).collect()}
    assert again == got


def test_distances_in_parts_are_those_in_one(monkeypatch):
    import numpy as np

    r = np.random.default_rng(3)
    sides = [timejoins._distinct(r.integers(0, 3, 300), r.integers(0, 500, 300).astype(float)) for _ in range(2)]
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(timejoins, "PAIRS", size)
        parts = list(timejoins._deltas(*sides[0], *sides[1], -50, 50))
        got = sorted((int(i), float(d)) for a, b in parts for i, d in zip(a, b, strict=True))
        assert got == sorted((i, u - t) for i, (c, t) in enumerate(zip(*sides[0], strict=True)) for h, u in zip(*sides[1], strict=True) if c == h and -50 <= u - t <= 50)
        assert timejoins._voted(iter(parts), 2, 1.0, -25, 25) == timejoins._voted(timejoins._deltas(*sides[0], *sides[1], -50, 50), 2, 1.0, -25, 25)


def test_chain_of_sides_is_that_of_anchors(spark):
    rows = [(k, [x for x in a if x[0]], [x for x in b if x[0]]) for k, a, b in recordings(11, 30) if k]
    r = random.Random(5)
    rows = [(k, a + [(f"w{i}", float(i)) for i in range(20)], b + [(f"w{i}", float(r.randrange(30))) for i in range(20)]) for k, a, b in rows]
    df = spark.createDataFrame(rows, "slug int, left array<struct<g:string,t:double>>, right array<struct<g:string,t:double>>")
    flat = [df.select("slug", F.explode(s).alias("x")).select("slug", F.col("x.g").alias("gram"), F.col("x.t").alias("at")) for s in ("left", "right")]
    want = timejoins.longest_chain(timejoins.unique_anchors(*flat, "slug", "gram", "at"), "slug").select("slug", "left_at", "right_at")
    assert sorted(timejoins.chain_of_sides(df, "slug").collect()) == sorted(want.collect())


@pytest.mark.parametrize("name", ["j9_best_shift", "j9_fine_shift"])
def test_shifts_shuffle_no_grams(spark, sf_dir, name):
    assert "Exchange" not in plans.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_chain_shuffles_no_grams(spark, sf_dir):
    assert "Exchange" not in plans.QUERIES["j2_longest_chain"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
