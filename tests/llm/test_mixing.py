import hashlib
from collections import defaultdict

import pytest

from tessitura.llm import queries
from tessitura.llm.mixing import fill_targets, mix, mixed

from ..oracle import compare

SCHEMA = "doc_id long, text string, source string, _cut int, whole string"


def test_targets():
    t = fill_targets([("b", 100), ("a", 10), (None, 100), ("c", 0)])
    assert t["a"] == 20 and t["c"] == 0 and t["b"] <= 200 and t[None] <= 200
    assert sum(t.values()) == pytest.approx(315)
    assert fill_targets([]) == {}
    assert fill_targets([("a", 0)]) == {"a": 0}


def test_edges(spark):
    rows = [(i, "w " * (i % 7), None if i % 3 == 0 else f"s{i % 3}", 1, "x") for i in range(300)]
    rows += [(None, "a b c", "s1", 2, "y"), (None, "a b c", "s1", 2, "y"), (7, "one", "s1", 1, ""), (400, None, "s9", 1, ""), (401, "", "s9", 1, ""), (402, "long " * 50_000, "s8", 1, "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size for r in got)
    assert sorted(map(str, mix(docs.repartition(7)).collect())) == sorted(map(str, got))
    out = mixed(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in got)
    assert mix(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0


def test_targets_are_met(spark, sf_dir):
    got = queries.QUERIES["op8_mixing"](spark, sf_dir).withColumnRenamed("copies", "c").collect()
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    taken, target, size = defaultdict(int), {}, defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s], size[s] = r.target, max(size[s], r.size)
        assert r.taken <= 2 * r.size
    assert all(abs(taken[s] - target[s]) <= size[s] / 2 + 1 for s in taken)
    assert abs(sum(taken.values()) - sum(target.values())) < 0.1 * sum(target.values())


def test_sql(spark, sf_dir):
    compare(spark, queries.QUERIES["op8_mixing"], queries.ORACLES["op8_mixing"], sf_dir)


def test_against_brute_force_pareto(spark):
    """Odds of inclusion that differ by document decide the order; without the division it would be another sample."""
    sizes = {i: 1 + (i * 37) % 90 for i in range(300)} | {300: 3000}
    docs = spark.createDataFrame([(i, "w " * n, "a", 0, "") for i, n in sizes.items()], SCHEMA)
    got = {r.doc_id: (r.copies, r.target) for r in mix(docs, budget=1.4).collect()}
    rest = got[0][1] - sum(sizes.values())
    n = sorted(sizes.values(), reverse=True)
    rates = ((t, (rest - sum(s for s in n if s > t)) / sum(s * s for s in n if s <= t)) for t in n)
    rate = next(c for t, c in rates if c * t < 1)  # larger ones are certain
    u = {i: (int(hashlib.md5(str(i).encode()).hexdigest()[:12], 16) + 0.5) / 2**48 for i in sizes}
    pi = {i: min(1.0, rate * n) for i, n in sizes.items()}
    assert len(set(pi.values())) > 50 and sum(pi[i] * n for i, n in sizes.items()) == pytest.approx(rest)

    def sample(odds):
        taken, words = set(), 0
        for i in sorted(sizes, key=odds):
            if words + sizes[i] / 2 <= rest:
                taken.add(i)
            words += sizes[i]
        return taken

    assert {i for i, (c, _) in got.items() if c == 2} == sample(lambda i: u[i] / (1 - u[i]) * (1 - pi[i]) / pi[i])
    assert {i for i, (c, _) in got.items() if c == 2} != sample(lambda i: u[i])


def test_inclusion_follows_size(spark):
    """Over many ids, twice the size is taken about twice as often."""
    docs = spark.createDataFrame([(i, "w " * (10 + 10 * (i % 2)), "a", 0, "") for i in range(6000)], SCHEMA)
    taken = defaultdict(int)
    for r in mix(docs, budget=1.3).collect():
        taken[r.size] += r.copies - 1
    assert 1.8 < taken[20] / taken[10] < 2.2
