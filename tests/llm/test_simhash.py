import random

import pytest
import xxhash

from tessitura.llm import queries
from tessitura.llm.components import connected_components
from tessitura.llm.simhash import chain_budgets, drop_near_copies, fingerprint, similar_pairs, simhash_components


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint():
    for t in ("", " \n", "one", "A b", "a b c", "The cat sat on the mat. " * 50, "é ü\x0bx y z", None):
        assert fingerprint((t or "").encode()) == plain_fingerprint(t)
    assert fingerprint(b"a b c d " * 50_000) == plain_fingerprint("a b c d " * 50_000)


@pytest.mark.parametrize("hot", [4096, 2])
@pytest.mark.parametrize("segments", [4, 8, 16])
def test_pairs_lose_no_link(spark, hot, segments):
    rng = random.Random(segments)
    fps = {0, (1 << 64) - 1}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 3)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2]
    assert len(near) > 50
    found = similar_pairs(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), 2, segments, hot).collect()
    links = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in found]
    if hot > 100:
        assert {frozenset(x) for x in links} == {frozenset(x) for x in near}
    want, got = components(fps, near), components(fps, links)
    assert all((want[a] == want[b]) == (got[a] == got[b]) for a in fps for b in fps)


def test_chains():
    assert chain_budgets(8, 2) == [0, 0, 0, 1, 1, 1, 1, 2]


@pytest.mark.parametrize("kind", ["path", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(3)
    links = {"path": [(i, i + 1) for i in range(120)], "star": [(0, i) for i in range(1, 200)], "random": [(rng.randrange(150), rng.randrange(150)) for _ in range(100)], "none": [(1, 1)]}[kind]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    want = components(nodes, [(a, b) for a, b in links if a != b])
    assert set(got) == nodes
    assert all((want[a] == want[b]) == (got[a] == got[b]) for a in nodes for b in nodes)


def test_edges(spark):
    long = " ".join(f"word{i}" for i in range(400))
    rows = [(1, None, "a", 1), (2, "", "b", 2), (3, " \n\t", None, 3), (4, long, "x", 4), (5, long.upper(), "y", 5), (5, long.upper(), "y", 5), (None, long, "z", 6), (7, "two words", "z", 7), (8, long.replace("word7 ", "WORD7  "), "z", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root int")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash_components(docs).collect())
    assert got == [(-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (5, 4), (7, 7), (8, 4)]
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 7]
    none = docs.limit(0)
    assert simhash_components(none).count() == 0 and drop_near_copies(none).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    fp = {i: plain_fingerprint(t) for i, t in docs.items()}
    ids = sorted(docs)
    roots = components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if (fp[a] ^ fp[b]).bit_count() <= 2])
    least = {}
    for i in ids:
        least.setdefault(roots[i], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op10_simhash"](spark, sf_dir).collect()}
    assert got == {i: (f"{fp[i]:016x}", least[roots[i]]) for i in ids}


def test_near_dedup_hands_few_rows_at_a_time_to_python(spark, monkeypatch):
    from tessitura.llm import common, simhash

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen = spark.conf.get(key), []
    near = simhash.near_components
    monkeypatch.setattr(simhash, "near_components", lambda *a, **b: seen.append(spark.conf.get(key)) or near(*a, **b))
    docs = spark.createDataFrame([(i, "one two three four five six seven") for i in range(3)] + [(9, "other words")], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == [0, 9]
    assert seen == ["1000"] and spark.conf.get(key) == before
    with common.small_batches(spark, 7):
        rows = spark.range(0, 50, 1, 1).mapInArrow(lambda batches: batches, "id long")
        sizes = rows.mapInPandas(lambda parts: (p.head(1).assign(id=len(p)) for p in parts), "id long").collect()
    assert max(r.id for r in sizes) <= 7
