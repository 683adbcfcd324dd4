import random

import numpy as np
import pytest

from tessitura.llm.near_copies import are_similar, join_sketch, near_components, parity_sketch, prefix_keys, shingle_set, sketches_differ
from tessitura.llm.simhash import drop_near_copies

from .test_simhash import components


def similarity(a, b):
    a, b = ({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.fixture(scope="module")
def planted():
    """Random texts, each with copies at several rates of changed words, and one passage that many hold."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    passage, made = [word() for _ in range(30)], []
    for n in (100, 300, 1000):
        for _ in range(6):
            base = [word() for _ in range(n)]
            made.append(base)
            for share in (0.01, 0.02, 0.04):
                copy = list(base)
                for i in rng.sample(range(n), int(n * share)):
                    copy[i] = word()
                made.append(copy)
    made += [passage + [word() for _ in range(40)] for _ in range(30)]
    rng.shuffle(made)
    return [" ".join(x) for x in made] + ["", " \n", "two words", "TWO  words"]


@pytest.mark.parametrize(("large", "block"), [(64, 2000), (2, 3)])
def test_stage_against_brute_force(spark, planted, large, block):
    ids = range(len(planted))
    links = [(a, b) for a in ids for b in range(a) if similarity(planted[a], planted[b]) >= 0.8]
    assert len(links) > 30
    roots, least = components(ids, links), {}
    for i in ids:
        least.setdefault(roots[i], i)
    docs = spark.createDataFrame(list(enumerate(planted)), "id long, text string")
    got = {r.id: r.component_id for r in near_components(docs, large=large, block=block).collect()}
    assert {i: got.get(i, i) for i in ids} == {i: least[roots[i]] for i in ids}
    if block == 2000:
        assert sorted(r.doc_id for r in drop_near_copies(docs.withColumnRenamed("id", "doc_id")).collect()) == sorted(least.values())


def test_given_documents_against_brute_force(spark, sf_dir):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    ids = sorted(docs)
    sets = {i: set(shingle_set(docs[i].encode()).tolist()) for i in ids}
    close = lambda a, b: 5 * len(a & b) >= 4 * len(a | b)
    roots, least = components(ids, [(a, b) for i, a in enumerate(ids) for b in ids[:i] if close(sets[a], sets[b])]), {}
    for i in ids:
        least.setdefault(roots[i], i)
    got = drop_near_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    assert sorted(r.doc_id for r in got.collect()) == sorted(least.values())


def test_filters_lose_no_similar_sets():
    """Sets about the very threshold share a key, whatever shingles are put last; sketches never tell too much."""
    rng = np.random.default_rng(1)
    draw = lambda n: np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) * np.uint64(2))
    for n in [*range(1, 60), 100, 250, 1000, 4000]:
        for _ in range(20 if n < 100 else 5):
            a = draw(n)
            gone, new = rng.integers(0, n // 5 + 2, 2)
            b = np.union1d(a[rng.permutation(len(a))[gone:]], draw(new) if new else a[:0])
            common = np.union1d(a, b)[rng.permutation(len(np.union1d(a, b)))[: n // 3]]
            assert sketches_differ(parity_sketch(a), parity_sketch(b)) <= len(np.setxor1d(a, b))
            assert sum(int(x).bit_count() for x in (join_sketch(a) ^ join_sketch(b)).view(np.uint64)) <= len(np.setxor1d(a, b))
            if len(b) and are_similar(a, b):
                assert len(np.intersect1d(prefix_keys(a, common), prefix_keys(b, common)))


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, " \n", None), (None, "a b c d e f", "n"), (5, "a b c d e f", "n"), (6, "A B c d e f", "n"), (7, "w " * 200_000, "l"), (8, "w " * 100_000, "l"), (9, "solo", None), (9, "solo again here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string").withColumnRenamed("id", "_gone")
    got = drop_near_copies(docs)
    assert got.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in got.collect()) == [-1, 1, 5, 7, 9, 9]
    assert drop_near_copies(docs.limit(0)).count() == 0


def test_fingerprints_find_candidates(spark, planted, monkeypatch):
    """The stage's first candidates are those of fingerprints over five words; what they miss is found all the same."""
    from tessitura.llm import simhash

    docs = spark.createDataFrame([*enumerate(planted), (len(planted), planted[0].upper()), (None, planted[0])], "id long, text string")
    fp = [simhash.fingerprint(t.encode(), 5) for t in [*planted, planted[0].upper()]]
    got = {(r.u, r.v) for r in simhash.fingerprint_candidates(docs).collect()}
    near = {(a, b) for b in range(len(fp)) for a in range(b) if (fp[a] ^ fp[b]).bit_count() <= 2}
    assert (0, len(planted)) in got and got <= near
    assert components(range(len(fp)), got) == components(range(len(fp)), near)
    given = []
    whole = simhash.near_components
    monkeypatch.setattr(simhash, "near_components", lambda rows, candidates: given.append({(r.u, r.v) for r in candidates.collect()}) or whole(rows, candidates=candidates))
    kept = {r.id for r in simhash.drop_near_copies(docs, "id").collect()}
    assert given == [got] and len(planted) not in kept and None in kept


def test_an_id_with_several_texts(spark):
    """Each text of an id is judged by itself: one of its own stays, though another of the same id is a copy; of an id's own near copies one stays."""
    rng = random.Random(2)
    a, b, c, d = (" ".join(f"w{rng.randrange(9999)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (7, a + " more"), (7, b), (2, c), (2, c + " more"), (3, d), (3, d), (4, d.upper()), (8, None), (8, ""), (9, "  "), (None, b), (None, "solo")]
    for more in (rows, rows[2:5] + rows[11:]):
        kept = sorted(((r.doc_id or -1, r.text) for r in drop_near_copies(spark.createDataFrame(more, "doc_id long, text string")).collect()), key=str)
        want = [x for x in more if x not in (rows[1], rows[3], rows[4], rows[7], rows[10])]
        twos = [t for i, t in kept if i == 2]
        assert len(twos) == 1 and twos[0] in (c, c + " more")
        assert [x for x in kept if x[0] != 2] == sorted(((i or -1, t) for i, t in want), key=str)
    alone = spark.createDataFrame([(5, a), (5, b), (6, c)], "doc_id long, text string")
    assert drop_near_copies(alone).count() == 3
    names = spark.createDataFrame([("x", a), ("y", b)], "doc_id string, text string")
    assert drop_near_copies(names).count() == 2
