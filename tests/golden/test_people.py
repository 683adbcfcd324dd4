import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessitura.operators import metadata, people, voices


def test_nearest_length(spark):
    rnd = random.Random(1)
    files = [(rnd.randint(0, 2), f, float(rnd.randint(0, 60))) for f in range(60)]
    recordings = [(rnd.randint(0, 3), r, float(rnd.randint(1, 70))) for r in range(60)]
    want = {}
    for g, r, s in recordings:
        near = min(((abs(s - x), f) for h, f, x in files if h == g and abs(s - x) <= 0.15 * s), default=None)
        if near:
            want[r] = near
    f, r = spark.createDataFrame([*files, (0, 99, None)], "g int, file int, seconds double"), spark.createDataFrame([*recordings, (0, 99, None)], "g int, recording int, seconds double")
    found = metadata.match_by_length(f, r, "g")
    assert {x.recording: (x.gap, x.file) for x in found.collect()} == want
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert metadata.match_by_length(f.limit(0), r, "g").count() == 0


def test_preferred_length(spark):
    files = spark.createDataFrame([(1, "a", 100.0, 2), (1, "b", 103.0, 1), (1, "c", 103.1, 0), (2, "d", 100.0, 0)], "g int, file string, seconds double, preference int")
    found = metadata.match_by_preference(files, spark.createDataFrame([(1, 7, 100.0), (2, 8, 50.0)], "g int, recording int, seconds double"), "g").collect()
    assert [(r.recording, r.file) for r in found] == [(7, "b")]


def test_persons(spark):
    """A chain over many steps, a person with a key of all, nulls, and names that are only alike."""
    rows = [(i, f"k{i // 2}", f"h{(i + 1) // 2}", None, i) for i in range(40)] + [(100 + i, None, None, "hub", -i) for i in range(30)]
    rows += [(200, None, None, None, 1), (201, "", None, None, 5), (202, "", None, None, 6)]
    df = spark.createDataFrame(rows, "id int, name string, handle string, site string, at int").withColumn("surname", F.when(F.col("id") < 202, "Lee"))
    got = {r.id: (r.person, r.survivor, r.possible) for r in people.identities(df, "id", ["name", "handle", "site"], "at", F.col("surname"), F.lit("Ann")).collect()}
    assert {got[i] for i in range(40)} == {(0, 39, 3)} and {got[100 + i] for i in range(30)} == {(100, 100, 3)}
    assert got[200] == (200, 200, 3) and got[201] == (201, 202, 3) and got[202] == (201, 202, 0)
    assert people.identities(df.limit(0), "id", ["name"], "at", F.col("surname"), F.lit("A")).count() == 0


def test_tiers(spark):
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "y"), (4, "c", None)], "l int, name string, site string")
    right = spark.createDataFrame([(10, "a", "z", 1), (11, "a", "x", 2), (12, "q", "x", 9), (13, None, "y", 0)], "r int, name string, site string, at int")
    got = {r.l: (r.r, r.tier) for r in people.match_by_tiers(left, right, "l", "r", [["name"], ["site"]], "at").collect()}
    assert got == {1: (11, 1), 2: (12, 2), 3: (13, 2)}


def plain_voices(vectors):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in vectors}
    label = {i: x for i, _, x in vectors}
    sums = {x: sum(unit[i] for i in label if label[i] == x) for x in set(label.values()) - {None}}
    count = {x: sum(v == x for v in label.values()) for x in sums}
    sims = {}
    for i in unit:
        for x, s in sums.items():
            if label[i] != x or count[x] > 1:
                c = s - unit[i] if label[i] == x else s
                sims[i, x] = float(unit[i] @ c / np.linalg.norm(c))
    return sims, label


def test_voices(spark):
    """Two voices well apart, one that is mixed; in blocks of two centroids and groups of few vectors."""
    rng = np.random.default_rng(5)
    centre = {"a": [9, 0, 0, 0], "b": [0, 9, 0, 0], "c": [0, 0, 1, 1], "d": [0, 0, 1, 1.2], "e": [1, 1, 1, 1]}
    vectors = [(i, (np.array(centre[x], float) + rng.normal(0, 0.3, 4)).tolist(), x) for i, x in enumerate(list("abcd") * 8 + ["e"])] + [(90, [5.0, 0.1, 0.0, 0.0], None)]
    df = spark.createDataFrame([*vectors, (91, None, "a"), (92, [0.0] * 4, "a"), (93, [1.0, None, 0.0, 0.0], "a")], "id int, v array<double>, who string")
    sims, label = plain_voices(vectors)
    found = {r.id: r for r in voices.voice_match(df, "id", "v", "who", group=7, block=2).collect()}
    assert set(found) == set(label)
    for i, r in found.items():
        ranked = sorted(((-s, x) for (j, x), s in sims.items() if j == i))
        assert r.best == ranked[0][1] and abs(r.similarity + ranked[0][0]) < 1e-9
        assert r.matched == (-ranked[0][0] >= 0.5 and ranked[1][0] - ranked[0][0] >= 0.05)
    own = {r.who: r for r in voices.voice_thresholds(df, "id", "v", "who", group=7, block=2).collect()}
    assert set(own) == set("abcd") and own["a"].threshold and own["b"].threshold and own["c"].threshold is None is own["d"].threshold
    for x, r in own.items():
        low, high = min(s for (i, y), s in sims.items() if y == x == label[i]), max(s for (i, y), s in sims.items() if y == x != label[i] is not None)
        assert abs(r.lowest - low) < 1e-9 and abs(r.others - high) < 1e-9
    assert {i for i, r in {r.id: r for r in voices.voice_match(df, "id", "v", "who", threshold=None).collect()}.items() if r.matched} <= {i for i, x in label.items() if x in ("a", "b", None)}
    assert "NestedLoop" not in voices.voice_match(df, "id", "v", "who")._jdf.queryExecution().executedPlan().toString()
    assert voices.voice_match(df.limit(0), "id", "v", "who").count() == 0
    with pytest.raises(ValueError):
        voices.voice_match(df.union(spark.createDataFrame([(99, [1.0], "a")], df.schema)), "id", "v", "who")
