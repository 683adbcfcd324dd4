import zlib
from collections import Counter

import numpy as np

from tessitura.llm import queries
from tessitura.llm.language_id import BLOCK, Profiles, fit, identify, keep_known_languages, ngrams, predict_languages, train_profiles
from tessitura.llm.toxicity import Ftrl, features, labelled_sample, score_texts, toxicity
from tessitura.llm.toxicity import fit as fit_toxicity


def plain_ngrams(text):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    if not clean.strip():
        return Counter()
    grams = [clean[i : i + n] for n in (1, 2, 3) for i in range(len(clean) - n + 1)]
    return Counter(g for g in grams if g != " " and g[1:-1] != " " and not (len(g) == 2 and g == "  "))


def decode(key):
    parts = [key >> 42, key >> 21 & (1 << 21) - 1, key & (1 << 21) - 1]
    return "".join(chr(p) for p in parts if p)


def test_ngrams():
    for t in ("", "123 !", "a", "The cat, the CAT.", "Élan über alles; 東京 was there", "x" * 10, "a1b"):
        keys, counts = ngrams(t.encode())
        assert dict(zip(map(decode, keys.tolist()), counts.tolist(), strict=True)) == plain_ngrams(t)
    long = "héllo wörld " * (BLOCK // 8)
    keys, counts = ngrams(long.encode())
    assert dict(zip(map(decode, keys.tolist()), counts.tolist(), strict=True)) == plain_ngrams(long)


def test_profiles_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts: dict[str, Counter] = {}
    for r in docs.collect():
        if zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts.setdefault(r.lang, Counter()).update(plain_ngrams(r.text))
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    want = {(lang, code(g), k) for lang, c in counts.items() for k, (g, _) in enumerate(sorted(c.items(), key=lambda x: (-x[1], code(x[0])))[:400])}
    from tessitura.llm.common import crc32_id
    from pyspark.sql import functions as F

    got = train_profiles(docs.where(crc32_id(F.col("doc_id")) % 4 != 2)).collect()
    assert {(r.lang, r.gram, r.place) for r in got} == want


def test_language_accuracy(spark, sf_dir):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.QUERIES["op4_language_id"](spark, sf_dir).collect()
    assert len(got) == len(truth) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_language_edges(spark):
    rows = [(i, "the cat sat on the mat and the dog", "en", "x") for i in range(8)] + [(i, "der hund und die katze sind nicht da", "de", "x") for i in range(8, 16)]
    rows += [(20, None, "en", "n"), (21, "12 - !", None, "n"), (22, "the the", None, None), (None, "die katze", "de", "z"), (22, "the the", None, None), (23, "der hund " * 200_000, None, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = identify(docs).collect()
    pred = {r.doc_id: r.lang_pred for r in got}
    assert len(got) == len(rows) and pred[20] == pred[21] == "und" and pred[22] == "en" and pred[None] == "de" and pred[23] == "de"
    kept = keep_known_languages(docs)
    assert kept.columns == docs.columns and sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted([-1, *range(16), 22, 22, 23])
    none = docs.limit(0)
    assert identify(none).count() == 0 and keep_known_languages(none).count() == 0
    assert {r.lang_pred for r in predict_languages(docs, fit(none)).collect()} == {"und"}
    assert Profiles([]).predict(b"word") == ("und", 0.0)


def test_features():
    assert len(features(b"")) == 0
    assert set(features(b"Stupid, stupid.").tolist()) >= set(features(b"stupid").tolist())
    assert len(features(b"a b c")) == 3 + 2 + 1
    whole = features(b" ".join(b"w%d" % (i % 50) for i in range(600_000)))
    assert set(whole.tolist()) == set(features(b" ".join(b"w%d" % (i % 50) for i in range(200))).tolist())


def test_ftrl_separates():
    rng = np.random.default_rng(1)
    model = Ftrl(bits=10)
    for _ in range(400):
        y = int(rng.random() < 0.3)
        model.learn(np.unique(np.append(rng.integers(0, 900, 30), 950 if y else 951)), y)
    w = model.weights(np.arange(1025))
    assert w[950] > 1 and abs(w[:900]).max() < w[950]
    assert (w == 0).sum() > 800


def test_toxicity_held_out(spark):
    """Held-out accuracy over enough labels to learn from."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.QUERIES["op9_toxicity"](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert sum(p > y for p, y in held) <= 3


def test_toxicity_edges(spark):
    rows = [(i, f"some plain words about item {i % 7} here" + (" scum" if i % 4 == 0 else ""), "x") for i in range(400)]
    rows += [(900, None, "n"), (901, "", "n"), (None, "you scum", "n"), (902, "nice " * 300_000 + "scum", "l"), (902, "fine day", "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400)] + [(5, 1, None), (4, 0, 0), (None, 1, 1), (999, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r.predicted)
    assert len(got) == len(rows) and by[900] == by[901] == [0] and by[None] == [1] and sorted(by[902]) == [0, 1]
    assert by[0] == [1] and by[1] == [0]
    assert toxicity(docs.limit(0), labels).count() == 0
    none = fit_toxicity(labelled_sample(docs, labels.limit(0)))
    assert not none.any() and {r.score for r in score_texts(docs, none).collect()} == {0.5}


def plain_ftrl(rows, bits, alpha, beta, l1, l2, weight, epochs):
    """The update by the book, one coordinate at a time."""
    from math import exp, sqrt

    z, n = Counter(), Counter()

    def w(i):
        reach = 0 if i == 1 << bits else l1
        return 0.0 if abs(z[i]) <= reach else -(z[i] - (reach if z[i] > 0 else -reach)) / ((beta + sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for x, y in rows:
            x = [*x, 1 << bits]
            g = (1 / (1 + exp(-sum(w(i) for i in x))) - y) * (weight if y else 1.0)
            for i, wi in [(i, w(i)) for i in x]:
                z[i] += g - (sqrt(n[i] + g * g) - sqrt(n[i])) / alpha * wi
                n[i] += g * g
    return {i: w(i) for i in z if w(i)}


def test_ftrl_against_brute_force(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(3)
    rows = [(i, int(i % 3 == 0), sorted({int(x) for x in rng.integers(0, 200, 12)} | ({250} if i % 3 == 0 else {251}))) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, label int, features array<long>")
    order = [r.id for r in df.orderBy(F.xxhash64("id", F.lit(7)), "id").collect()]
    by_id = {i: (x, y) for i, y, x in rows}
    from tessitura.llm.toxicity import ALPHA, BETA, EPOCHS, L1, L2, MARKED_WEIGHT

    want = plain_ftrl([by_id[i] for i in order], 8, ALPHA, BETA, L1, L2, MARKED_WEIGHT, EPOCHS)
    got = fit_toxicity(df, bits=8)
    assert set(np.flatnonzero(got).tolist()) == set(want) and len(want) > 2
    assert all(abs(got[i] - w) < 1e-9 for i, w in want.items())


def test_features_are_bounded(spark):
    """Many rows of one id and long texts: the fit takes fewer rows, and still learns."""
    rows = [(5, i % 2, [i % 2, *range(10, 10 + i % 50)]) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, label int, features array<long>")
    w = fit_toxicity(df, bits=8, max_features=10_000)
    assert w[1] > 0 > w[0]


def test_predictions_against_brute_force(spark, sf_dir):
    """Each document's distance to each profile, place by place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = fit(docs)
    place = {lang: {} for lang in profiles.langs}
    for i, g in enumerate(profiles.grams.tolist()):
        for j, lang in enumerate(profiles.langs):
            if profiles.places[i, j] < 400:
                place[lang][decode(g)] = profiles.places[i, j]
    got = {r.doc_id: r for r in identify(docs).collect()}
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    for r in docs.orderBy("doc_id").limit(40).collect():
        top = sorted(plain_ngrams(r.text).items(), key=lambda x: (-x[1], code(x[0])))[:400]
        if not top:
            assert got[r.doc_id].lang_pred == "und"
            continue
        counts = [n for _, n in top]
        rank = {g: counts.index(n) + (counts.count(n) - 1) / 2 for g, n in top}
        away = {lang: sum(min(abs(p[g] - rank[g]), 400) if g in p else 400 for g in rank) for lang, p in place.items()}
        best = min(sorted(away), key=away.get)
        assert got[r.doc_id].lang_pred == best and abs(got[r.doc_id].score - (1 - away[best] / (400 * len(top)))) < 1e-9
