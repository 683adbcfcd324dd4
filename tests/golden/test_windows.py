"""Windows are made for what may begin a name only, and none is lost by that."""

import difflib
import random
import re

from pyspark.sql import functions as F

from tessitura.operators import name_fixes, names

ODD = ["red", "Red,", "(red", "'rod'", "--", "…", "ábc", "Ábc.", "İzmir", "ΣΑΣ", "_x", "7up", "x-ray", "ring!", "hot", "\"hot\"", "r.", "é", "ét", "#", "bolt", "«Réd»"]


def odd_texts():
    rng = random.Random(11)
    texts = [(i, rng.choice([" ", "  ", "\n", " "]).join(rng.choices(ODD, k=rng.randrange(1, 40)))) for i in range(80)]
    return [*texts, (80, ""), (81, None), (82, "  "), (83, "-- red rod")]


def test_windows_by_first_letters(spark):
    d = spark.createDataFrame(odd_texts(), "id int, text string")
    begin = {1: ["i", "i̇", "σ"], 2: ["r", "á", "e"]}
    made = names.token_windows(d, ["id"], [1, 2], begin=begin)
    every = names.token_windows(d, ["id"], [1, 2])
    assert made.count() < every.count() * 0.6
    fits = F.lower(F.left("matched", F.lit(1)))
    fits = ((F.col("n") == 1) & fits.isin(*begin[1])) | ((F.col("n") == 2) & fits.isin(*begin[2]))
    assert sorted(map(tuple, made.where(fits).collect())) == sorted(map(tuple, every.where(fits).collect())) != []


def test_own_windows_by_first_letters(spark):
    own = F.when(F.col("id") % 2 == 0, F.array(F.lit("2 r"), F.lit("1 σ")))  # none for the others
    d = spark.createDataFrame(odd_texts(), "id int, text string").withColumn("own", own)
    made = {(r.id, r.idx, r.n, r.heard) for r in name_fixes._windows(d, ["id"], [1, 2], "text", "own", {1: ["h", "i"]}).collect()}
    wanted, every = set(), 0
    for i, text in odd_texts():
        t = re.findall(r"\S+", text or "")
        for n in (1, 2):
            for at in range(len(t) - n + 1):
                if n == 2 and re.search(r"[.!?]$", t[at]):
                    continue
                every += 1
                heard = re.sub(r"^[^\ẃ]+|[^\ẃ]+$", "", " ".join(t[at : at + n])).lower()
                if heard and (heard[0] in {1: "hi", 2: ""}[n] or i % 2 == 0 and (n, heard[0]) in ((2, "r"), (1, "σ"))):
                    wanted.add((i, at, n, heard))
    assert len(wanted) > 20 and wanted <= made and len(made) < every * 0.6
    assert {x for x in made - wanted} <= {(i, at, n, heard) for i, at, n, heard in made if re.match(r"[^\w\s]+(\s|$)", re.findall(r"\S+", dict(odd_texts())[i])[at])}


def test_name_candidates_by_brute_force(spark):
    pool = ["red rod", "hot ring", "Réd bolt", "x", "ring ring ring"]
    d = spark.createDataFrame(odd_texts(), "id int, text string")
    got = {(r.id, r.name): (r.matched, r.idx, round(r.ratio, 9)) for r in names.name_candidates(d, spark.createDataFrame([(x,) for x in pool], "name string"), ["id"], 0.6).collect()}
    want = {}
    for r in names.token_windows(d, ["id"], [1, 2, 3]).collect():
        for name in pool:
            a, b = r.matched.lower(), name.lower()
            if r.matched and len(name.split(" ")) == r.n and a[0] == b[0] and a != b:
                ratio = round(difflib.SequenceMatcher(None, a, b).ratio(), 9)
                if ratio >= 0.6:
                    old = want.get((r.id, name))
                    want[r.id, name] = min([x for x in (old, (r.matched, r.idx, ratio)) if x], key=lambda x: (-x[2], x[1]))
    assert got == want and len(got) > 20


def test_letters_of_similar_words_differ_in_few_bits(spark):
    """The bits are those of the letters' kinds, and pairs that reach the ratio are never ruled out by them; most others are."""
    from collections import Counter

    rng = random.Random(3)
    words = ["".join(rng.choices("abcdeghnorstuv'éñ丄𝒳 9", k=rng.randrange(1, 16))) for _ in range(60)]
    words += [w[:3] + w[2:] for w in words] + [w[:-1] + "q" for w in words] + ["sssssssss", "ssssss"]
    rows = spark.createDataFrame([(w,) for w in words], "w string").select("w", names._letter_bits(F.col("w")).alias("b")).collect()
    bits = {r.w: [x & (1 << 64) - 1 for x in r.b] for r in rows}
    for w, (low, high) in bits.items():
        kinds = Counter(ord(x) & 31 for x in w)
        assert low | high << 64 == sum(1 << 4 * k + j for k, n in kinds.items() for j in range(min(n, 4)))
    pairs = spark.createDataFrame([(a, b) for a in bits for b in bits], "a string, b string")
    left, right = (spark.createDataFrame([(w, len(w), *names_) for w, names_ in ((w, [x - (1 << 64) if x >> 63 else x for x in b]) for w, b in bits.items())], f"{c} string, _l{c} int, _{c}0 long, _{c}1 long") for c in "ab")
    kept = {(r.a, r.b) for r in pairs.join(left, "a").join(right, "b").where(names._letters_allow(F.col("_la"), F.col("_lb"), 0.8)).collect()}
    similar = {(a, b) for a in bits for b in bits if difflib.SequenceMatcher(None, a, b).ratio() >= 0.8}
    assert similar <= kept and len(kept) < len(bits) ** 2 / 20
