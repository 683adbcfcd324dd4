import difflib
import re
from collections import defaultdict

from tessitura.operators import suspects
from tessitura.plans import QUERIES
from tessitura.plans.editing import _with_names

PAIR = re.compile(suspects.NAME_PAIR)


def test_surnames_against_all_pairs(spark, sf_dir):
    texts = {r.doc_id: " ".join(r.text.split()) for r in _with_names(spark, sf_dir).collect()}
    known = defaultdict(set)
    for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect():
        known[r.p_name.split(" ")[0]].add(r.p_name.split(" ")[-1])
    own = {r.text.split(" ")[0].lower() for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    want = defaultdict(list)
    for i, text in texts.items():
        for first, last in PAIR.findall(text):
            lasts, fb = known.get(first.lower(), ()), last.lower()
            if not lasts or fb in lasts or fb in own or (fb.endswith(("'s", "’s")) and fb[:-2] in lasts):
                continue
            r, right = max((difflib.SequenceMatcher(None, fb, x).ratio(), x) for x in lasts)
            if r >= 0.78 and abs(len(fb) - len(right)) <= 2:
                want[first, last, right.capitalize(), round(r, 6)].append(i)
    got = {(r["first"], r["last"], r["right"], round(r.ratio, 6)): r for r in QUERIES["n11_notable_names"](spark, sf_dir).collect()}
    assert set(got) == set(want) and want
    assert all(got[k].times == len(v) and got[k].texts == len(set(v)) for k, v in want.items())
    assert any(r.auto for r in got.values())


def test_surnames(spark):
    rows = [(1, "We saw Mark Rothco paint. Then Lee Krasnar, a painter, and Lee Krasner's cat."), (2, "Lee Krasnar left."), (3, "Lee _Krasnar_ again"), (4, "Ann Krasnar, artist"), (5, None)]
    known = spark.createDataFrame([("Mark", "Rothko"), ("Lee", "Krasner")], "first string, last string")
    own = spark.createDataFrame([("Nobody",)], "word string")
    df = spark.createDataFrame(rows, "k int, text string")
    got = {(r["first"], r["last"]): (r["right"], r.times, r.texts, r.auto, r.example) for r in suspects.notable_surnames(df, known, own, "k").collect()}
    assert set(got) == {("Mark", "Rothco"), ("Lee", "Krasnar")}
    assert got["Lee", "Krasnar"] == ("Krasner", 3, 3, False, "Lee Krasnar again")  # six of seven letters: 0.857
    assert got["Mark", "Rothco"][3] is False  # a common first name
    assert suspects.notable_surnames(df, known, spark.createDataFrame([("krasnar",)], "word string"), "k").count() == 1
    assert suspects.notable_surnames(df.limit(0), known, own, "k").count() == 0


def test_target_suspects(spark, sf_dir):
    found = QUERIES["n12_target_suspects"](spark, sf_dir).collect()
    by = {r.phrase: (r.tier, round(r.score, 3)) for r in found}
    score = lambda p: round(max(difflib.SequenceMatcher(None, re.sub("[^a-z]", "", p), t).ratio() for t in suspects.TARGETS), 3)
    assert {"text expressionism", "textpressionist", "text-spression", "text zebra"} <= set(by)
    assert not {"text message", "texture", "tex mex"} & set(by)
    assert all(s == score(p.lower()) and (t == "likely") == (s >= 0.62 or not re.search("[ -]", p)) for p, (t, s) in by.items())
    assert by["text zebra"][0] == "weak" and by["text expressionism"][0] == "likely"
