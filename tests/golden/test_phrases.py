import random
import re

import pytest

from pyspark.sql import functions as F

from tessitura.operators.phrases import count_phrases, replace_phrases


def plain(text, phrases):
    """One substitution after another, in order."""
    for phrase, to, _, whole in sorted(phrases, key=lambda p: (p[2], p[0], p[1])):
        body = re.escape(phrase)
        text = re.sub(rf"(?i)(?<!\w){body}(?!\w)" if whole else f"(?i){body}", lambda m: to, text)  # noqa: B023
    return text


def run(spark, texts, phrases):
    t = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    p = spark.createDataFrame(phrases, "phrase string, replacement string, ord long, whole boolean")
    return [r.text for r in sorted(replace_phrases(t, p, "k").collect(), key=lambda r: r.k)], {r.phrase: (r.hits, r.texts) for r in count_phrases(t, p, "k").collect()}


def test_overlapping(spark):
    phrases = [("a b", "X", 1, True), ("b c", "Y", 0, True), ("a b c d", "Z", 2, False), ("c", "a b", 3, True), ("d e", "$1\\E", 4, False), ("X", "done deal", 5, True), ("deal", "d e", 6, False)]
    texts = ["a b c d e", "A B d e", "xa b, b c c", "", "a  b", "b c b c a b", "e d e d", "done", None]
    got, _ = run(spark, texts, phrases)
    assert got == [None if t is None else plain(t, phrases) for t in texts]


def test_random_against_ordered_substitution(spark):
    """Texts and dictionaries of few words, so that phrases overlap, nest, touch and feed each other."""
    rnd = random.Random(4)
    some = ["ab", "b", "abc", "ca", "B", "é"]
    for seed in range(3):
        phrases = list({p[0].lower(): p for p in ((" ".join(rnd.choice(some) for _ in range(rnd.randint(1, 4))), f"<{' '.join(rnd.choice(some) for _ in range(rnd.randint(0, 2)))}>", i, rnd.random() < 0.5) for i in range(14))}.values())
        texts = ["".join(rnd.choice(some) + rnd.choice([" ", " ", " ", ", ", "\n", "-"]) for _ in range(rnd.randint(0, 25))) for _ in range(60)]
        got, counts = run(spark, texts, phrases)
        assert got == [plain(t, phrases) for t in texts], seed
        for phrase, _, _, whole in phrases:
            body = rf"(?i)(?<!\w){re.escape(phrase)}(?!\w)" if whole else f"(?i){re.escape(phrase)}"
            found = [len(re.findall(body, t)) for t in texts]
            assert counts[phrase] == (sum(found), sum(n > 0 for n in found))


def test_edges(spark):
    t = spark.createDataFrame([(1, "one two", "x"), (1, "two", "y"), (None, "Two!", "z"), (2, None, "n"), (3, "", "e")], "k long, text string, phrase string")
    p = spark.createDataFrame([("two", "2"), ("two", "2"), (None, "n"), ("unheard of", "u"), ("one", None)], "phrase string, replacement string")
    got = replace_phrases(t, p, "k")
    assert got.columns == t.columns
    assert sorted((r.phrase, r.text) for r in got.collect()) == [("e", ""), ("n", None), ("x", "one 2"), ("y", "2"), ("z", "2!")]
    assert {r.phrase: (r.hits, r.texts) for r in count_phrases(t, p, "k").collect()} == {"two": (3, 3), "unheard of": (0, 0), "one": (1, 1)}
    assert sorted(r.phrase for r in replace_phrases(t, p.limit(0), "k").collect()) == ["e", "n", "x", "y", "z"]
    assert replace_phrases(t.limit(0), p, "k").count() == 0
    with pytest.raises(ValueError):
        replace_phrases(t, spark.createDataFrame([("--", "-")], "phrase string, replacement string"), "k")


def test_only_the_dictionarys_words_are_kept(spark):
    import glob

    from tessitura.functions.tables import shared_dir

    folder = shared_dir(spark).removeprefix("file:")
    known = set(glob.glob(f"{folder}/words-*"))
    texts = spark.createDataFrame([(1, "the old cat sat there"), (2, "a Cat, catlike"), (3, None)], "id long, text string")
    whole = spark.createDataFrame([("cat", "dog", True), ("old dog", "pup", True), ("bird", "owl", True)], "phrase string, replacement string, whole boolean")
    from tessitura.operators.phrases import replace_phrases

    assert sorted(map(tuple, replace_phrases(texts, whole.withColumn("ord", (F.col("phrase") != "cat").cast("long")), "id").collect())) == [(1, "the pup sat there"), (2, "a dog, catlike"), (3, None)]
    (made,) = set(glob.glob(f"{folder}/words-*")) - known
    assert {r.v for r in spark.read.parquet(made).collect()} == {"old", "cat"}


def test_fillers_by_their_first_letter(spark):
    from tessitura.operators import clean

    said = ["uh", "UM", "Uh,", "um..", "uh-huh", "umm", "hum", "Ühm", "u", "", ",um", "sum", "UH"]
    rows = spark.createDataFrame([(x, f"So {x} we go") for x in said], "x string, text string")
    found = {r.x: (r.a, r.b) for r in rows.select("x", clean._is_filler(F.col("x")).alias("a"), clean.remove_fillers(F.col("text")).alias("b")).collect()}
    assert {x for x, (a, _) in found.items() if a} == {"uh", "UM", "UH"}
    assert {x for x, (_, b) in found.items() if x and x not in b} == {"uh", "UM", "Uh,", "um..", "UH"}
