"""What is looked at in the row of a text: loops, capitals, scripts; nothing of the texts is shuffled."""

import random
import time

from pyspark.sql import functions as F

from tessitura import plans
from tessitura.operators import attribution, clean, names, sentences
from tessitura.plans import files
from tessitura.sources import captions


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_loops_of_lists(spark, sf_dir, monkeypatch):
    pick = random.Random(7)
    texts = [(1, None), (2, []), (3, ["a"]), (4, ["a"] * 8), (5, ["a"] * 8), (6, ["", None] * 9), (7, ["a", ""] * 9), (8, ["b"] + ["a"] * 9)]
    texts += [(k, [pick.choice("ab")] * pick.randrange(12) + [pick.choice("abc") for _ in range(pick.randrange(4))] * pick.randrange(9)) for k in range(9, 150)]
    df = spark.createDataFrame(texts, "slug long, words array<string>").coalesce(1)
    wanted = sorted(attribution.loop_spans(df.select("slug", F.posexplode("words").alias("idx", "word"))).collect())
    assert len(wanted) > 30 and sorted(attribution.loop_spans_of_lists(df).collect()) == wanted
    assert "Exchange" not in plan(plans.QUERIES["t10_loops"](spark, sf_dir))


def capitals(text, ordinary):
    """Word by word, as the rule says."""
    t = text.split()
    bare = [x.strip(clean.AROUND) for x in t]
    core = [b if b and all(c.isascii() and c.isalpha() or c in "'’-" for c in b) else "" for b in bare]
    first = [i == 0 or t[i - 1].rstrip(clean.CLOSERS)[-1:] in tuple(".?!…:”\"") and t[i - 1].rstrip(clean.CLOSERS) != "" for i in range(len(t))]
    big = [c[:1].isupper() and c != "I" and not f for c, f in zip(core, first)]
    number = [sum(first[: i + 1]) for i in range(len(t))]
    for i, c in enumerate(core):
        near = any(big[j] and number[j] == number[i] for j in range(max(0, i - 3), min(len(t), i + 4)) if j != i)
        tail = c[1:]
        if big[i] and tail == tail.lower() and tail.strip("'’-") and core[i - 1] in clean.CONTINUERS and not near and c.lower() not in clean.KEEP_CAPITAL and c.lower() in ordinary:
            yield i, c, " ".join(t[max(0, i - 4) : i + 5])


def test_midsentence_capitals(spark, sf_dir):
    pick = random.Random(5)
    said = ["and", "the", "of", "House", "Tree", "house", "tree", "I", "end.", "end.”", "(House)", "A", "'s", "Zoom", "No:", "Étoile", "…", "to", "HOUSE", "And", "''"]
    texts = {k: " ".join(pick.choice(said) for _ in range(pick.randrange(25))) for k in range(400)} | {1000: None, 1001: "", 1002: " \n"}
    ordinary = ["house", "tree", "and", "a"]
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = clean.midsentence_capitals(df, spark.createDataFrame([(w,) for w in ordinary], "word string"), "doc_id", around=4)
    wanted = sorted((k, *row) for k, t in texts.items() for row in capitals(t or "", ordinary))
    assert len(wanted) > 30 and sorted(map(tuple, found.collect())) == wanted
    assert "Window" not in plan(plans.QUERIES["x15_midsentence_capitals"](spark, sf_dir))
    assert "_w" not in plan(plans.QUERIES["a7_capital_suspects"](spark, sf_dir))  # the texts' words are not joined again


def test_scripts_are_looked_up_for_few_characters(spark):
    plain = "[" + "".join(rf"\p{{Is{name}}}" for name in ("Hangul", "Han", "Hiragana", "Katakana", "Cyrillic", "Arabic", "Hebrew", "Thai")) + "]+"
    letters = spark.range(1, 0x110000).where("id < 55296 or id > 57343").select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    assert letters.where(F.col("c").rlike(plain)).count() > 50_000
    assert letters.where(F.col("c").rlike(plain) != F.col("c").rlike(clean.NON_LATIN)).count() == 0
    latin = spark.range(0, 400, 1, 2).select(F.repeat(F.concat(F.col("id").cast("string"), F.lit(" words of élan, und so weiter. ")), 1000).alias("text"))

    def seconds(pattern):
        times = []
        for _ in range(3):
            began = time.time()
            assert latin.where(F.col("text").rlike(pattern)).count() == 0
            times.append(time.time() - began)
        return min(times)

    assert seconds(clean.NON_LATIN) < 0.7 * seconds(plain)


def test_spread_words_cuts_a_text_once(spark, sf_dir):
    cues = spark.createDataFrame([("a", 0.0, "one two")], "slug string, start double, text string").withColumn("end", F.lit(None).cast("double"))
    found = sentences.spread_words(cues.union(cues.select("slug", "start", F.lit(None), "end")), ["slug"])
    assert [(r.idx, r.start, r.token) for r in found.orderBy("idx").collect()] == [(0, 0.0, "one"), (1, 0.5, "two")]
    above = plan(plans.QUERIES["w7_spread_words"](spark, sf_dir)).split("Generate")[0]
    assert "regexp_extract_all" not in above  # what stands above the generator is worked out for each word


def test_runs_are_not_cut_anew_by_a_filter(spark, sf_dir):
    for name in ("j1_unique_anchors", "j10_crosscheck", "n10_name_variants"):
        made = plan(plans.QUERIES[name](spark, sf_dir)).splitlines()
        assert not [x for x in made if "Filter" in x and ("transform(" in x or "array_distinct(" in x)], name


def test_texts_are_read_once_for_their_words(spark, sf_dir, monkeypatch):
    made, write = {}, names.written
    monkeypatch.setattr(names, "written", lambda df, name: (made.setdefault(name, plan(df)), write(df, name))[1])
    for name in ("n10_name_variants", "n12_near_terms"):
        made.clear()
        assert plans.QUERIES[name](spark, sf_dir).count() > 0
        assert "documents.parquet" in made["left"] and "documents.parquet" not in made["pairs"]
        assert "SortMergeJoin" not in made["pairs"]  # few names are not met by shuffling every word


def test_sides_that_are_not_few(spark, monkeypatch):
    words = spark.createDataFrame([("ringside",), ("ringsides",), ("bolt",), ("bolts",), ("volt",)], "a string")
    found = lambda: sorted(map(tuple, names.similarity_join(words, words.withColumnRenamed("a", "b"), "a", "b", 0.8).collect()))
    few = found()
    monkeypatch.setattr(names, "FEW", 0)
    assert found() == few and len(few) == 9


def test_captions_are_folded_in_their_row(spark, sf_dir):
    assert "FlatMapGroupsInPandas" not in plan(plans.QUERIES["s3_caption_words"](spark, sf_dir))
    texts = spark.createDataFrame([("a", None), ("b", "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\nso<00:01:01.200><c> we </c><01:00:01.250><c>  </c>\n\n00:00:02.000 --> 00:00:03.000\nso we um<00:00:02.200><c> went</c>")], "slug string, text string")
    assert [tuple(r) for r in captions.caption_words(texts).collect()] == [("b", 0, 1.0, "so"), ("b", 1, 61.2, "we"), ("b", 2, 2.2, "went")]


def test_exports_are_written_in_files_of_bounded_size(spark, sf_dir, monkeypatch, tmp_path):
    monkeypatch.setattr(files, "ITEMS", 30, raising=False)
    monkeypatch.setattr(files, "_folder", lambda spark: str(tmp_path / "export"))
    rows = plans.QUERIES["s7_site_export"](spark, sf_dir).count()
    assert rows == spark.read.parquet(f"{sf_dir}/part.parquet").where("p_partkey % 4 in (0, 2)").count()
    assert len(list((tmp_path / "export").glob("part-*"))) >= 6
