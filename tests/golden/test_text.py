from pyspark.sql import functions as F

from tessitura.functions.strings import clock, fold, seconds_of, sub
from tessitura.operators import clean, metadata, names, sentences


def one(spark, text, *rules):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(*[r(F.col("t")).alias(f"c{i}") for i, r in enumerate(rules)]).first()[0]


def test_sub(spark):
    assert one(spark, "a1b22c", lambda c: sub(c, r"\d+", lambda m: F.concat(F.lit("<"), m, F.lit(">")))) == "a<1>b<22>c"
    assert one(spark, "12", lambda c: sub(c, r"\d", lambda m: F.concat(m, m))) == "1122"
    assert one(spark, "", lambda c: sub(c, r"\d", F.upper)) == ""
    assert one(spark, None, lambda c: sub(c, r"\d", F.upper)) is None


def test_fillers(spark):
    assert one(spark, "Uh, so um I uhhh think , yes", clean.strip_fillers) == "so I think, yes"
    assert one(spark, "umbrella and album", clean.strip_fillers) == "umbrella and album"
    assert one(spark, "Um, so it was, uh, fine. Uh-huh.", clean.remove_fillers) == "So it was, fine. Uh-huh."
    assert one(spark, "It was um good", clean.remove_fillers) == "It was good"


def test_stutters(spark):
    assert one(spark, "The the plan is is is good", clean.collapse_stutters) == "The plan is good"
    assert one(spark, "it's it's Ann Ann bye bye", clean.collapse_stutters) == "it's Ann Ann bye bye"
    assert one(spark, "very very so so", lambda c: clean.collapse_stutters(c, keep=clean.EMPHASIS_WORDS)) == "very very so so"
    assert one(spark, "the\nthe", clean.collapse_stutters) == "the\nthe"


def test_style(spark):
    assert one(spark, "a artist, an painting, a hour, a one, an nft, a unique", clean.fix_articles) == "an artist, a painting, an hour, a one, an nft, a unique"
    assert one(spark, "a aren't, a Aren't; a apple's, a I'm", clean.fix_articles) == "a aren't, a Aren't; an apple's, a I'm"
    assert one(spark, "ai by Ai Weiwei, chat gpt, gpt 4 and open ai", clean.fix_ai_terms) == "AI by Ai Weiwei, ChatGPT, GPT-4 and OpenAI"
    assert one(spark, "wait.. what... ok,, go", clean.fix_punctuation) == "wait. what... ok, go"
    assert one(spark, "mail Ann@Host.Com now", clean.spell_out_emails) == "mail Ann at host dot com now"
    assert one(spark, "19 sixties, 1960s and seventies", clean.fix_decades) == "1960s, 1960s and 70s"
    assert one(spark, "word간다 end", clean.remove_non_latin) == "word end"
    assert one(spark, "cost is $5\\1", lambda c: clean.apply_vocabulary(c, [("cost", "price $1\\", True)])) == "price $1\\ is $5\\1"
    assert one(spark, "i saw p.m. it. then x.com", lambda c: clean.capitalize_terms(c, [])) == "I saw p.m. It. Then x.com"
    assert one(spark, "And so", clean.lower_continuation) == "and so"
    assert one(spark, "Android", clean.lower_continuation) == "Android"


def test_idempotent(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for rule in (clean.strip_fillers, clean.collapse_stutters, clean.fix_punctuation, clean.spell_out_emails, clean.remove_non_latin):
        assert docs.where(rule(rule(F.col("text"))) != rule(F.col("text"))).count() == 0


def test_sentences(spark):
    got = one(spark, 'Dr. Lee said "hi." Then left… ok', sentences.split_sentences)
    assert got == ['Dr. Lee said "hi."', "Then left…", "ok"]
    assert one(spark, "  ", sentences.split_sentences) == []


def test_every_word_is_in_a_sentence(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    n = docs.select(F.sum(F.regexp_count("text", F.lit(r"\S+")))).first()[0]
    s = sentences.sentences(docs, ["doc_id"]).select(F.sum(F.regexp_count("sentence", F.lit(r"\S+")))).first()[0]
    assert n == s


def test_time(spark):
    assert one(spark, "3725", lambda c: clock(c.cast("int"))) == "01:02:05"
    assert one(spark, "65", lambda c: clock(c.cast("int"))) == "01:05"
    assert one(spark, "1:02:05", seconds_of) == 3725
    assert one(spark, "x", seconds_of) is None
    assert one(spark, "Élan Šø", fold) == "Elan So"


def test_dates(spark):
    assert str(one(spark, "Posted 2/3/21. Held on March 5th, 2021.", metadata.find_date)) == "2021-03-05"
    assert str(one(spark, "on 2/3/21", metadata.find_date)) == "2021-02-03"
    assert one(spark, "February 31, 2021", metadata.find_date) is None
    assert one(spark, "no date 12345/1/2", metadata.find_date) is None
    assert one(spark, "2021-03", metadata.show_date) == "March 2021"
    assert one(spark, "2021", metadata.show_date) == "2021"


def test_similarity_is_not_symmetric(spark):
    df = spark.createDataFrame([("tide", "diet"), ("diet", "tide"), ("same", "same"), (None, "x")], "a string, b string")
    assert [r.r for r in df.select(names.ratcliff_ratio("a", "b").alias("r")).collect()] == [0.25, 0.5, 1.0, None]


def test_similarity_join_loses_nothing(spark):
    import difflib
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(80)]
    df = spark.createDataFrame([(w,) for w in words], "a string")
    got = {(r.a, r.b) for r in names.similarity_join(df, df.withColumnRenamed("a", "b"), "a", "b", 0.7).collect()}
    assert got == {(a, b) for a in words for b in words if difflib.SequenceMatcher(None, a, b).ratio() >= 0.7}


def test_names(spark):
    assert one(spark, "Ann Élise (annie) / Studio", names.person_key) == "ann elise"
    assert one(spark, "O'NEIL-SMITH", names.title_case) == "O'Neil-Smith"
    assert tuple(one(spark, "Jan van der Berg", names.split_name)) == ("Jan", "van der Berg")
    chain = spark.createDataFrame([("Ann Lee",), ("Ann May Lee",), ("Ann May Rose Lee",), ("Bob Lee",)], "name string")
    assert {r.name: r["into"] for r in names.absorb_short_names(chain).collect()} == {"Ann Lee": "Ann May Rose Lee", "Ann May Lee": "Ann May Rose Lee", "Ann May Rose Lee": "Ann May Rose Lee", "Bob Lee": "Bob Lee"}


def test_mentions_take_the_longest(spark):
    s = spark.createDataFrame([(1, "I met Ann Lee Ray and ann.")], "k int, sentence string")
    n = spark.createDataFrame([("Ann",), ("Ann Lee Ray",), ("Lee",)], "name string")
    assert sorted((r["at"], r.name) for r in names.dictionary_mentions(s, n, ["k"]).collect()) == [(3, "Ann Lee Ray"), (7, "Ann")]


def test_similarity_join_loses_no_pair(spark):
    """Against all pairs, at several ratios, with letters repeated, marked and not of this script."""
    import difflib
    import random

    rng = random.Random(4)
    made = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 9))) for _ in range(150)] + ["", "a", "aa", "aaaa", "你好吗"]
    a, b = (spark.createDataFrame([(x,) for x in half], f"{c} string") for c, half in (("a", made[::2]), ("b", made[1::2])))
    for least in (0.5, 0.72, 0.85, 1.0):
        want = {(x, y) for x in set(made[::2]) for y in set(made[1::2]) if x and y and difflib.SequenceMatcher(None, x, y).ratio() >= least}
        assert {(r.a, r.b) for r in names.similarity_join(a, b, "a", "b", least).collect()} == want


def test_similarity_join_of_longer_words(spark):
    """Words of up to 30 letters and misspellings of them, by keys of letter pairs, against all pairs."""
    import difflib
    import random

    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(4, 30))) for _ in range(40)]

    def misspelt(w):
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(w))
            w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdefgh") + w[i:], w[:i] + rng.choice("abcdefgh") + w[i + 1 :], w[i:] + w[:i]])
        return w

    other = [misspelt(w) for w in base for _ in range(6) if w]
    a, b = (spark.createDataFrame([(x,) for x in words], f"{c} string") for c, words in (("a", base), ("b", other)))
    for least in (0.78, 0.8, 0.9):
        want = {(x, y) for x in set(base) for y in set(other) if x and y and difflib.SequenceMatcher(None, x, y).ratio() >= least}
        got = names.similarity_join(a, b, "a", "b", least)
        assert {(r.a, r.b) for r in got.collect()} == want
        assert names.similar_candidates(a, b, "a", "b", least).count() <= 5 * len(want)


def test_names_of_any_length(spark):
    """Four words and more; each was cut once."""
    s = spark.createDataFrame([(1, "Then Ana de la Cruz Paz and Ana de la Cruz spoke."), (2, None)], "k int, sentence string")
    n = spark.createDataFrame([("Ana de la Cruz",), ("Ana de la Cruz Paz",), ("de la",)], "name string")
    for sent in (200_000, 0):
        assert sorted((r["at"], r.name) for r in names.dictionary_mentions(s, n, ["k"], sent_firsts=sent).collect()) == [(2, "Ana de la Cruz Paz"), (8, "Ana de la Cruz")]
    t = spark.createDataFrame([(1, "So Ana de la Crux Paz left.")], "k int, text string")
    assert [(r.name, r.matched) for r in names.name_candidates(t, n.where("name like '%Paz'"), ["k"]).collect()] == [("Ana de la Cruz Paz", "Ana de la Crux Paz")]
    known = spark.createDataFrame([("x", "The Free and Old Land of the Long River")], "name string, country string")
    at = spark.createDataFrame([(1, "n", "Port, The Free and Old Land of the Long River")], "k int, name string, place string")
    assert names.resolve_country(at, known, "name", "place").first().resolved == "The Free and Old Land of the Long River"


def test_long_values_are_whole(spark):
    from tessitura.operators import attribution, links

    rest = "a/" * 9000 + "end"
    assert one(spark, f"HTTP://Site.org/{rest}#x", links.normal_url) == f"https://site.org/{rest}"
    turns = spark.createDataFrame([(1, 0, 0.0, "Audio shared by " + "n" * 3000)], "slug int, idx int, start double, speaker string")
    slots = spark.createDataFrame([], "slug int, s_start double, presenter string")
    assert attribution.presenter_of_runs(turns, slots).first().speaker == "n" * 3000


def test_decades(spark):
    for text, want in {
        "19 Sixties and seventies": "1960s and 70s",
        "In 19 hundreds or 19 twenties": "In 1900s or 20s",
        "1960s and 1970s and 1980s and nineties": "1960s and 70s and 1980s and 90s",
        "119 sixties, 19 sixtiesx, 19  sixties": "119 sixties, 19 sixtiesx, 19  sixties",
        "sixties to 1970s through 1980S": "sixties to 1970s through 80S",
        "": "",
    }.items():
        assert one(spark, text, clean.fix_decades) == want


def test_split_names(spark):
    for shown, want in {
        "Jan van der Berg": ("Jan", "van der Berg"),
        "Ana de Sá": ("Ana", "de Sá"),
        "Fahn (James Gardiner)": ("James", "Gardiner"),
        "Beau Tardy Artist": ("Beau", "Tardy"),
        "Ann Lee aka Annie B": ("Ann", "Lee"),
        'Ann "Sparrow" Lee / Studio Lee': ("Ann", "Lee"),
        "Blue Studio": ("", "Blue Studio"),
        "pixel_ann two": ("", "pixel_ann two"),
        "ANN LEE": ("", "ANN LEE"),
        "ann": ("", "ann"),
        "Mary Ann St. Clair": ("Mary Ann", "St. Clair"),
        "Van Morrison": ("Van", "Morrison"),
    }.items():
        assert tuple(one(spark, shown, names.split_name)) == want, shown


def test_page_verdicts(spark):
    from tessitura.operators import links

    long = "word " * 1000
    rows = [
        ("<title>Ann Lee</title><p>work</p>", "https://ann.org/a", "https://ann.org/a", "ok"),
        (f"{long} buy this domain", "https://ann.org/a", "https://ann.org/a", "ok"),
        ("Related Searches", "https://ann.org/a", "https://ann.org/a", "parked"),
        ("<style>buy this domain</style><b>x</b>", "https://ann.org/a", "https://ann.org/a", "ok"),
        ("x", "https://sub.dan.com/ann.org", "https://ann.org/", "parked"),
        ("x", "https://ann.org/missing", "https://ann.org/a", "broken"),
        ("<TITLE>\n Page not\nfound | Ann</TITLE>", "https://ann.org/a", "https://ann.org/a", "broken"),
        ("<title>Index of /</title>", "https://ann.org/", "https://ann.org/", "parked"),
        ("x", "https://www.ann.org/b/", "http://ann.org/a", "ok"),
        ("x", "https://ann.org", "https://ann.org/a", "changed"),
        ("x", "https://ann.org/?p=1", "https://ann.org/a", "ok"),
        ("x", "https://bob.org/a", "https://ann.org/a", "changed"),
        ("x", "https://bob.org/a", "https://t.co/a", "ok"),
        ("x", "https://discord.com/a", "https://discordapp.com/a", "ok"),
        ("x", "https://ann.co.uk/", "https://bob.co.uk/", "changed"),
        ("", "https://ann.org/a", "https://ann.org/a", "ok"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, body string, final string, url string, want string")
    got = df.withColumn("got", links.page_verdict(F.col("body"), F.col("final"), F.col("url"))).collect()
    assert [(r.i, r.got) for r in got] == [(r.i, r.want) for r in got]


def test_name_variants_against_all_pairs(spark, sf_dir):
    """The registered query's rows, from every word compared to every name word."""
    import difflib
    import re
    from collections import defaultdict

    from tessitura.plans import QUERIES
    from tessitura.plans.naming import _misspelt, _people

    texts = {r.doc_id: re.findall(r"[^\W\d_]+", r.text.lower()) for r in _misspelt(spark, sf_dir).collect()}
    people = {r.name for r in _people(spark, sf_dir).collect()}
    ends = {n: (n.lower().split(" ")[0], n.lower().split(" ")[-1]) for n in people}
    vocabulary, close = {w for ws in texts.values() for w in ws}, {}
    for k in {x for e in ends.values() for x in e}:
        found = []
        for w in vocabulary:
            if 2 * min(len(w), len(k)) / (len(w) + len(k)) >= 0.8 and (r := difflib.SequenceMatcher(None, w, k).ratio()) >= 0.8:
                found.append((-r, w))
        close[k] = {w: -r for r, w in sorted(found)[:25]}
    hits = defaultdict(set)
    for name, (fa, fb) in ends.items():
        for a, ra in close[fa].items():
            for b, rb in close[fb].items():
                if (a, b) != (fa, fb) and (a == fa or b == fb or (ra >= 0.85 and rb >= 0.85)):
                    hits[a, b].add(name)
    want = defaultdict(list)
    for i, ws in texts.items():
        for pair in zip(ws, ws[1:]):
            for name in hits.get(pair, ()):
                want[(*pair, name)].append(i)
    got = {(r["first"], r["last"], r["name"]): (r.times, r.texts) for r in QUERIES["n10_name_variants"](spark, sf_dir).collect()}
    assert got == {k: (len(v), len(set(v))) for k, v in want.items()} and got


def test_name_variants_are_not_cut_at_the_closest(spark):
    """Fifty words that are close to one last word: each counts, the closest 25 and the others."""
    import string

    from tessitura.operators.names import name_variants

    last = [f"lindqvis{x}" for x in string.ascii_lowercase if x != "t"] + [f"lind{x}vist" for x in string.ascii_lowercase if x != "q"]
    rows = spark.createDataFrame([(i, f"So Mara {w.title()} spoke.") for i, w in enumerate(last)], "doc_id int, text string")
    found = name_variants(rows, spark.createDataFrame([("Mara Lindqvist",)], "name string"), "doc_id").collect()
    assert sorted((r["first"], r["last"], r["name"], r.times, r.texts) for r in found) == sorted(("mara", w, "Mara Lindqvist", 1, 1) for w in last)


def test_name_variants_are_sought_in_all_documents(spark, sf_dir, tmp_path):
    """Documents beyond the parts' numbers too."""
    from tessitura.plans import QUERIES

    docs = [(10**9, "Then small rinng came."), (10**9 + 1, "a small rinng"), (10**9 + 2, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    (tmp_path / "part.parquet").symlink_to(f"{sf_dir}/part.parquet")
    got = {(r["first"], r["last"], r["name"], r.times, r.texts) for r in QUERIES["n10_name_variants"](spark, str(tmp_path)).collect()}
    assert ("small", "rinng", "small ring", 2, 2) in got


def test_spellings_against_the_fold(spark, sf_dir):
    import difflib
    from collections import defaultdict

    from tessitura.plans import QUERIES

    counts = defaultdict(dict)
    for r in spark.read.parquet(f"{sf_dir}/part.parquet").collect():
        counts[r.p_brand][r.p_name] = counts[r.p_brand].get(r.p_name, 0) + 1
    want = set()
    for brand, names_ in counts.items():
        kept = []
        for name, n in sorted(names_.items(), key=lambda x: (-x[1], x[0])):
            into = next((k for k in kept if difflib.SequenceMatcher(None, name.lower(), k.lower()).ratio() >= 0.8), None)
            if into is None:
                kept.append(name)
            want.add((brand, name, n, into or name))
    assert {(r.slug, r.name, r.n, r.merged) for r in QUERIES["n14_merge_spellings"](spark, sf_dir).collect()} == want


def test_gaps_are_filled(spark):
    from tessitura.operators import metadata

    rows = [("a", 1, 0), ("a", 2, 1), ("a", 1_000_000_000, 2), ("a", None, 3), ("a", None, 4), ("b", None, 0), ("b", None, 1), ("c", 2, 0), ("c", 5, 1), *[("c", None, i) for i in range(2, 7)]]
    got = metadata.fill_numbers(spark.createDataFrame(rows, "series string, number int, i int"), "series", "number", ["i"]).collect()
    assert {(r.series, r.i): r.number for r in got if r.number != 1_000_000_000} == {("a", 0): 1, ("a", 1): 2, ("a", 3): 3, ("a", 4): 4, ("b", 0): 1, ("b", 1): 2, ("c", 0): 2, ("c", 1): 5, ("c", 2): 1, ("c", 3): 3, ("c", 4): 4, ("c", 5): 6, ("c", 6): 7}
