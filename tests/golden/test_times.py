import numpy as np
import bisect
import random

from pyspark.sql import functions as F

from tessitura.operators import attribution, edits, timejoins


def test_asof(spark):
    left = spark.createDataFrame([(1, 0.5), (1, 2.0), (1, 9.0), (2, 1.0)], "slug int, t double")
    right = spark.createDataFrame([(1, 1.0, 10), (1, 2.0, None), (1, 5.0, 30)], "slug int, from_sec double, delta int")
    got = sorted((r.slug, r.t, r.delta) for r in timejoins.asof_last(left, right, "slug", "t", "from_sec", ["delta"]).collect() if r.delta)
    assert got == [(1, 9.0, 30)]
    got = sorted((r.slug, r.t, r.delta) for r in timejoins.asof_last(left, right, "slug", "t", "from_sec", ["delta"], True).collect() if r.slug == 1 and r.delta)
    assert got == [(1, 0.5, 10), (1, 9.0, 30)]
    assert timejoins.asof_last(left, right, "slug", "t", "from_sec", ["delta"]).count() == 4


def test_interval_join_is_exact(spark):
    rng = random.Random(2)
    spans = lambda: [(rng.randrange(2), s := rng.uniform(0, 100), s + rng.choice([0, 3, 40])) for _ in range(60)]
    a, b = spans(), spans()
    got = timejoins.interval_join(spark.createDataFrame(a, "k int, start double, end double"), spark.createDataFrame(b, "k int, s double, e double"), "k", 7.0, right_span=("s", "e")).collect()
    want = [(x, y) for x in a for y in b if x[0] == y[0] and x[1] <= y[2] and y[1] <= x[2]]
    assert sorted(((r.k, r.start, r.end), (r.k, r.s, r.e)) for r in got) == sorted(want)


def test_chain(spark):
    rng = random.Random(4)
    rows = [(1, i, rng.randrange(40)) for i in range(40)]
    got = timejoins.longest_chain(spark.createDataFrame(rows, "k int, left_at int, right_at int"), "k").collect()
    ends = []
    for _, _, x in rows:
        k = bisect.bisect_left(ends, x)
        ends[k : k + 1] = [x]
    chain = sorted((r.left_at, r.right_at) for r in got)
    assert len(chain) == len(ends) and all(a[1] < b[1] for a, b in zip(chain, chain[1:]))


def test_steps(spark):
    rows = [(1, 1.0, 5.0), (1, 2.0, 6.0), (1, 3.0, 8.5), (1, 4.0, 10.0), (1, 5.0, 5.0)]
    got = timejoins.shift_steps(spark.createDataFrame(rows, "slug int, t double, d double"), "slug", "t", "d").collect()
    assert sorted((r.from_sec, r.delta) for r in got) == [(0.0, 5.0), (3.0, 8.5), (5.0, 5.0)]


def plain_cut(cues, delta, low=0.25, plus=4.0):
    """Every run of the length, by its cost."""
    best = None
    for a in range(len(cues)):
        for b in range(a, len(cues)):
            length = cues[b][2] - cues[a][1]
            if delta * (1 - low) - plus <= length <= delta * (1 + low) + plus:
                cost = sum(n - x if k < a else n - y if k > b else max(x, y) for k, (_, _, _, n, x, y) in enumerate(cues))
                if best is None or cost < best[0]:
                    best = (cost, a, b)
    return best and best[1:]


def test_cuts_of_three_lengths(spark):
    """A cut's cues are said on neither clock; before it the first fits, after it the second."""
    rnd = random.Random(6)
    cues, cuts, want = [], [], {}
    for slug, (first, last) in enumerate([(4, 5), (10, 18), (2, 24)]):
        at = 0.0
        for i in range(30):
            n, seconds = rnd.randint(4, 12), rnd.uniform(3, 9)
            fits = rnd.randint(n // 2 + 1, n)
            x, y = (fits, rnd.randint(0, 1)) if i < first else (rnd.randint(0, 1), fits) if i > last else (rnd.randint(0, 1), rnd.randint(0, 1))
            cues.append((slug, i, at, at + seconds, n, x, y))
            at += seconds + rnd.uniform(0, 1)
        mine = [c for c in cues if c[0] == slug]
        cuts.append((slug, "c", 0.0, at, mine[last][3] - mine[first][2]))
        want[slug] = (first, last)
    cuts.append((0, "long", 0.0, 60.0, 500.0))  # no run is so long
    c = spark.createDataFrame(cues, "slug int, cue int, start double, end double, n int, before int, after int")
    got = timejoins.find_cuts(c, spark.createDataFrame(cuts, "slug int, cut string, z1 double, z2 double, delta double"), "slug").collect()
    assert {r.slug: (r.first, r.last) for r in got if r.cut == "c"} == want and all(r.status == "ok" for r in got if r.cut == "c")
    assert [(r.first, r.status) for r in got if r.cut == "long"] == [(None, "review")]


def test_cheapest_run_against_all_runs():
    rnd = random.Random(7)
    for _ in range(300):
        cues, at = [], 0.0
        for i in range(rnd.randint(1, 25)):
            at += rnd.choice([0.0, 1.0, 2.0])
            n = rnd.randint(1, 4)
            cues.append((i, at, at + rnd.choice([1.0, 2.0, 5.0]), n, rnd.randint(0, n), rnd.randint(0, n)))
        delta = rnd.choice([4.0, 9.0, 20.0])
        start, end, n, x, y = (np.array(v) for v in list(zip(*cues))[1:])
        assert timejoins._cheapest_run(start, end, n, x, y, delta * 0.75 - 4, delta * 1.25 + 4) == plain_cut(cues, delta)


def test_words_found(spark):
    cues = spark.createDataFrame([(1, 0, 10.0, 12.0, ["a", "b", "a"]), (1, 1, 100.0, 101.0, ["c"]), (1, 2, 50.0, 51.0, [])], "slug int, cue int, start double, end double, words array<string>")
    said = spark.createDataFrame([(1, 4.0, "a"), (1, 5.0, "a"), (1, 18.5, "b"), (1, 40.0, "c"), (2, 100.0, "c")], "slug int, t double, word string")
    found = lambda shift: {r.cue: r.found for r in timejoins.words_found(cues, said, "slug", F.lit(shift)).collect()}
    assert found(0.0) == {0: 2} and found(-60.0) == {1: 1} and found(1.0) == {0: 3}


def test_shift(spark):
    left = spark.createDataFrame([(1, f"g{i}", i * 3) for i in range(50)], "slug int, gram string, at int")
    got = timejoins.best_shift(left, left.withColumn("at", F.col("at") - 44), "slug", "gram", "at").first()
    assert got["shift"] == -44 and got.hits == 50


def test_turns(spark):
    cues = [(1, 0, "a", 0.0, 1.0, "One"), (1, 1, "a", 3.0, 4.0, "two."), (1, 2, "a", 8.0, 9.0, "Three"), (1, 3, "b", 9.0, 10.0, "four"), (1, 4, None, 10.0, 11.0, "five")]
    got = attribution.merge_turns(spark.createDataFrame(cues, "slug int, idx int, speaker string, start double, end double, text string")).orderBy("turn").collect()
    assert [(r.speaker, r.cues, r.text) for r in got] == [("a", 3, "One. two.\n\nThree"), ("b", 1, "four"), (None, 1, "five")]


def test_chapters(spark):
    segs = [(1, "a", 5.0, 80.0), (1, "b", 90.0, 200.0), (1, "c", 95.0, 300.0), (1, "d", 400.0, 410.0), (1, None, 500.0, 900.0)]
    got = attribution.chapters(spark.createDataFrame(segs, "slug int, speaker string, start double, end double"), fewest=2).collect()
    assert [(r.start, r.title) for r in got] == [(0.0, "Introduction"), (90.0, "b")]


def plain_loops(words, longest=8):
    """From each word the phrase that covers most; the search goes on after it."""
    found, i = [], 0
    while i < len(words):
        best = None
        for n in range(1, longest + 1):
            k = 1
            while words[i + k * n : i + (k + 1) * n] == words[i : i + n] and len(words[i : i + n]) == n:
                k += 1
            if k >= (8 if n <= 2 else 4) and any(words[i : i + n]) and (best is None or k * n > best[0]):
                best = (k * n, n, k)
        if best:
            found.append((best[1], i, i + best[0] - 1, best[2]))
            i += best[0]
        else:
            i += 1
    return found


def test_loops(spark):
    words = "x a a a a a a a a y b c d b c d b c d b c d z".split()
    df = spark.createDataFrame([(1, i, w, float(i)) for i, w in enumerate(words)], "slug int, idx int, word string, start double")
    found = attribution.loop_spans(df)
    assert sorted((r.n, r["first"], r["last"], r.repeats) for r in found.collect()) == [(1, 1, 8, 8), (3, 10, 21, 4)]
    ranges = lambda pad: sorted((r.start, r.end) for r in attribution.repair_ranges(found, df, pad=pad).collect())
    assert ranges(12.0) == [(0.0, 34.0)] and ranges(0.0) == [(1.0, 22.0)] and attribution.repair_ranges(found, df, pad=-1.0).count() == 2
    assert [r.word for r in attribution.without_loops(df).orderBy("idx").collect()] == ["x", "y", "z"]


def test_loops_against_each_phrase():
    rnd = random.Random(3)
    for _ in range(400):
        words = []
        while len(words) < 60:
            words += [rnd.choice(["a", "b", "c", ""]) for _ in range(rnd.randint(1, 9))] * rnd.choice([1, 1, 4, 5, 8])
        numbers = np.array([{"": -1, "a": 0, "b": 1, "c": 2}[w] for w in words])
        assert attribution._repeats(numbers, 8) == plain_loops(words), words
    assert attribution._repeats(np.zeros(1, np.int64), 8) == [] == attribution._repeats(np.zeros(0, np.int64), 8)


def plain_blocks(words, block, slack, pause):
    starts, i = [words[0][0]], 1
    target = starts[0] + block
    while i < len(words):
        if words[i][0] < target:
            i += 1
            continue
        inside = [j for j in range(i, len(words)) if words[j][0] < target + slack]
        cut = next((j for j in inside if words[j - 1][1].rstrip("\"").endswith(".") and words[j - 1][1].lower() != "mr."), None)
        if cut is None:
            cut = next((j for j in inside if words[j][0] - words[j - 1][0] >= pause), i)
        starts.append(words[cut][0])
        target, i = words[cut][0] + block, cut + 1
    return starts


def test_blocks_against_plain(spark):
    rnd = random.Random(9)
    rows, want = [], {}
    for slug in range(40):
        t, words = 0.0, []
        for _ in range(rnd.randint(1, 120)):
            t += rnd.choice([0.0, 0.5, 1.0, 1.0, 3.0])
            words.append((t, rnd.choice(["a", "b", "end."] if slug % 2 else ["a", "b", "Mr.", 'so."' if slug % 3 == 0 else "c"])))
        rows += [(slug, x, i, w) for i, (x, w) in enumerate(words)]
        want[slug] = plain_blocks(words, 10.0, 5.0, 2.0)
    got = {}
    for r in attribution.time_blocks(spark.createDataFrame(rows, "slug int, t double, idx int, text string"), block=10.0, slack=5.0, pause=2.0).collect():
        got.setdefault(r.slug, []).append(r.start)
    assert {k: sorted(v) for k, v in got.items()} == want


def test_paragraphs_and_blocks(spark):
    words = [(1, i, float(i), "word." if i % 10 == 9 else "word") for i in range(200)]
    df = spark.createDataFrame(words, "slug int, idx int, start double, text string")
    got = attribution.paragraph_words(df, soft=100, most=200, pause=5.0).orderBy("para").collect()
    assert " ".join(r.text for r in got) == " ".join(w for *_, w in words)
    assert [r.start for r in got] == [0.0, 40.0, 80.0, 120.0, 160.0]
    blocks = attribution.time_blocks(df.select("slug", F.col("start").alias("t"), "idx", F.lit("a").alias("text")), block=50.0, slack=10.0, pause=5.0)
    assert sorted(r.start for r in blocks.collect()) == [0.0, 50.0, 100.0, 150.0]


def test_edits_follow_each_other(spark):
    p = spark.createDataFrame([(1, 0, 0, 0.0, "one"), (1, 1, 0, 30.0, "one")], "slug int, seg int, para int, start double, text string")
    e = spark.createDataFrame([(1, 0, 25.0, "one", "two"), (1, 1, 25.0, "two", "three"), (1, 2, 0.0, "gone", "x")], "slug int, edit int, t double, old string, new string")
    done, stale = edits.apply_edits(p, e, "slug", rounds=2)
    assert sorted((r.seg, r.text) for r in done.collect()) == [(0, "one"), (1, "three")]
    assert [r.edit for r in stale.collect()] == [2]


def plain_clips(turns, voice):
    """Longest turns first, tier by tier."""
    talk = lambda a, b: sum(max(0.0, min(b, e) - max(a, s)) for v, s, e in turns if v != voice)
    own = sorted(((e - s, s, e) for v, s, e in turns if v == voice), reverse=True)
    kept = []
    for least, lead, any_talk, spacing in edits.TIERS:
        if (least == 5.0 and len(kept) < 3) or not kept:
            for n, s, e in own:
                a, b = (s + lead, min(e, s + lead + 9.0)) if lead > 0 else (max(0.0, s + lead), e - lead)
                if n >= least and len(kept) < 3 and (any_talk or talk(a, b) <= 0.15 * (b - a)) and all(abs(a - k[0]) > spacing for k in kept):
                    kept.append((a, b))
    return sorted(kept)


def test_clips(spark):
    rnd = random.Random(2)
    rows, want = [], {}
    for slug in range(25):
        turns = {(rnd.choice("vw" if slug % 2 else "vwx"), s, s + rnd.choice([0.5, 2.0, 6.0, 20.0, 45.0] if slug % 5 else [0.5, 2.0, 3.0])) for s in (round(rnd.uniform(0, 1500 if slug % 3 else 60), 1) for _ in range(12))}
        rows += [(slug, *t) for t in turns]
        want |= {(slug, v): c for v in {t[0] for t in turns} if (c := plain_clips(turns, v))}
    got = {}
    for r in edits.pick_clips(spark.createDataFrame(rows, "slug int, voice string, start double, end double"), "slug").collect():
        got.setdefault((r.slug, r.voice), []).append((r.start, r.end))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_paragraphs_are_placed(spark):
    text = "one two three four five six seven one two three four nine one two"
    words = [(1, i, i * 2.0, w) for i, w in enumerate(text.split())]
    paras = [(1, 0, "One, two three four nine!", 0.0, 30.0), (1, 1, "five six seven", 0.0, 30.0), (1, 2, "one two", 3.0, 30.0), (1, 3, "one two three four five", 100.0, 130.0), (1, 4, "", 7.0, 9.0), (1, 5, "one two three four", 9.0, 40.0)]
    got = timejoins.place_paragraphs(spark.createDataFrame(paras, "slug int, para int, text string, block_start double, block_end double"), spark.createDataFrame(words, "slug int, idx int, t double, word string"), "slug")
    assert {r.para: (r.start, r.score) for r in got.collect()} == {0: (14.0, 5), 1: (8.0, 3), 2: (3.0, None), 3: (100.0, None), 4: (7.0, None), 5: (14.0, 4)}


def test_words_found_in_lists(spark):
    rnd = random.Random(8)
    letters = "abcdefgh"
    cues = [(k, i, (t := rnd.uniform(0, 300)), t + rnd.uniform(0, 90), rnd.choices(letters, k=rnd.randint(0, 6))) for k in range(3) for i in range(25)]
    said = [(k, sorted(rnd.uniform(0, 300) for _ in range(n)), rnd.choices(letters, k=n)) for k in range(2) for n in (1, 3, 9)]
    c = spark.createDataFrame(cues, "slug int, cue int, start double, end double, words array<string>")
    lists = spark.createDataFrame([(k, t[0], t[-1], t, w) for k, t, w in said], "slug int, first double, last double, times array<double>, tokens array<string>")
    found = timejoins.words_found_in_lists(c, lists, "slug", {"x": 0.0, "y": -60.0}, pad=2.0)
    got = {(r.slug, r.cue): (r.x, r.y) for r in found.collect()}

    def plain(shift, slug, start, end, words):
        near = {w for k, times, tokens in said if k == slug for t, w in zip(times, tokens, strict=True) if start + shift - 2 <= t <= end + shift + 2}
        return sum(w in near for w in words)

    want = {(k, i): (plain(0.0, k, a, b, w), plain(-60.0, k, a, b, w)) for k, i, a, b, w in cues}
    assert {x: got.get(x, (0, 0)) for x in want} == want and any(x > 1 for x, _ in got.values())


def test_cuts_are_searched_in_their_rows(spark, sf_dir):
    from tessitura import plans

    made = plans.QUERIES["j6_cuts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in made and "explode(words" not in made
