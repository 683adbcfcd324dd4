"""Names heard wrong: which words of a text are meant for a name, what to do about them, and the text put right."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.functions.strings import words
from tessitura.functions.tables import written

from .names import beginnings, first_letters, multiset_bound, ratcliff_ratio, ratio_bound, similarity_join

# The ratios from which a name is put in, and from which it is shown to a person, for the few names that a
# recording's list has and for those of the whole index.
SCOPED = (0.72, 0.63)
INDEX = (0.92, 0.80)
# Words at the edge of a window that are no part of a name.
EDGE_WORDS = (
    "a an the and or is was are were be been as at to of in on i i'm im you we he she it hi so but that this here there who with for my his "
    "her our oh now just would will can could has have had do does did not am by from up out if then than about us"
).split()
# A last word less like the name's than this is another word, and an ordinary word must be this like it; names
# up to so many letters must be hit nearly exactly, in the index up to so many.
LAST_WORD, ORDINARY_WORD, NEAR_EXACT, SHORT, SHORT_INDEX = 0.45, 0.7, 0.95, 4, 6

EDGES = r"(?U)^[^\w]+|[^\w]+$"


def _bare(c: Column) -> Column:
    return F.regexp_replace(c, EDGES, "")


def _windows(texts: DataFrame, keys: Sequence[str], sizes: Sequence[int], text_col: str, own: str, begin: dict[int, list[str]]) -> DataFrame:
    """(keys, idx, n, w, heard, _f): runs of n words of one sentence, idx from 0, whose first letter is listed under n in begin, or after
    n in the array own; and those whose first word has no letter."""
    rows = texts.select(*keys, own, words(F.col(text_col)).alias("t"), first_letters(F.lower(text_col), r"\w").alias("c")).where(F.size("t") > 0)

    def runs_of(n: int) -> Column:
        # Runs are made for what may begin a name only: nearly all words begin none.
        begins = lambda x: x.isin("", *begin.get(n, [])) | F.coalesce(F.array_contains(own, F.concat(F.lit(f"{n} "), x)), F.lit(False))
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size("t") - n, F.lit(0))), lambda i: (F.size("t") >= n) & begins(F.get("c", i)))
        run = F.transform(starts, lambda i: F.struct(i.alias("idx"), F.lit(n).alias("n"), F.array(*[F.get("t", i + k) for k in range(n)]).alias("w")))
        return F.filter(run, lambda r: ~F.exists(F.slice(r["w"], 1, n - 1), lambda x: x.rlike(r"[.!?]$")))

    made = rows.select(*keys, F.explode(F.concat(*[runs_of(n) for n in sizes])).alias("r")).select(*keys, "r.*")
    made = made.withColumn("heard", F.lower(_bare(F.array_join("w", " ")))).where("heard <> ''")
    return made.withColumn("_f", F.left("heard", F.lit(1)))


def _pool(names: DataFrame, scope: Sequence[str]) -> DataFrame:
    n = names.where("trim(name) <> ''").select(*scope, "name").distinct()
    n = n.withColumn("p", F.lower(F.trim(F.regexp_replace("name", r"(?U)\s+", " "))))
    return n.withColumn("n", F.size(F.split("p", " "))).withColumn("_f", F.left("p", F.lit(1)))


def _best(hits: DataFrame, keys: Sequence[str]) -> DataFrame:
    best = F.max_by(F.struct("idx", "n", "w", "p", "ratio"), F.struct("ratio", -F.col("idx")))
    return hits.groupBy(*keys, "name").agg(best.alias("b")).select(*keys, "name", "b.*")


def _leading(flags: Column, n: Column) -> Column:
    """How many of n flags are true before the first that is not."""
    first = F.array_position(flags, False)
    return F.when(first == 0, n).otherwise(first - 1).cast("int")


def _judged(best: DataFrame) -> DataFrame:
    """The best windows without function words at their edges, scored again, with the last word's own ratio."""
    name_words = F.split("p", " ")

    def junk(name_word: Column) -> Column:
        return F.transform("_low", lambda x: x.isin(*EDGE_WORDS) & (x != name_word) & (F.left(x, F.lit(1)) != F.left(name_word, F.lit(1))))

    b = best.withColumn("_low", F.transform("w", lambda x: F.lower(_bare(x)))).withColumn("_first", F.element_at(name_words, 1)).withColumn("_last", F.element_at(name_words, -1))
    b = b.withColumn("_tail", F.least(_leading(F.reverse(junk(F.col("_last"))), F.col("n")), F.col("n") - 1))
    b = b.withColumn("_head", F.least(_leading(junk(F.col("_first")), F.col("n")), F.col("n") - F.col("_tail") - 1))
    b = b.withColumn("size", F.col("n") - F.col("_tail") - F.col("_head")).withColumn("idx", F.col("idx") + F.col("_head"))
    b = b.withColumn("_span", F.array_join(F.slice("w", F.col("_head") + 1, F.col("size")), " "))
    b = b.withColumn("_core", _bare(F.col("_span"))).withColumn("last_word", F.element_at("_low", F.col("n") - F.col("_tail")))
    # A possessive keeps its ending.
    b = b.withColumn("heard", F.regexp_replace("_core", "['’]s$", ""))
    b = b.withColumn("lead", F.regexp_extract("_span", r"(?U)^([^\w]*)", 1)).withColumn("trail", F.substring(F.col("_span"), F.length("lead") + F.length("heard") + 1, F.length("_span")))
    again = ratcliff_ratio(F.lower("_core"), F.col("p"))
    b = b.withColumn("ratio", F.when(F.col("n") > 1, again).otherwise(F.col("ratio"))).withColumn("last_ratio", ratcliff_ratio(F.col("last_word"), F.col("_last")))
    return b.drop("_low", "_first", "_tail", "_head", "_span", "_core", "w", "p")


def name_findings(
    texts: DataFrame,
    keys: Sequence[str],
    scoped: DataFrame,
    scope: Sequence[str],
    index: DataFrame,
    ordinary: DataFrame,
    known: DataFrame,
    suppressed: DataFrame,
    text_col: str = "text",
    floor: float = 0.4,
) -> DataFrame:
    """(keys, name, pool, idx, size, heard, lead, trail, ratio, action): the words of each text that are meant for a name, and
    whether the name is put in (auto) or a person is asked (review); no row for what is neither.

    scoped(scope, name) are the few names of the text's own recording, index(name) all others. For each name the window of as
    many words with the same first letter and the highest ratio counts, the first of equals; windows do not cross the end of
    a sentence. Function words at its edges are cut off and it is scored again. It is nothing if its last word is not like
    the name's, or is an ordinary(word) and not very like it; if the name is a short handle and the hit not nearly exact; if
    it is the name itself or a known(name); review also leaves out suppressed(matched, candidate). A single word is never
    put right from the index. A best window whose ratio before the cut is under floor (in the index: under what review
    takes) is not looked at. keys name one text; null and empty texts and names give no rows.
    """
    scoped_pool = written(_pool(scoped, scope), "scoped_names")
    index_pool = written(_pool(index, []), "index_names")
    sizes = sorted({r.n for p in (scoped_pool, index_pool) for r in p.select("n").distinct().collect()})  # as many as the longest name has words
    if not sizes:
        sizes = [1]
    # A recording's few beginnings go to its texts; those of the index are as many as alphabets have letters.
    own_begin = written(scoped_pool.groupBy(*scope).agg(F.collect_set(F.concat_ws(" ", F.col("n").cast("string"), "_f")).alias("_own")), "own_beginnings")
    begun = texts.select(*keys, F.col(text_col).alias("_text")).join(own_begin, list(scope), "left")
    w = written(_windows(begun, keys, sizes, "_text", "_own", beginnings(index_pool)), "windows")

    pairs = w.hint("merge").join(scoped_pool.hint("merge"), [*scope, "n", "_f"])
    pairs = pairs.where((ratio_bound(F.col("heard"), F.col("p")) >= floor) & (multiset_bound(F.col("heard"), F.col("p")) >= floor))
    own = _best(pairs.withColumn("ratio", ratcliff_ratio("heard", "p")), keys).where(F.col("ratio") >= floor).withColumn("pool", F.lit("scoped"))

    # Only windows that begin as some name of the index does; the few beginnings are written, so that their size is true.
    begin = written(index_pool.select("n", "_f").distinct(), "beginnings")
    close = similarity_join(w.select("heard", "n", "_f").join(begin.hint("shuffle_hash"), ["n", "_f"], "left_semi").distinct(), index_pool, "heard", "p", INDEX[1], ["n", "_f"])
    hits = w.hint("merge").join(close.hint("merge"), "heard").join(index_pool.select("name", "p").hint("merge"), "p")
    # A name of the text's own recording is judged as such only.
    other = _best(hits, keys).join(scoped_pool.select(*scope, "name").hint("merge"), [*scope, "name"], "left_anti").withColumn("pool", F.lit("index"))

    # Written: ratios must not be taken anew in each of the tests below.
    judged = written(_judged(written(own.unionByName(other), "best_windows")), "judged_windows")
    o = ordinary.select(F.lower("word").alias("last_word"), F.lit(True).alias("_ordinary")).distinct()
    k = known.select(F.lower("name").alias("_heard"), F.lit(True).alias("_known")).distinct()
    s = suppressed.select(F.lower("matched").alias("_heard"), F.col("candidate").alias("name"), F.lit(True).alias("_suppressed")).distinct()
    j = judged.withColumn("_heard", F.lower("heard")).join(o, "last_word", "left").join(k, "_heard", "left").join(s, ["_heard", "name"], "left")

    single, in_index = F.col("n") == 1, F.col("pool") == "index"
    last = F.element_at(F.split(F.lower(F.trim("name")), r"(?U)\s+"), -1)
    other_word = (F.col("size") >= 2) & ((F.col("last_ratio") < LAST_WORD) | ((F.col("last_word") != last) & F.col("_ordinary").isNotNull() & (F.col("last_ratio") < ORDINARY_WORD)))
    nothing = other_word | (single & (F.length("name") <= SHORT) & (F.col("ratio") < NEAR_EXACT)) | (F.col("_heard") == F.lower(F.trim("name"))) | F.col("_known").isNotNull()
    auto = (F.col("ratio") >= F.when(in_index, INDEX[0]).otherwise(SCOPED[0])) & ~(single & in_index)
    review = (F.col("ratio") >= F.when(in_index, INDEX[1]).otherwise(SCOPED[1])) & F.col("_suppressed").isNull()
    review = review & ~(single & in_index & (F.length("name") <= SHORT_INDEX) & (F.col("ratio") < NEAR_EXACT))
    action = F.when(nothing, None).when(auto, "auto").when(review, "review")
    return j.withColumn("action", action).where("action is not null").select(*keys, "name", "pool", "idx", "size", "heard", "lead", "trail", "ratio", "action")


def correct_names(texts: DataFrame, findings: DataFrame, keys: Sequence[str], text_col: str = "text") -> DataFrame:
    """texts with the names of findings that are auto put in. Of findings that share words the recording's own name goes
    first, then that of more words, then the first by name; the text around them, its white space too, stays as it is."""
    n = F.size(F.split("name", r"(?U)\s+"))
    auto = findings.where("action = 'auto'").withColumn("to", F.concat("lead", "name", "trail"))
    order = F.struct((F.col("pool") != "scoped").alias("a"), (-n).alias("b"), F.col("name").alias("c"), F.col("idx").cast("int").alias("idx"), F.col("size").cast("int").alias("size"), F.col("to").alias("to"))
    # As many as names are found in one text.
    listed = auto.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("_all"))
    fix = "struct<idx:int,size:int,to:string>"

    def take(kept: Column, x: Column) -> Column:
        meets = F.exists(kept, lambda y: (x["idx"] < y["idx"] + y["size"]) & (y["idx"] < x["idx"] + x["size"]))
        return F.when(meets, kept).otherwise(F.concat(kept, F.array(F.struct(x["idx"].alias("idx"), x["size"].alias("size"), x["to"].alias("to")).cast(fix))))

    listed = listed.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.aggregate("_all", F.array().cast(f"array<{fix}>"), take).alias("_fixes"))
    on = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    rows = texts.join(listed.hint("merge"), on, "left")
    said, between = words(F.col(text_col)), F.split(text_col, r"(?U)\S+", -1)

    def piece(x: Column, i: Column) -> Column:
        fixes = F.filter("_fixes", lambda f: (f["idx"] <= i) & (i < f["idx"] + f["size"]))
        f = F.get(fixes, F.lit(0))
        return F.when(f.isNull(), F.concat(F.get("_between", i), x)).when(f["idx"] == i, F.concat(F.get("_between", i), f["to"])).otherwise("")

    rows = rows.withColumn("_between", between)
    fixed = F.concat(F.array_join(F.transform(said, piece), ""), F.element_at("_between", -1))
    out = F.when(F.col("_fixes").isNull(), F.col(text_col)).otherwise(fixed)
    return rows.select(*[(out if c == text_col else F.col(c)).alias(c) for c in texts.columns])


def session_speakers(labels: DataFrame, speakers: DataFrame, index: DataFrame, scope: Sequence[str], label: str = "label", out: str = "speaker", least: float = 0.6, within: float = 0.75) -> DataFrame:
    """labels with the recording's own speaker that each stands for, else the label itself.

    speakers(scope, name) are joined on the recording alone, which has few. The highest ratio counts, the first by name of
    equals; a label inside a name, or a name inside a label, is at least `within`. A label that is another person of
    index(name), with another last name than the speaker found, is not merged. A null label stays null.
    """
    low = lambda c: F.lower(F.trim(c))
    distinct = labels.select(*scope, label).where(F.col(label).isNotNull()).distinct()
    pairs = distinct.hint("merge").join(speakers.select(*scope, F.col("name").alias("_name")).where("_name is not null").distinct().hint("merge"), list(scope))
    a, b = low(F.col(label)), low(F.col("_name"))
    scored = pairs.withColumn("_ratio", F.greatest(ratcliff_ratio(a, b), F.when(a.contains(b) | b.contains(a), within).otherwise(0.0)))
    best = scored.groupBy(*scope, label).agg(F.min_by(F.struct("_name", "_ratio"), F.struct(-F.col("_ratio"), "_name")).alias("_b")).where(F.col("_b._ratio") >= least)
    people = index.select(low(F.col("name")).alias("_person"), F.lit(True).alias("_listed")).distinct()
    last = lambda c: F.element_at(F.split(low(c), r"(?U)\s+"), -1)
    best = best.hint("merge").join(people.hint("merge"), low(F.col(label)) == F.col("_person"), "left").where(F.col("_listed").isNull() | (last(F.col(label)) == last(F.col("_b._name"))))
    best = best.select(*[F.col(c).alias(f"_key_{c}") for c in (*scope, label)], F.col("_b._name").alias("_name"))
    return labels.join(best.hint("merge"), [F.col(c) == F.col(f"_key_{c}") for c in (*scope, label)], "left").select(*labels.columns, F.coalesce("_name", label).alias(out))
