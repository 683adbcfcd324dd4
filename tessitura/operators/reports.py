"""Reports over segments: quality, trouble, people, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.strings import count_words, either
from tessitura.functions.tables import written

from .clean import midsentence_capitals
from .sentences import sentences

# Phrases that speech recognition makes up.
PHANTOMS = r"(?iU)thanks? for watching|thank you for watching|subtitles? by|amara\.org|please subscribe|like and subscribe|transcribed by"
BRACKETS = r"\[[^\]]{2,25}\]"
MARKERS = r"\[[^\]]+\]"


def transcript_quality(segments: DataFrame, durations: DataFrame | None = None, key: str = "slug") -> DataFrame:
    """(key, words, seconds, wpm_x10, markers, low_confidence): low under 60 words a minute or with markers over 5 %."""
    per = segments.groupBy(key).agg(F.sum(count_words(F.col("text"))).alias("words"), F.sum(F.regexp_count("text", F.lit(MARKERS))).alias("markers"), F.max("end").alias("seconds"))
    if durations is not None:
        per = per.drop("seconds").join(durations, key, "left")
    wpm = F.col("words") / (F.col("seconds") / 60)
    low = (wpm < 60) | (F.col("markers") / F.greatest(F.col("words"), F.lit(1)) > 0.05)
    return per.select(key, "words", F.col("seconds").cast("long").alias("seconds"), F.round(wpm * 10).cast("long").alias("wpm_x10"), "markers", F.coalesce(low, F.lit(True)).alias("low_confidence"))


def sentence_loops(sents: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """(key, loops): runs of one sentence of three words or more that reach three in a row."""
    w = Window.partitionBy(key).orderBy(*order)
    norm = F.lower(F.trim("sentence"))
    same = F.coalesce((norm == F.lag(norm).over(w)) & (count_words(F.lag("sentence").over(w)) >= 3), F.lit(False))
    run = sents.withColumn("_run", F.sum(F.when(same, 0).otherwise(1)).over(w))
    return run.groupBy(key, "_run").agg(F.count("*").alias("n")).groupBy(key).agg(F.count_if(F.col("n") >= 3).alias("loops"))


def long_gaps(starts: DataFrame, key: str, at: str = "start", until: str | None = None, least: float = 90.0) -> DataFrame:
    """(key, gaps, gap_list): stretches of least seconds or more without a start; the first six are listed. until: a column with the end of all."""
    w = Window.partitionBy(key).orderBy(at)
    after = F.coalesce(F.lead(at).over(w), F.col(until) if until else F.lit(None).cast("double"))
    gap = starts.withColumn("_to", after).where(F.col("_to") - F.col(at) >= least)
    listed = F.array_sort(F.collect_list(F.struct(F.col(at).cast("long").alias("a"), F.col("_to").cast("long").alias("b"))))
    shown = F.array_join(F.transform(F.slice(listed, 1, 6), lambda g: F.concat(g["a"].cast("string"), F.lit("-"), g["b"].cast("string"), F.lit("s"))), "; ")
    return gap.groupBy(key).agg(F.count("*").alias("gaps"), shown.alias("gap_list"))


def trouble_report(segments: DataFrame, crosscheck: DataFrame | None = None, key: str = "slug", para_break: str = "\n") -> DataFrame:
    """One row for each recording with the signs of trouble a machine can see, and a score: 5 a loop, 3 a phantom
    phrase, 2 a long gap, 1 for each five bracket marks, 2 for a crosscheck under 0.6."""
    words = count_words(F.col("text"))
    base = segments.groupBy(key).agg(
        F.sum(words).alias("words"),
        F.sum(F.when(F.col("speaker").isNull(), words).otherwise(0)).alias("unattributed"),
        F.sum(F.regexp_count("text", F.lit(BRACKETS))).alias("brackets"),
        F.max("end").alias("seconds"),
    )
    paras = segments.select(key, "seg", F.posexplode(F.split("text", para_break)).alias("para", "text"))
    sents = sentences(paras, [key, "seg", "para"])
    loops = sentence_loops(sents, key, ["seg", "para", "sent"])
    phantoms = sents.groupBy(key).agg(F.count_if(F.col("sentence").rlike(PHANTOMS)).alias("phantoms"))
    gaps = long_gaps(segments.join(base.select(key, "seconds"), key), key, "start", "seconds")
    found = base.join(loops.hint("merge"), key, "left").join(phantoms.hint("merge"), key, "left").join(gaps.hint("merge"), key, "left")
    if crosscheck is not None:
        found = found.join(crosscheck, key, "left")
    else:
        found = found.withColumn("crosscheck", F.lit(None).cast("double"))
    found = found.fillna(0, ["loops", "phantoms", "gaps"])
    score = F.col("loops") * 5 + F.col("phantoms") * 3 + F.col("gaps") * 2 + F.floor(F.col("brackets") / 5) + F.when(F.col("crosscheck") < 0.6, 2).otherwise(0)
    return found.select(
        score.cast("long").alias("score"),
        key,
        "words",
        F.round(F.col("words") / (F.col("seconds") / 60) * 10).cast("long").alias("wpm_x10"),
        F.round(100 * F.col("unattributed") / F.greatest(F.col("words"), F.lit(1))).cast("long").alias("unattributed_pct"),
        "loops",
        "phantoms",
        "gaps",
        F.coalesce("gap_list", F.lit("")).alias("gap_list"),
        "brackets",
    )


def speech_totals(segments: DataFrame, key: str = "slug") -> DataFrame:
    """(speaker, recordings, turns, words, first_slug, first_seg, first_text) for each identified speaker."""
    first = F.struct(key, "seg")
    return segments.where("speaker is not null").groupBy("speaker").agg(
        F.count_distinct(key).alias("recordings"),
        F.count("*").alias("turns"),
        F.sum(count_words(F.col("text"))).alias("words"),
        F.min(first).alias("f"),
        F.min_by("text", first).alias("first_text"),
    ).select("speaker", "recordings", "turns", "words", F.col(f"f.{key}").alias("first_slug"), F.col("f.seg").alias("first_seg"), "first_text")


def ordinary_words(texts: DataFrame, text_col: str = "text", least: int = 30, times: int = 30) -> DataFrame:
    """(word, lower, upper): words seen at least so often in lower case, and so many times as often as with a capital inside a sentence."""
    token = F.explode(F.regexp_extract_all(text_col, F.lit(r"(?U)(?:[.?!…][\"'”’)\]]*\s+)?[A-Za-z]+"), F.lit(0)))
    t = texts.select(token.alias("t"))
    word = F.regexp_extract("t", "([A-Za-z]+)$", 1)
    starts = F.col("t").rlike(r"(?U)\s")
    counts = t.select(F.lower(word).alias("word"), (word == F.lower(word)).cast("int").alias("l"), (word.rlike("^[A-Z]") & ~starts).cast("int").alias("u"))
    return counts.groupBy("word").agg(F.sum("l").alias("lower"), F.sum("u").alias("upper")).where((F.col("lower") >= least) & (F.col("lower") >= times * F.col("upper")))


def capital_suspects(texts: DataFrame, ordinary: DataFrame, key: str, text_col: str = "text", around: int = 4) -> DataFrame:
    """(key, idx, word, total, context): ordinary words with a capital inside a sentence, how often each is so in all texts,
    and the words around it."""
    hits = written(midsentence_capitals(texts, ordinary, key, text_col, around), "capitals")
    totals = hits.groupBy("word").agg(F.count("*").alias("total"))
    return hits.join(totals.hint("merge"), "word").select(key, "idx", "word", "total", "context")


def collapse_queue(rows: DataFrame, noise: int = 10) -> DataFrame:
    """Review rows(row, session, candidate, matched, similarity, context) by lower-case match and candidate: count, first
    casing, best similarity and its context (first of equals), sessions, and whether it is noise."""
    best = F.struct("similarity", -F.col("row"))
    found = rows.groupBy(F.lower(F.trim("matched")).alias("m"), "candidate").agg(
        F.count("*").alias("n"), F.min_by("matched", "row").alias("matched"), F.max("similarity").alias("similarity"), F.max_by("context", best).alias("context"), F.array_join(F.array_sort(F.collect_set("session")), ", ").alias("sessions")
    )
    return found.drop("m").withColumn("noise", F.col("n") >= noise)


def gap_report(rows: DataFrame, id_col: str, gaps: dict[str, Column]) -> DataFrame:
    """(gap, id): a row for each thing that is missing."""
    listed = F.array(*[F.struct(F.lit(k).alias("gap"), F.coalesce(c, F.lit(False)).alias("is")) for k, c in gaps.items()])
    return rows.select(id_col, F.explode(F.filter(listed, lambda g: g["is"])).alias("g")).select("g.gap", id_col)


def top_per(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first n of each group."""
    return rows.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def even_sample(rows: DataFrame, key: str, order: Sequence[str], most: int) -> DataFrame:
    """At most so many rows of each key, evenly spread: those at int(i * count / most)."""
    w = Window.partitionBy(key)
    numbered = rows.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    # Row i is int(j * n / most) for some j < most if and only if the least j with j * n / most >= i gives it.
    j = F.ceil(F.col("_i") * most / F.col("_n"))
    hit = (F.col("_n") <= most) | ((j < most) & (F.floor(j * F.col("_n") / most) == F.col("_i")))
    return numbered.where(hit).drop("_i", "_n")


def stats_by_type(rows: DataFrame, type_col: str, date_col: str, seconds_col: str) -> DataFrame:
    """(type, n, hours, first_year, last_year), and all types together as null."""
    return rows.groupingSets([[type_col], []], type_col).agg(F.count("*").alias("n"), F.round(F.sum(seconds_col) / 3600).cast("long").alias("hours"), F.min(F.year(date_col)).alias("first_year"), F.max(F.year(date_col)).alias("last_year"))


def occurrences(texts: DataFrame, key: str, pattern: str, around: int = 30, text_col: str = "text") -> DataFrame:
    """(key, hit, context): each match with what stands around it, up to the next match on either side."""
    hits, between = F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0)), F.split(text_col, pattern, -1)
    made = F.transform(hits, lambda h, i: F.struct(h.alias("hit"), F.concat(F.right(F.get(between, i), F.lit(around)), h, F.left(F.get(between, i + 1), F.lit(around))).alias("context")))
    return texts.select(key, F.explode(made).alias("o")).select(key, "o.hit", "o.context")


def metric_rollup(facts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Clicks, impressions, their rate in percent and the position weighed by impressions."""
    s = facts.groupBy(*by).agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"), F.sum(F.col("position") * F.col("impressions")).alias("p"))
    return s.select(*by, "clicks", "impressions", F.round(10000 * F.col("clicks") / F.col("impressions")).cast("long").alias("ctr_bp"), F.round(100 * F.col("p") / F.col("impressions")).cast("long").alias("position_x100"))


def change_between(before: DataFrame, after: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """A value before and after by key, 0 where a side lacks the key, and the difference."""
    a, b = before.select(*by, F.col(value).alias("before")), after.select(*by, F.col(value).alias("after"))
    both = a.join(b, list(by), "full").fillna(0, ["before", "after"])
    return both.withColumn("change", F.col("after") - F.col("before"))


def contact_counts(texts: DataFrame, key: str, text_col: str = "text", junk: Sequence[str] = ("example", "sentry", "wixpress")) -> DataFrame:
    """(key, mailto, plain, obfuscated): how many addresses a page shows in each way, junk hosts left out. Counts only."""
    c = F.lower(F.col(text_col))
    address = r"[a-z0-9][a-z0-9._%+-]*@(?!(?:[a-z0-9-]+\.)*(?:" + either(junk) + r")\.)[a-z0-9-]+(?:\.[a-z0-9-]+)*\.[a-z]{2,}"
    mailto = F.regexp_count(c, F.lit("mailto:" + address))
    return texts.select(key, mailto.cast("long").alias("mailto"), (F.regexp_count(c, F.lit(address)) - mailto).cast("long").alias("plain"), F.regexp_count(c, F.lit(r"[a-z0-9._-]+ at [a-z0-9-]+ dot [a-z]{2,}\b|data-cfemail=")).cast("long").alias("obfuscated"))


def publication_state(items: DataFrame, published: DataFrame, key: str, hash_col: str) -> DataFrame:
    """(key, state): current, changed, failed or to do."""
    p = published.select(F.col(key).alias("_k"), F.col(hash_col).alias("_h"), F.col("failed").alias("_f"))
    j = items.join(p, F.col(key) == F.col("_k"), "left")
    state = F.when(F.col("_k").isNull(), "to do").when(F.col("_f"), "failed").when(F.col("_h") == F.col(hash_col), "current").otherwise("changed")
    return j.select(key, state.alias("state"))
