"""Tokens, sentences, n-grams and their times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.strings import either, words

# Abbreviations that end in a period.
ABBREVIATIONS = ("mr.", "mrs.", "ms.", "dr.", "st.", "vs.", "etc.", "e.g.", "i.e.", "no.", "jr.", "sr.", "prof.")
SENTENCE_END = "[.?!…][\"'”’)\\]]*$"


def tokens(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, idx, token, at): at is the token's offset in the text with single spaces."""
    list_ = words(F.col(text_col))
    rows = texts.select(*keys, F.posexplode(list_).alias("idx", "token"))
    w = Window.partitionBy(*keys).orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("at", F.coalesce(F.sum(F.length("token") + 1).over(w), F.lit(0)).cast("long"))


def ends_sentence(token: Column) -> Column:
    return token.rlike(SENTENCE_END) & ~F.lower(token).isin(*ABBREVIATIONS)


def split_sentences(c: Column) -> Column:
    """The sentences of a paragraph with single spaces, as an array in the row: no explode, no shuffle. The space after a
    word that ends a sentence becomes a line end, except after an abbreviation; the text is cut there."""
    t = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    t = F.regexp_replace(t, "([.?!…][\"'”’)\\]]*) ", "$1\n")
    t = F.regexp_replace(t, rf"(?i)(?<![^ \n])({either(ABBREVIATIONS)})\n", "$1 ")
    return F.filter(F.split(t, "\n"), lambda x: x != "")


def sentences(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, sent, sentence), numbered from 0."""
    return texts.select(*keys, F.posexplode(split_sentences(F.col(text_col))).alias("sent", "sentence"))


def time_at(tmap: Column, fraction: Column) -> Column:
    """Seconds at a fraction, from a map of (frac, sec) in ascending order; its ends hold beyond it. Where two points share
    a fraction, the later time counts."""
    later = F.filter(tmap, lambda p: p["frac"] >= fraction)
    earlier = F.filter(tmap, lambda p: p["frac"] < fraction)
    b, a = F.get(later, F.lit(0)), F.try_element_at(earlier, F.lit(-1))
    return F.when(fraction <= tmap[0]["frac"], tmap[0]["sec"]).when(b.isNull(), F.try_element_at(tmap, F.lit(-1))["sec"]).otherwise(a["sec"] + (b["sec"] - a["sec"]) * (fraction - a["frac"]) / (b["frac"] - a["frac"]))


def sentence_times(paragraphs: DataFrame, keys: list[str], text_col: str = "text", start_col: str = "start", end_col: str = "end") -> DataFrame:
    """(keys, sent, sentence, start_cs): start times in centiseconds by place in the text, never falling."""
    rows = paragraphs.select(*keys, start_col, end_col, F.length(F.array_join(words(F.col(text_col)), " ")).alias("len"), F.posexplode(split_sentences(F.col(text_col))).alias("sent", "sentence"))
    w = Window.partitionBy(*keys).orderBy("sent")
    before = F.coalesce(F.sum(F.length("sentence") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    part = before / F.greatest(F.col("len"), F.lit(1))
    placed = rows.withColumn("t", F.col(start_col) + (F.col(end_col) - F.col(start_col)) * part)
    return placed.select(*keys, "sent", "sentence", F.round(F.max("t").over(w) * 100).cast("long").alias("start_cs"))


def sentence_times_by_map(paragraphs: DataFrame, keys: list[str], text_col: str = "text", start_col: str = "start", map_col: str = "tmap") -> DataFrame:
    """(keys, sent, sentence, start_cs): start times by the paragraph's time map (see time_at): the first sentence starts where
    the paragraph does, the others where the map says, never falling; without a map all start with the paragraph."""
    rows = paragraphs.select(*keys, start_col, map_col, F.length(F.array_join(words(F.col(text_col)), " ")).alias("len"), F.posexplode(split_sentences(F.col(text_col))).alias("sent", "sentence"))
    w = Window.partitionBy(*keys).orderBy("sent")
    before = F.coalesce(F.sum(F.length("sentence") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = rows.withColumn("part", before / F.greatest(F.col("len"), F.lit(1)))
    t = F.when(F.col("sent") == 0, F.col(start_col)).otherwise(F.coalesce(F.when(F.size(map_col) > 0, time_at(F.col(map_col), F.col("part"))), F.col(start_col)))
    return placed.withColumn("t", t).select(*keys, "sent", "sentence", F.round(F.max("t").over(w) * 100).cast("long").alias("start_cs"))


def ngram_lists(texts: DataFrame, keys: list[str], n: int, text_col: str = "text") -> DataFrame:
    """(keys, grams): the runs of n lower-case words of a text in order, as an array in the row; no row for fewer words."""
    w = F.regexp_extract_all(F.lower(text_col), F.lit(r"(?U)\w+"), F.lit(0))
    rows = texts.select(*keys, w.alias("w")).where(F.size("w") >= n)
    grams = F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.concat_ws(" ", *[F.get("w", i + k) for k in range(n)]))  # slice() would copy the whole array each time
    return rows.select(*keys, grams.alias("grams"))


def ngrams(texts: DataFrame, keys: list[str], n: int, text_col: str = "text") -> DataFrame:
    """(keys, idx, gram): runs of n lower-case words; made in the row."""
    # No list is empty. From a plain posexplode the optimizer infers a filter on its size, pushes it down to the text, and there
    # cuts the text into words anew for each word of each run.
    return ngram_lists(texts, keys, n, text_col).select(*keys, F.posexplode_outer("grams").alias("idx", "gram"))


def spread_words(cues: DataFrame, keys: list[str], text_col: str = "text", start_col: str = "start", end_col: str = "end") -> DataFrame:
    """(keys, idx, start, token): a cue's words spread evenly over it; a missing end is start + max(0.35 per word, 1)."""
    # The words are a column before they become rows: what stands beside a generator is worked out for each of its rows.
    listed = cues.select(*keys, F.col(start_col).alias("s"), F.col(end_col).alias("e"), words(F.col(text_col)).alias("w"))
    end = F.coalesce("e", F.col("s") + F.greatest(0.35 * F.size("w"), F.lit(1.0)))
    rows = listed.select(*keys, "s", end.alias("e"), F.size("w").alias("n"), "w").select(*keys, "s", "e", "n", F.posexplode_outer("w").alias("idx", "token")).where("token is not null")
    return rows.select(*keys, "idx", (F.col("s") + (F.col("e") - F.col("s")) * F.col("idx") / F.col("n")).alias("start"), "token")


def spread_lists(cues: DataFrame, keys: list[str], text_col: str = "text", start_col: str = "start", end_col: str = "end") -> DataFrame:
    """(keys, first, last, times, tokens): spread_words as arrays in the cue's row, and its first and last time; no row for a cue
    without words."""
    listed = cues.select(*keys, F.col(start_col).alias("s"), F.col(end_col).alias("e"), words(F.col(text_col)).alias("tokens"))
    end = F.coalesce("e", F.col("s") + F.greatest(0.35 * F.size("tokens"), F.lit(1.0)))
    rows = listed.select(*keys, "s", end.alias("e"), F.size("tokens").alias("n"), "tokens").where("n > 0")
    at = lambda i: F.col("s") + (F.col("e") - F.col("s")) * i / F.col("n")
    return rows.select(*keys, at(F.lit(0)).alias("first"), at(F.col("n") - 1).alias("last"), F.transform(F.sequence(F.lit(0), F.col("n") - 1), at).alias("times"), "tokens")


def time_maps(words_: DataFrame, texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, para, idx, frac, sec): where in its paragraph each word begins and when, if words_(key, idx, start) are as many
    as the text's tokens; no rows for a key where they are not."""
    t = tokens(texts, [key, "para"], text_col)
    t = t.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy("para", "idx")) - 1)
    size = t.withColumn("_len", F.length("token")).groupBy(key, "para").agg(F.max(F.col("at") + F.col("_len")).alias("len"))
    counts = t.groupBy(key).agg(F.count("*").alias("a")).hint("merge").join(words_.groupBy(key).agg(F.count("*").alias("b")).hint("merge"), key).where("a = b").select(key)
    w = words_.select(key, (F.row_number().over(Window.partitionBy(key).orderBy("start", "idx")) - 1).alias("n"), F.col("start").alias("sec"))
    return t.hint("merge").join(w.hint("merge"), [key, "n"]).join(size.hint("merge"), [key, "para"]).join(counts.hint("merge"), key, "left_semi").select(key, "para", "idx", (F.col("at") / F.greatest(F.col("len"), F.lit(1))).alias("frac"), "sec")


def paragraph_starts(segments: DataFrame, keys: list[str], starts_col: str = "starts", start_col: str = "start", para_break: str = "\n\n") -> DataFrame:
    """(keys, para, start): the times in starts if they are as many as the paragraphs, else the turn's for the first and none for the rest; the first always takes the turn's."""
    n = F.size(F.split("text", para_break))
    none = F.transform(F.sequence(F.lit(1), n), lambda i: F.lit(None).cast("double"))
    times = F.when(F.size(starts_col) == n, F.col(starts_col)).otherwise(none)
    first = F.transform(times, lambda x, i: F.when(i == 0, F.col(start_col)).otherwise(x))
    return segments.select(*keys, F.posexplode(first).alias("para", "start"))
