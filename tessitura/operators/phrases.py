"""Rewriting texts by a dictionary of any size.

Each phrase is filed under one word, the rarest in the texts of those that a match must hold. Texts meet the phrases by
equality of that word, so a text is only searched for phrases whose word it has. What is found is replaced by a fold in the
row, in the dictionary's order, as one substitution after another would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.tables import written

WORD = r"(?U)\w+"
#: Rounds in which replacements may bring in words of further phrases.
ROUNDS = 16


def words_of(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))


def pattern_of(phrase: Column, whole: Column) -> Column:
    """A phrase as a pattern in any case; a whole one has no letter or digit beside it."""
    body = F.regexp_replace(phrase, r"([^\w\s])", r"\\$1")
    return F.concat(F.lit("(?iU)"), F.when(whole, r"(?<!\w)").otherwise(""), body, F.when(whole, r"(?!\w)").otherwise(""))


def _dictionary(phrases: DataFrame) -> DataFrame:
    """(id, phrase, replacement, ord, whole, place, word, kind): a row for each word that a phrase may be filed under.

    A whole phrase's words all stand as they are in a text. Another's first and last may be parts of longer words: it goes
    by its inner words; with two words by its first, which ends a word; with one by that, which lies in a word.
    """
    p = phrases.select(
        "phrase",
        F.col("replacement") if "replacement" in phrases.columns else F.col("phrase").alias("replacement"),
        (F.col("ord") if "ord" in phrases.columns else -F.length("phrase")).cast("long").alias("ord"),
        (F.coalesce("whole", F.lit(False)) if "whole" in phrases.columns else F.lit(False)).alias("whole"),
    ).where("phrase is not null and replacement is not null")
    p = p.withColumn("id", F.xxhash64("phrase", "replacement", "ord", "whole")).dropDuplicates(["id"]).withColumn("w", words_of(F.col("phrase"))).withColumn("n", F.size("w"))
    inner = F.when(F.col("whole") | (F.col("n") < 3), F.col("w")).otherwise(F.slice("w", 2, F.greatest(F.col("n") - 2, F.lit(1))))
    kind = F.when(F.col("whole") | (F.col("n") > 2), "whole").when(F.col("n") == 2, "tail").otherwise("inside")
    filed = p.withColumn("kind", kind).withColumn("w", F.when(F.col("kind") == "tail", F.slice("w", 1, 1)).otherwise(inner))
    return filed.select("id", "phrase", "replacement", "ord", "whole", "kind", "n", F.posexplode_outer("w").alias("place", "word"))


def _forms(vocabulary: DataFrame, kinds: set[str], longest: int) -> DataFrame:
    """(v, kind, word): the words, ends and parts by which a word v of a text can meet a phrase; made of distinct words."""
    whole = [F.struct(F.lit("whole").alias("kind"), F.col("v").alias("word"))]
    forms = F.array(*whole)
    n = F.length("v")
    if "tail" in kinds:
        ends = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(longest))), lambda k: F.struct(F.lit("tail").alias("kind"), F.right("v", k).alias("word")))
        forms = F.concat(forms, ends)
    if "inside" in kinds:
        starts = F.sequence(F.lit(1), n)
        parts = F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.least(n - i + 1, F.lit(longest))), lambda k: F.struct(F.lit("inside").alias("kind"), F.substring("v", i, k).alias("word"))))
        forms = F.concat(forms, F.array_distinct(F.flatten(parts)))
    return vocabulary.select("v", F.explode(forms).alias("f")).select("v", "f.kind", "f.word")


def candidates(texts: DataFrame, phrases: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, phrase, replacement, ord, whole): the phrases that each text may hold, by the word they are filed under.

    phrases(phrase[, replacement, ord, whole]): the order is by ord, longer phrases first where there is none. A phrase
    without a letter or digit can't be filed and raises an error. Nulls in phrases are left out; a null text has no words.
    """
    entries = written(_dictionary(phrases), "dictionary")
    facts = entries.agg(F.count_if(F.col("word").isNull()).alias("bare"), F.max(F.length("word")).alias("longest"), F.collect_set("kind").alias("kinds")).first()  # three kinds
    if facts["bare"]:
        raise ValueError(f"{facts['bare']} phrases have no letter or digit")
    kinds, longest = set(facts["kinds"]), facts["longest"] or 1
    held = texts.select(F.col(key).alias("key"), F.explode(F.array_distinct(words_of(F.col(text_col)))).alias("v"))
    if kinds <= {"whole"}:  # a word can only be met as it is: those of no phrase are not kept
        held = held.join(written(entries.select("word").distinct(), "filed_words"), F.col("v") == F.col("word"), "left_semi")
    held = written(held, "words")
    counts = held.groupBy("v").agg(F.count("*").alias("texts"))
    brought = entries.select(F.explode(words_of(F.col("replacement"))).alias("v")).distinct().withColumn("texts", F.lit(0).cast("long"))
    vocabulary = written(counts.union(brought).groupBy("v").agg(F.sum("texts").alias("texts")), "vocabulary")
    wanted = entries.select("kind", "word").distinct()
    forms = written(_forms(vocabulary.select("v"), kinds, longest).join(wanted.hint("shuffle_hash"), ["kind", "word"], "left_semi"), "forms")
    frequency = forms.join(vocabulary.hint("merge"), "v").groupBy("kind", "word").agg(F.sum("texts").alias("texts"))
    rarest = Window.partitionBy("id").orderBy("texts", "place")
    # A phrase with a word that no text and no replacement has can't be there.
    ranked = entries.join(frequency.hint("merge"), ["kind", "word"], "left").withColumn("r", F.row_number().over(rarest)).withColumn("none", F.max(F.col("texts").isNull()).over(Window.partitionBy("id")))
    filed = written(ranked.where("r = 1 and not none").drop("r", "none", "texts", "place", "n"), "filed")
    by_word = written(forms.join(filed.hint("merge"), ["kind", "word"]).select("v", "id").distinct(), "by_word")
    found = written(held.join(by_word.hint("merge"), "v").select("key", "id").distinct(), "found")
    # What a replacement brings in may hold words of other phrases, which no text had.
    feeds = entries.select("id", F.explode(F.array_except(words_of(F.col("replacement")), words_of(F.col("phrase")))).alias("v")).join(by_word.withColumnRenamed("id", "fed").hint("merge"), "v").where("id <> fed").select("id", "fed").distinct()
    feeds = written(feeds, "feeds")
    if not feeds.isEmpty():
        fresh = found
        for _ in range(ROUNDS):
            known = found.select(F.col("key").alias("k"), F.col("id").alias("i"))
            brought = fresh.join(feeds.hint("merge"), "id").select("key", F.col("fed").alias("id")).distinct()
            fresh = written(brought.join(known.hint("merge"), F.col("key").eqNullSafe(F.col("k")) & (F.col("id") == F.col("i")), "left_anti"), "fed")
            if fresh.isEmpty():
                break
            found = written(found.union(fresh), "found")
        else:
            raise RuntimeError(f"replacements bring in new phrases after {ROUNDS} rounds")
    return found.join(filed.hint("merge"), "id").select(F.col("key").alias(key), "phrase", "replacement", "ord", "whole")


def _with_candidates(texts: DataFrame, phrases: DataFrame, key: str, text_col: str) -> DataFrame:
    """texts with _found, their candidates in the dictionary's order."""
    found = candidates(texts, phrases, key, text_col)
    entry = F.struct("ord", "phrase", "replacement", pattern_of(F.col("phrase"), F.col("whole")).alias("pattern"))
    grouped = found.groupBy(F.col(key).alias("_key")).agg(F.array_sort(F.collect_list(entry)).alias("_found"))
    return texts.join(grouped.hint("merge"), F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def replace_phrases(texts: DataFrame, phrases: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """texts with each phrase replaced, in any case, in the dictionary's order, each in the text that those before left.

    Rows of texts are kept as they are otherwise; several rows of one key are each rewritten. A phrase that arises only where a
    replacement meets letters beside it, within one word, is not found.
    """
    rows = _with_candidates(texts, phrases, key, text_col)
    literal = lambda c: F.regexp_replace(c, r"([\\$])", r"\\$1")
    fixed = F.aggregate("_found", F.col(text_col), lambda t, p: F.regexp_replace(t, p["pattern"], literal(p["replacement"])))
    return rows.withColumn(text_col, F.when(F.col("_found").isNull(), F.col(text_col)).otherwise(fixed)).select(*texts.columns)


def count_phrases(texts: DataFrame, phrases: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(phrase, hits, texts): how often each phrase occurs, in any case, and in how many rows; 0 for those that never do."""
    rows = _with_candidates(texts, phrases.select("phrase", *[c for c in ("ord", "whole") if c in phrases.columns]), key, text_col).where("_found is not null")
    each = rows.select(F.explode(F.transform("_found", lambda p: F.struct(p["phrase"].alias("phrase"), F.regexp_count(F.col(text_col), p["pattern"]).alias("n")))).alias("h"))
    counted = each.groupBy("h.phrase").agg(F.sum("h.n").alias("hits"), F.count_if(F.col("h.n") > 0).alias("texts"))
    listed = phrases.select("phrase").where("phrase is not null").distinct()
    none = F.lit(0).cast("long")
    return listed.join(counted.hint("merge"), "phrase", "left").select("phrase", F.coalesce("hits", none).alias("hits"), F.coalesce("texts", none).alias("texts"))
