"""Search: queries, sentences around hits, facets and snippets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.strings import java_quoted

# Words that a query drops if others remain.
FILLERS = ("the", "a", "an", "of", "and", "or", "in", "on", "to", "for", "with", "about", "what", "who", "is", "are", "was", "did", "does")


def parse_query(text: str) -> list[list[str]]:
    """Phrases to find: what is quoted, as typed; else each word but fillers, if others remain."""
    import re

    phrases = [p.lower().split() for p in re.findall(r'"([^"]+)"', text)]
    words = re.sub(r'"[^"]*"', " ", text).lower().split()
    left = [w for w in words if w not in FILLERS]
    return [p for p in phrases if p] + [[w] for w in (left or ([] if phrases else words))]


def sentences_with(sents: DataFrame, terms: Sequence[str], text_col: str = "sentence") -> DataFrame:
    """Sentences that hold every term as whole words, in any case."""
    for t in terms:
        sents = sents.where(F.col(text_col).rlike(rf"(?iU)(?<![\w']){java_quoted(t)}(?![\w'])"))
    return sents


def with_context(sents: DataFrame, keys: Sequence[str], order: Sequence[str], hit: Column, text_col: str = "sentence") -> DataFrame:
    """Sentences that hit, each with the one before and the one after of the same speaker (keys)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return sents.withColumn("before", F.lag(text_col).over(w)).withColumn("after", F.lead(text_col).over(w)).withColumn("_hit", hit).where("_hit").drop("_hit")


def facets(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """(facet, value, n) for each facet; empty values are hidden."""
    listed = F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in by])
    return rows.select(F.explode(listed).alias("f")).where("f.value is not null and f.value <> ''").groupBy("f.facet", "f.value").agg(F.count("*").alias("n"))


def snippet(c: Column, name: str, around: int = 60) -> Column:
    """What stands around a name's first mention, cut at words; null without one."""
    at = F.regexp_instr(c, F.lit(rf"(?iU)\b{java_quoted(name)}\b"))
    start = F.greatest(at - around, F.lit(1))
    cut = F.substring(c, start, F.lit(len(name) + 2 * around))
    cut = F.when(start > 1, F.regexp_replace(cut, r"(?s)^\S*\s+", "")).otherwise(cut)
    cut = F.when(start + len(name) + 2 * around <= F.length(c), F.regexp_replace(cut, r"(?s)\s+\S*$", "")).otherwise(cut)
    return F.when(at > 0, cut)
