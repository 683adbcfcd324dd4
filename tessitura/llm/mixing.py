"""Mixing sources to target weights by Pareto order sampling.

A source whose target is f times its size takes floor(f) whole copies of each document for certain. The rest is a sample
of fixed size in words with unequal odds: a document's inclusion odds grow with its size, pi = min(1, c * size), so that
the expected words meet what is left; documents with pi = 1 are whole copies for certain too. Documents are ranked by
their random odds divided by their inclusion odds, and taken in that order until the words are met. The order is cut
without sorting a source in one place: sizes are summed over fine buckets of the rank, the running sum over those few
rows finds the bucket that the cut falls into, and only that bucket's documents are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
MAX_REPEATS = 2.0
BUCKETS = 1 << 12
#: Sources are a dimension of the mix that the driver sees; more of them than this is an error.
MAX_SOURCES = 100_000


def fill_targets(sizes: list[tuple[str | None, int]], weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: float = MAX_REPEATS) -> dict[str | None, float]:
    """Share budget times all sizes by weight among the sources, in order of code points with null last and the weights
    repeating. No target is over max_repeats times its source; what is over is shared anew by weight among the rest."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    left = budget * sum(n for _, n in order)
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    limit = {s: max_repeats * n for s, n in order}
    share = sum(weight.values())
    targets: dict[str | None, float] = {}
    for s in sorted(weight, key=lambda s: (limit[s] / weight[s], s is None, s or "")):
        targets[s] = min(limit[s], left / share * weight[s])
        left -= targets[s] if targets[s] == limit[s] else 0
        share -= weight[s] if targets[s] == limit[s] else 0
    return targets


def uniform(id_col: Column) -> Column:
    """A number in (0, 1) that depends on the id alone: 48 bits of its md5."""
    digits = F.substring(F.md5(F.encode(F.coalesce(id_col.cast("string"), F.lit("null")), "UTF-8")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def _size(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def inclusion_rates(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(_s, _rate) for each source with a sample: the c at which the sum of min(1, c * size) * size is what is left.

    rows has (source, size). Sizes are counted first, so that a source is as many rows as it has different sizes. Of the
    largest sizes those are certain at which the c of the rest would still be 1 / size or more.
    """
    per_size = rows.groupBy("source", "size").agg(F.count("*").alias("k")).where("size > 0")
    at = plan.where("_rest > 0").select(F.col("_source").alias("_s"), "_rest")
    per_size = per_size.join(F.broadcast(at), per_size["source"].eqNullSafe(at["_s"]))  # MAX_SOURCES rows at most
    down = Window.partitionBy("_s").orderBy(F.desc("size"))
    squares = F.sum(F.col("size").cast("decimal(38,0)") * F.col("size") * F.col("k"))
    squares = squares.over(down.rowsBetween(Window.currentRow, Window.unboundedFollowing)).cast("double")
    larger = F.coalesce(F.sum(F.col("size") * F.col("k")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rate = per_size.select("_s", "size", ((F.col("_rest") - larger) / squares).alias("_rate"))
    return rate.where(F.col("_rate") * F.col("size") < 1).groupBy("_s").agg(F.max_by("_rate", "size").alias("_rate"))


def _with_odds(rows: DataFrame, plan: DataFrame, id_col: str, source_col: str, size_col: str) -> DataFrame:
    """rows with their source's plan and their ratio of odds, random by inclusion; null where nothing is sampled."""
    u, pi = uniform(F.col(id_col)), F.least(F.lit(1.0), F.col("_rate") * F.col(size_col))
    odds = F.when(F.col("_rest") > 0, F.when(pi > 0, (u / (1 - u)) * ((1 - pi) / pi)))
    joined = rows.join(F.broadcast(plan), rows[source_col].cast("string").eqNullSafe(plan["_source"])).drop("_source")  # MAX_SOURCES rows at most
    return joined.withColumn("_odds", odds).withColumn("_bucket", F.floor(F.col("_odds") / (1 + F.col("_odds")) * BUCKETS))


def plan_mix(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """rows(id, source, size), written before, to a row for each source, MAX_SOURCES at most: its size and target, the
    whole copies, the rate of inclusion, and where the sample's order is cut."""
    spark = rows.sparkSession
    sizes = rows.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(sizes) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    targets = fill_targets([(r["source"], r["n"]) for r in sizes], weights, budget, max_repeats)
    plan = spark.createDataFrame([(r["source"], r["n"], targets[r["source"]]) for r in sizes], "_source string, _source_size long, _target double").coalesce(1)
    per_word = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("_whole", F.floor(per_word)).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    rates = materialize(inclusion_rates(rows, plan), "rates")
    plan = materialize(plan.join(F.broadcast(rates), plan["_source"].eqNullSafe(rates["_s"]), "left").drop("_s"), "targets")  # a row for each source
    ranked = _with_odds(rows, plan, "id", "source", "size").where("_odds is not null")
    sums = ranked.groupBy("source", "_bucket", "_rest").agg(F.sum("size").alias("n"))
    earlier = lambda *by: Window.partitionBy("source").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.withColumn("before", F.coalesce(F.sum("n").over(earlier("_bucket")), F.lit(0)))
    cut = materialize(before.where("before <= _rest and _rest < before + n").select(F.col("source").alias("s"), F.col("_bucket").alias("_cut"), "before"), "cuts")
    at_cut = ranked.join(F.broadcast(cut), ranked["source"].eqNullSafe(cut["s"]) & (ranked["_bucket"] == cut["_cut"]))  # a row for each source
    level = at_cut.groupBy("source", "_odds", "_rest", "before").agg(F.sum("size").alias("n"))
    reached = F.col("before") + F.coalesce(F.sum("n").over(earlier("_odds")), F.lit(0))
    last = level.withColumn("reached", reached).where(F.col("reached") + F.col("n") / 2 <= F.col("_rest")).groupBy("source").agg(F.max("_odds").alias("_last")).withColumnRenamed("source", "l")
    planned = plan.join(F.broadcast(cut.select("s", "_cut")), plan["_source"].eqNullSafe(cut["s"]), "left").join(F.broadcast(last), plan["_source"].eqNullSafe(last["l"]), "left").drop("s", "l")
    return materialize(planned, "plan")


def _copies() -> Column:
    """Whole copies, and one more up to the cut. Without a cut all of the source fits."""
    up_to = F.col("_cut").isNull() | (F.col("_bucket") < F.col("_cut")) | F.coalesce(F.col("_odds") <= F.col("_last"), F.lit(False))
    return (F.col("_whole") + F.when(F.col("_odds").isNull() | ~up_to, 0).otherwise(1)).cast("int")


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return materialize(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), _size(text_col).alias("size")), "sizes")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row for each row of docs: id_col, size, source_size, target, copies, taken (copies times size).

    size counts words; a null text has none, and a document without words is never in the sample. A null source is a
    source. Ids and sizes alone decide the sample, so reruns agree; rows of a source that share id and size are taken
    alike. A document is taken if at least half of it fits before the cut. Where all sizes are 0 all targets are 0. Other
    columns are not looked at; no rows give no rows.
    """
    rows = _sizes(docs, id_col, text_col, source_col)
    found = _with_odds(rows, plan_mix(rows, **how), "id", "source", "size").withColumn("copies", _copies())
    return found.select(F.col("id").alias(id_col), "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """docs as the mix takes them: rows not taken are left out, those taken twice come twice; all columns are kept.

    Words are counted once more where the texts are, as ids need not tell rows apart."""
    plan = plan_mix(_sizes(docs, id_col, text_col, source_col), **how)
    rows = docs.select(*[F.col(c).alias(f"d{i}") for i, c in enumerate(docs.columns)])  # their names can't clash then
    at = {c: f"d{i}" for i, c in enumerate(docs.columns)}
    rows = rows.withColumn("_size", _size(at[text_col]))
    found = _with_odds(rows, plan, at[id_col], at[source_col], "_size").withColumn("_copies", _copies()).where("_copies > 0")
    return found.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*[F.col(at[c]).alias(c) for c in docs.columns])
