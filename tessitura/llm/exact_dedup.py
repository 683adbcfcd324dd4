"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Only DataFrame functions are used. The first scan makes a small row of each document: its length and the hash of a
prefix. Lengths that several documents share pass on to the prefix level, prefixes that several share pass on to the
full hash, and only those texts are read whole and hashed. Groups are aggregated map-side first, so that a group with a
third of all rows reaches no single task. What each level passes on is a table of keys: it is counted, sent to all
executors where it is small, and joined by sorting where it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, materialize

PREFIX_CHARS = 64
#: Up to so many keys are sent to all executors.
SENT_KEYS = 200_000


def _hinted(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= SENT_KEYS else keys.hint("merge")


def _prefix(norm: Column, prefix_chars: int) -> Column:
    return F.xxhash64(F.substring(norm, 1, prefix_chars))


def refine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows(len, prefix, ...) that share their length with others, and those of them that share their prefix too."""
    lengths = materialize(rows.groupBy("len").agg(F.count("*").alias("_n")).where("_n > 1").select("len"), "lengths")
    by_length = rows.join(_hinted(lengths), "len", "left_semi")
    prefixes = materialize(by_length.groupBy("len", "prefix").agg(F.count("*").alias("_n")).where("_n > 1").select("len", "prefix"), "prefixes")
    return by_length, by_length.join(_hinted(prefixes), ["len", "prefix"], "left_semi")


def _classes(rows: DataFrame) -> DataFrame:
    """rows(id, len, prefix, sha, row) to a row for each text that several have: the row that stays, and how many there are."""
    groups = rows.groupBy("len", "prefix", "sha").agg(F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("n")).where("n > 1")
    return materialize(groups.select("len", "prefix", "sha", F.col("keep.id").alias("keep_id"), F.col("keep.row").alias("keep_row"), "n"), "classes")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One verdict for each row: id_col, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of a group the row with the largest id stays. A null text
    counts as empty. A null id is smaller than any other; a group of null ids alone keeps one of them, with a null
    keep_id. Of rows that repeat both id and text, one stays. Other columns are not looked at. An empty table gives an
    empty result. The digest is a column of the result, so the first scan takes it of every text; groups are found by
    the levels, and full hashes are compared only within what length and prefix leave.
    """
    norm = docs.select(F.col(id_col).alias("id"), lower_ascii(F.col(text_col)).alias("norm"), F.monotonically_increasing_id().alias("row"))
    rows = materialize(norm.select("id", "row", F.octet_length("norm").alias("len"), _prefix(F.col("norm"), prefix_chars).alias("prefix"), F.sha2("norm", 256).alias("sha")), "signatures")
    classes = _classes(refine(rows)[1])
    found = rows.join(classes.hint("merge"), ["len", "prefix", "sha"], "left")
    alone = F.col("n").isNull()
    return found.select(
        F.col("id").alias(id_col),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """docs without exact copies, all columns kept; which of the rows that repeat id and text stays is open.

    Full hashes are taken only of texts whose length and prefix several documents share. A dropped row is found again by
    its id, length and prefix, and by the full hash where these agree. See exact_dedup for nulls and ties.
    """
    d = docs.select(*[F.col(c).alias(f"d{i}") for i, c in enumerate(docs.columns)])  # their names can't clash then
    id_, text = (F.col(f"d{docs.columns.index(c)}") for c in (id_col, text_col))
    norm = lower_ascii(text)
    d = d.withColumn("len", F.octet_length(norm)).withColumn("prefix", _prefix(norm, prefix_chars))
    rows = materialize(d.select(id_.alias("id"), "len", "prefix"), "lengths_and_prefixes")
    shared = _hinted(materialize(refine(rows)[1].select("len", "prefix").distinct(), "shared"))
    hashed = d.join(shared, ["len", "prefix"], "left_semi").select(id_.alias("id"), "len", "prefix", F.sha2(norm, 256).alias("sha"))
    hashed = materialize(hashed.withColumn("row", F.monotonically_increasing_id()), "hashed")
    classes = _classes(hashed)
    place = ["g_id", "g_len", "g_prefix", "g_sha"]
    named = hashed.join(classes.hint("merge"), ["len", "prefix", "sha"]).select(F.col("id").alias("g_id"), F.col("len").alias("g_len"), F.col("prefix").alias("g_prefix"), F.col("sha").alias("g_sha"), F.col("id").eqNullSafe(F.col("keep_id")).alias("stays"))
    gone = materialize(named.where("not stays").select(*place).distinct(), "gone")
    # startswith: texts are hashed only where the other three agree, which an equality would make a key of the join.
    same = id_.eqNullSafe(F.col("g_id")) & (F.col("len") == F.col("g_len")) & (F.col("prefix") == F.col("g_prefix")) & F.startswith(F.sha2(norm, 256), F.col("g_sha"))
    left = d.join(_hinted(gone), same, "left_anti")
    repeated = materialize(named.where("stays").groupBy(*place).agg(F.count("*").alias("n")).where("n > 1").select(*place), "repeated")
    if not repeated.isEmpty():
        again = left.join(_hinted(repeated), same, "left_semi").withColumn("sha", F.sha2(norm, 256)).dropDuplicates([f"d{docs.columns.index(id_col)}", "len", "prefix", "sha"]).drop("sha")
        left = left.join(_hinted(repeated), same, "left_anti").union(again)
    return left.select(*[F.col(f"d{i}").alias(c) for i, c in enumerate(docs.columns)])
