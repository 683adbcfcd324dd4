"""Line dedup over overlapping windows of three lines.

Only DataFrame functions are used. Each window of three consecutive lines that have a word is hashed to 128 bits; the
repeated hashes and their first occurrences are found globally, with the minimum taken map-side first, so that a window
that a third of all documents hold is a few rows. Later occurrences cover line ranges, which islands merge; the text is
put together from the ranges between them, in time linear in its lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

HAS_WORD = r"[^\x20\x09-\x0D]"


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, first, last, h1, h2): first and last are line numbers from 0."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.split(F.coalesce(text_col, F.lit("")), "\n").alias("lines"))
    numbered = F.filter(F.transform("lines", lambda x, i: F.struct(i.alias("i"), x.alias("x"))), lambda s: s["x"].rlike(HAS_WORD))
    rows = rows.select("id", "text_hash", numbered.alias("l")).where(F.size("l") >= 3)

    def window(i):
        a, b, c = (F.col("l")[i + k] for k in range(3))
        return F.struct(a["i"].alias("first"), c["i"].alias("last"), F.xxhash64(a["x"], b["x"], c["x"]).alias("h1"), F.xxhash64(F.lit(1), c["x"], b["x"], a["x"]).alias("h2"))

    windows = F.transform(F.sequence(F.lit(0), F.size("l") - 3), window)
    return rows.select("id", "text_hash", F.explode(windows).alias("w")).select("id", "text_hash", "w.*")


def covered_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, start, end): the merged line ranges that later occurrences cover, in documents that have any."""
    windows = materialize(line_windows(docs, id_col, text_col), "windows")
    place = F.struct("id", "text_hash", "first")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "earliest")
    later = windows.join(materialize(repeated, "repeated").hint("merge"), ["h1", "h2"]).where(F.col("earliest") < place).select("id", "text_hash", "first", "last").distinct()
    by_doc = Window.partitionBy("id", "text_hash").orderBy("first")
    reached = F.max("last").over(by_doc.rowsBetween(Window.unboundedPreceding, -1))
    starts = later.withColumn("new", (reached.isNull() | (F.col("first") > reached)).cast("int"))
    islands = starts.withColumn("island", F.sum("new").over(by_doc))
    return islands.groupBy("id", "text_hash", "island").agg(F.min("first").alias("start"), F.max("last").alias("end")).drop("island")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, n_lines, n_removed, text (the lines left).

    Lines end at newlines and are compared as they are. Windows are made of lines with a word; a window covers its
    lines and the blank ones between. Occurrences are ordered by id (null first), then text hash, then line: the first
    stays, in later ones all covered lines go. A null text stays null, with no lines. Texts with under three lines with
    a word stay as they are. Rows that repeat both id and text are one document, and are all treated alike. Other
    columns are not looked at; no rows give no rows.
    """
    key = lambda i, h: F.concat_ws(" ", F.coalesce(i.cast("string"), F.lit("null")), h)
    ranges = covered_ranges(docs, id_col, text_col).groupBy(key(F.col("id"), F.col("text_hash")).alias("_key")).agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("r"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), key(F.col(id_col), F.xxhash64(text_col)).alias("_key"))
    joined = rows.join(materialize(ranges, "ranges").hint("merge"), "_key", "left").withColumn("lines", F.split("_text", "\n"))
    # For each range, a mark for each line between it and the one before, and for each line in it: all in all one a line.
    n = F.size("r")
    end_before = lambda i: F.when(i == 0, 0).otherwise(F.get("r", i - 1)["end"] + 1)
    start = lambda i: F.when(i == n, F.size("lines")).otherwise(F.get("r", i)["start"])
    inside = lambda i: F.when(i == n, 0).otherwise(F.get("r", i)["end"] - F.get("r", i)["start"] + 1)
    marks = F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.concat(F.array_repeat(F.lit(True), (start(i) - end_before(i)).cast("int")), F.array_repeat(F.lit(False), inside(i).cast("int")))))
    left = F.array_compact(F.zip_with("lines", marks, lambda x, keep: F.when(keep, x)))
    removed = F.aggregate("r", F.lit(0), lambda s, x: s + x["end"] - x["start"] + 1)
    return joined.select(
        F.col("_id").alias(id_col),
        F.when(F.col("_text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
        F.when(F.col("r").isNull(), 0).otherwise(removed).cast("long").alias("n_removed"),
        F.when(F.col("r").isNull(), F.col("_text")).otherwise(F.array_join(left, "\n")).alias("text"),
    )
