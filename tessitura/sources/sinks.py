"""Writers and the documents they write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessitura.functions.strings import clock, count_words


def yaml_scalar(c: Column) -> Column:
    """A text as YAML: null bare, quotes where the text would read as anything else."""
    plain = c.rlike(r"(?U)^[\p{L}][\p{L}\p{N} .,'()/-]*$") & ~F.lower(c).isin("null", "true", "false", "yes", "no") & ~c.rlike(r"\s$")
    quoted = F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(c.isNull(), "null").when(plain, c).otherwise(quoted)


def ordered_text(rows: DataFrame, keys: Sequence[str], order: Sequence[str], text: Column, between: str) -> DataFrame:
    """(keys, text): one text of the rows of a key, in order."""
    listed = F.array_sort(F.collect_list(F.struct(*order, text.alias("_t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(listed, lambda x: x["_t"]), between).alias("text"))


def corpus_documents(segments: DataFrame, heads: DataFrame | None = None, key: str = "slug", url: str = "https://v.example/?v=") -> DataFrame:
    """(key, text): front matter and a heading with a link for each segment."""
    link = F.concat(F.lit(f"({url}"), F.col(key).cast("string"), F.lit("&t="), F.col("start").cast("long").cast("string"), F.lit("s)"))
    head = F.concat(F.lit("## "), F.coalesce("speaker", F.lit("Unattributed")), F.lit(" ["), clock(F.col("start")), F.lit("]"), link)
    body = ordered_text(segments, [key], ["seg"], F.concat(head, F.lit("\n\n"), "text"), "\n\n")
    front = segments.groupBy(key).agg(F.count("*").alias("n"), F.sum(count_words(F.col("text"))).alias("w")).select(key, F.concat(F.lit("---\nid: "), yaml_scalar(F.col(key).cast("string")), F.lit("\nsegments: "), F.col("n").cast("string"), F.lit("\nwords: "), F.col("w").cast("string"), F.lit("\n---\n\n")).alias("front"))
    return body.join(front, key).select(key, F.concat("front", "text").alias("text"))


def stamp(seconds: Column, mark: str = ".") -> Column:
    ms = F.round(seconds * 1000).cast("long")
    return F.format_string(f"%02d:%02d:%02d{mark}%03d", F.floor(ms / 3600000).cast("int"), F.floor(ms / 60000).cast("int") % 60, F.floor(ms / 1000).cast("int") % 60, (ms % 1000).cast("int"))


def caption_files(cues: DataFrame, key: str = "slug", vtt: bool = True, order: str = "seg") -> DataFrame:
    """(key, text): SRT or VTT of cues(key, order, start, end, text)."""
    mark = "." if vtt else ","
    lines = F.concat(stamp(F.col("start"), mark), F.lit(" --> "), stamp(F.col("end"), mark), F.lit("\n"), F.col("text"))
    if not vtt:
        lines = F.concat((F.row_number().over(Window.partitionBy(key).orderBy(order))).cast("string"), F.lit("\n"), lines)
        cues = cues.withColumn("_line", lines)
        lines = F.col("_line")
    done = ordered_text(cues, [key], [order], lines, "\n\n")
    return done.withColumn("text", F.concat(F.lit("WEBVTT\n\n" if vtt else ""), "text", F.lit("\n")))


def caption_index(cues: DataFrame, key: str = "slug") -> DataFrame:
    """(key, cues, last_end, longest_ms, widest)."""
    return cues.groupBy(key).agg(F.count("*").alias("cues"), F.max("end").cast("long").alias("last_end"), F.round(F.max(F.col("end") - F.col("start")) * 1000).cast("long").alias("longest_ms"), F.max(F.array_max(F.transform(F.split("text", "\n"), lambda x: F.length(x)))).cast("long").alias("widest"))


def transcript_lines(segments: DataFrame, key: str = "slug", para_break: str = "\n") -> DataFrame:
    """(key, ord, line): '[H:MM:SS] Name' before the paragraphs of each turn."""
    head = F.concat(F.lit("["), F.format_string("%d:%02d:%02d", F.floor(F.col("start") / 3600).cast("int"), F.floor(F.col("start") % 3600 / 60).cast("int"), (F.col("start") % 60).cast("int")), F.lit("] "), F.coalesce("speaker", F.lit("Unattributed")))
    rows = segments.select(key, "seg", F.posexplode(F.concat(F.array(head), F.split("text", para_break))).alias("para", "line"))
    return rows.withColumn("ord", F.row_number().over(Window.partitionBy(key).orderBy("seg", "para"))).select(key, "ord", "line")


def write_texts(texts: DataFrame, path: str, key: str = "slug") -> None:
    """One text column, in folders by key."""
    texts.select(key, "text").write.mode("overwrite").partitionBy(key).text(path)


def replace_recordings(spark: SparkSession, path: str, rebuilt: DataFrame, by: str = "type") -> None:
    """Replace only the partitions that rebuilt has."""
    rebuilt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def merge_rebuilt(corpus: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """corpus with the recordings that rebuilt has taken from there."""
    return corpus.join(rebuilt.select(key).distinct(), key, "left_anti").unionByName(rebuilt)


def append_run(rows: DataFrame, path: str, run: str) -> None:
    """A run's rows under its own name: written again, they replace themselves."""
    rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def split_failures(rows: DataFrame, checks: dict[str, Column], key: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and (key, stage, error) for each check that a row fails: a bad row never stops the rest."""
    listed = F.filter(F.array(*[F.struct(F.lit(s).alias("stage"), F.coalesce(c, F.lit(False)).alias("ok")) for s, c in checks.items()]), lambda x: ~x["ok"])
    marked = rows.withColumn("_bad", listed)
    bad = marked.select(key, F.explode("_bad").alias("b")).select(key, F.col("b.stage").alias("stage"), F.concat(F.lit("failed "), F.col("b.stage")).alias("error"))
    return marked.where(F.size("_bad") == 0).drop("_bad"), bad


def ordered_export(rows: DataFrame, type_col: str, order: Sequence[str], number: str) -> DataFrame:
    """rows by a fixed order of types, others last, then number; nulls as blanks."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(t) for t in order]), F.col(type_col)), F.lit(0)), F.lit(len(order) + 1))
    return rows.orderBy(place, number).na.fill("")
