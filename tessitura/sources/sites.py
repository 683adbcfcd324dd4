"""Readers of metadata, site exports, pages, lists, files and forms."""

from __future__ import annotations

import html
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tessitura.functions.strings import seconds_of

METADATA = "id string, title string, description string, upload_date string, duration double, thumbnail string"
LINK = r"""(?is)<a\b[^>]*?href=["']([^"']*)["'][^>]*>(.*?)</a>"""


def read_metadata(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Recordings from JSON, a document a file, or a line with lines; the day as a date."""
    return spark.read.schema(METADATA).option("multiLine", not lines).json(path).withColumn("upload_date", F.try_to_date("upload_date", "yyyyMMdd"))


def read_site_export(spark: SparkSession, path: str, kinds: Sequence[str] = ("post", "page")) -> DataFrame:
    """Published items of an export: (title, link, kind, content, categories)."""
    items = spark.read.format("xml").option("rowTag", "item").option("ignoreNamespace", True).schema("title string, link string, post_type string, status string, encoded string, category array<string>").load(path)
    return items.where(F.col("status") == "publish").where(F.col("post_type").isin(*kinds)).select("title", "link", F.col("post_type").alias("kind"), F.col("encoded").alias("content"), F.col("category").alias("categories"))


@F.pandas_udf(StringType())
def unescape(s: pd.Series) -> pd.Series:
    """HTML entities as their characters."""
    return s.map(lambda x: None if x is None else html.unescape(x))


def strip_tags(c: Column) -> Column:
    """Text of HTML: encoded blocks, scripts and styles dropped, line ends at breaks and block ends, tags stripped, blank runs squeezed."""
    c = F.regexp_replace(c, r"(?is)\[vc_raw_html[^\]]*\].*?\[/vc_raw_html\]|<(script|style)\b.*?</\1>|<!--.*?-->", "")
    c = F.regexp_replace(c, r"(?i)\[/?[a-z][a-z0-9_-]*[^\]]*\]|<br\s*/?>|</(?:p|div|li|h[1-6]|tr|ul|ol|article|nav|footer)>", "\n")
    c = F.regexp_replace(c, r"<[^>]+>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[ \t]+", " "), r"\s*\n\s*", "\n"), F.lit(" \n"))


def html_to_text(c: Column) -> Column:
    return unescape(strip_tags(c))


def page_links(pages: DataFrame, key: str, html_col: str = "html") -> DataFrame:
    """(key, idx, url, text) of the links of a page, in order."""
    found = F.transform(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(0)), lambda x: F.struct(F.regexp_extract(x, LINK, 1).alias("url"), F.trim(F.regexp_replace(F.regexp_extract(x, LINK, 2), "<[^>]+>", "")).alias("text")))
    return pages.select(key, F.posexplode(found).alias("idx", "l")).select(key, "idx", "l.url", "l.text")


def index_links(lines: DataFrame, key: str, order: str = "idx", html_col: str = "html") -> DataFrame:
    """lines(key, idx, html) to (key, idx, section, person, url): headings name the section, lines with a bold name the person; both hold for the links that follow."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    pick = lambda p: F.nullif(F.trim(F.regexp_replace(F.regexp_extract(html_col, p, 1), "<[^>]+>", "")), F.lit(""))
    r = lines.withColumn("_s", pick(r"(?is)<h3[^>]*>(.*?)</h3>")).withColumn("_p", pick(r"(?is)<(?:b|strong)>(.*?)</(?:b|strong)>"))
    r = r.withColumn("section", F.last("_s", ignorenulls=True).over(w)).withColumn("_at", F.last(F.when(F.col("_s").isNotNull(), F.col(order)), ignorenulls=True).over(w))
    person = F.last(F.when(F.col("_p").isNotNull(), F.struct(F.col("_p").alias("p"), F.col(order).alias("o"))), ignorenulls=True).over(w)
    r = r.withColumn("_l", person).withColumn("person", F.when(F.col("_at").isNull() | (F.col("_l.o") >= F.col("_at")), F.col("_l.p")))
    urls = F.transform(F.regexp_extract_all(html_col, F.lit(LINK), F.lit(1)), lambda u: u)
    return r.select(key, order, "section", "person", F.explode(urls).alias("url"))


def parse_index(pages: DataFrame, key: str, html_col: str = "html") -> DataFrame:
    """(key, section, name, location) of '<h3>Section</h3>' parts and their lines 'Name, Place'; the section goes with the explode, no window."""
    parts = pages.select(key, F.explode(F.split(html_col, r"(?i)<h3[^>]*>")).alias("part"))
    head = F.trim(F.regexp_replace(F.split_part("part", F.lit("</h3>"), F.lit(1)), "<[^>]+>", ""))
    lines = parts.where(F.col("part").contains("</h3>")).select(key, head.alias("section"), F.explode(F.split(F.split_part("part", F.lit("</h3>"), F.lit(2)), r"(?i)<br\s*/?>|</p>|\n")).alias("line"))
    text = F.trim(F.regexp_replace("line", "<[^>]+>", ""))
    entry = lines.withColumn("text", text).where(F.col("text").rlike(r"(?U)^\p{Lu}\p{L}+[^:]*$"))
    return entry.select(key, "section", F.trim(F.split_part("text", F.lit(","), F.lit(1))).alias("name"), F.nullif(F.trim(F.regexp_extract("text", ",(.*)$", 1)), F.lit("")).alias("location"))


def parse_listing(tokens: DataFrame, key: str, most: int = 80) -> DataFrame:
    """tokens(key, idx, kind, value) to (key, entry, url): each link goes to the entry before it; an over-long entry owns none."""
    w = Window.partitionBy(key).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    entry = F.last(F.when(F.col("kind") == "entry", F.struct(F.col("value").alias("v"))), ignorenulls=True).over(w)
    return tokens.withColumn("_e", entry).where("kind = 'link'").where(F.length("_e.v") <= most).select(key, F.col("_e.v").alias("entry"), F.col("value").alias("url"))


def parse_reel(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, name, seconds) of 'm:ss Name' in a list, names of 3 to 49 characters."""
    item = r"(?U)(\d{1,2}(?::\d{2}){1,2})\s+[–-]?\s*(\p{Lu}[^\n\d<>]*)"
    found = F.transform(F.regexp_extract_all(text_col, F.lit(item), F.lit(0)), lambda x: F.struct(F.trim(F.regexp_extract(x, item, 2)).alias("name"), seconds_of(F.regexp_extract(x, item, 1)).alias("seconds")))
    return texts.select(key, F.explode(found).alias("r")).select(key, "r.name", "r.seconds").where(F.length("name").between(3, 49))


def parse_profiles(pages: DataFrame, key: str, title_col: str, html_col: str) -> DataFrame:
    """(key, name, location, works) of exhibition pages: the name from the title, the place from what the heading adds, captions without prices."""
    name = F.trim(F.split_part(title_col, F.lit(" at "), F.lit(1)))
    head = F.trim(F.regexp_replace(F.regexp_extract(html_col, r"(?is)<h2[^>]*>(.*?)</h2>", 1), "<[^>]+>", ""))
    place = F.nullif(F.regexp_replace(F.trim(F.substring(head, F.length(name) + 1, F.lit(1000))), r"^[,–\-\s]+", ""), F.lit(""))
    captions = F.transform(F.regexp_extract_all(html_col, F.lit(r"(?is)<figcaption[^>]*>(.*?)</figcaption>"), F.lit(1)), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), r",?\s*(?:[$€£]\s?[\d,.]+|NFS)\s*$", "")))
    return pages.select(key, name.alias("name"), F.when(head.startswith(name), place).alias("location"), F.array_join(captions, "; ").alias("works"))


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(file, folder, extension, kind, bytes) of all files below a path; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    file, ext = F.element_at(F.split("path", "/"), -1), F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    lower = F.lower(file)
    kind = F.when(lower.rlike(r"\.transcript\.vtt$"), "transcript").when(lower.rlike(r"\.(vtt|srt)$"), "captions").when(lower.rlike(r"chat.*\.txt$"), "chat").otherwise("none")
    return files.select(file.alias("file"), F.element_at(F.split("path", "/"), -2).alias("folder"), ext.alias("extension"), kind.alias("kind"), F.col("length").alias("bytes"))


def inventory_by_folder(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"), F.bool_or(F.col("kind") == "transcript").alias("transcript"), F.bool_or(F.col("kind") == "captions").alias("captions"), F.bool_or(F.col("kind") == "chat").alias("chat"))


def read_form_csv(spark: SparkSession, path: str, wanted: dict[str, tuple[Sequence[str], Sequence[str]]]) -> DataFrame:
    """A CSV whose headings are found by the words they must and must not have; a column not found is null."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)

    def column(must: Sequence[str], avoid: Sequence[str]) -> Column:
        for h in raw.columns:
            if all(m in h.lower() for m in must) and not any(a in h.lower() for a in avoid):
                return F.col(f"`{h}`")
        return F.lit(None).cast("string")

    return raw.select(*[column(*words).alias(name) for name, words in wanted.items()])


def reviewed_texts(texts: DataFrame, drafts: bool = False) -> DataFrame:
    """texts(slug, text) whose first line says 'status: reviewed', or draft if drafts are wanted; that line is dropped."""
    status = F.lower(F.trim(F.regexp_extract("text", r"(?i)\A\s*status:\s*([^\n]*)", 1)))
    body = F.trim(F.regexp_replace("text", r"(?i)\A\s*status:[^\n]*\n?", ""), F.lit(" \n"))
    return texts.where(status.isin("reviewed", *(["draft"] if drafts else []))).select("slug", status.alias("status"), body.alias("text"))


def synopsis_points(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, seconds, label) of time links '[[m:ss|label]]'."""
    link = r"\[\[(\d{1,3}(?::\d{2}){1,2})\|([^\]]*)\]\]"
    found = F.transform(F.regexp_extract_all(text_col, F.lit(link), F.lit(0)), lambda x: F.struct(seconds_of(F.regexp_extract(x, link, 1)).alias("seconds"), F.regexp_extract(x, link, 2).alias("label")))
    return texts.select(key, F.explode(found).alias("p")).select(key, "p.seconds", "p.label")


def synopsis_plain(c: Column) -> Column:
    return F.regexp_replace(c, r"\[\[\d{1,3}(?::\d{2}){1,2}\|([^\]]*)\]\]", "$1")
