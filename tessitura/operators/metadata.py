"""Metadata from titles and descriptions: dates, numbers, speakers, addresses, citations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.strings import either, fold, seconds_of

from .timejoins import asof_last, interval_join

MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
LONG_DATE = rf"(?iU)\b(?:{'|'.join(MONTHS)})\s+\d{{1,2}}(?:st|nd|rd|th)?,?\s+\d{{4}}\b"
SHORT_DATE = r"(?U)(?<![\d/.-])\d{1,2}[/.-]\d{1,2}[/.-](?:\d{4}|\d{2})(?![\d/.-])"
# Titles that are no topics, roles in an index of times.
ROLES = {"intro": "Introduction", "introduction": "Introduction", "welcome": "Introduction", "summary": "Summary", "wrap up": "Summary", "discussion": "Discussion", "q&a": "Discussion", "announcement": "Announcement", "announcements": "Announcement"}


def _month(name: Column) -> Column:
    return F.array_position(F.array(*[F.lit(m.lower()) for m in MONTHS]), F.lower(name)).cast("int")


def _long(c: Column) -> Column:
    part = lambda i: F.regexp_extract(c, r"(?i)^([a-z]+)\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})$", i)
    return F.try_to_date(F.format_string("%s-%02d-%s", part(3), _month(part(1)), F.lpad(part(2), 2, "0")), "yyyy-MM-dd")


def _short(c: Column) -> Column:
    part = lambda i: F.regexp_extract(c, r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{2,4})$", i)
    year = F.when(F.length(part(3)) == 2, F.concat(F.lit("20"), part(3))).otherwise(part(3))
    return F.try_to_date(F.concat_ws("-", year, F.lpad(part(1), 2, "0"), F.lpad(part(2), 2, "0")), "yyyy-MM-dd")


def find_date(c: Column, boilerplate: Sequence[str] = (), within: int = 60) -> Column:
    """The first valid date in a text, month names before numbers, years of two digits in this century; a date shortly after a boilerplate phrase doesn't count."""
    for phrase in boilerplate:
        c = F.regexp_replace(c, rf"(?is){phrase}.{{0,{within}}}?(?:{LONG_DATE[5:]}|{SHORT_DATE[4:]})", " ")
    first = lambda pattern, made: F.get(F.filter(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), made), lambda d: d.isNotNull()), F.lit(0))
    return F.coalesce(first(LONG_DATE, _long), first(SHORT_DATE, _short))


def number_and_topic(c: Column) -> Column:
    """(number, topic) of a title: its parts less dates, numbers and 'moderated by'; without any, what stands before the number."""
    number = F.regexp_extract(c, r"(?iU)(?:#|no\.?\s*|number\s+)(\d{1,4})\b", 1)
    number = F.when(number != "", number).otherwise(F.regexp_extract(c, r"(?U)\b(\d{1,4})\b", 1))
    parts = F.transform(F.split(c, r"\s*(?:\||—|–|:|\s-\s)\s*"), lambda p: F.trim(F.regexp_replace(p, rf"{LONG_DATE}|{SHORT_DATE}", "")))
    topic = F.filter(parts, lambda p: (p != "") & ~p.rlike(r"(?i)^moderated by") & ~p.rlike(r"(?iU)^\D*(?:#|no\.?\s*|number\s+)?\d{1,4}$"))
    before = F.trim(F.regexp_extract(c, r"(?iU)^(.*?)\s*(?:#|no\.?\s*|number\s+)?\d", 1))
    return F.struct(number.try_cast("int").alias("number"), F.when(F.size(topic) > 0, F.array_join(topic, ": ")).otherwise(F.nullif(before, F.lit(""))).alias("topic"))


def speaker_line(c: Column) -> Column:
    """(name, country, seconds) of an index line, the time in front or behind; the country after a dash, //, a comma or in parentheses."""
    time = r"\(?\[?(\d{1,2}(?::\d{2}){1,2})\]?\)?"
    at = F.regexp_extract(c, time, 1)
    rest = F.trim(F.regexp_replace(c, rf"^\s*{time}\s*[-–:]?\s*|\s*[-–:]?\s*{time}\s*$", ""))
    country = F.coalesce(*[F.nullif(F.trim(F.regexp_extract(rest, p, 1)), F.lit("")) for p in (r"\(([^()]+)\)\s*$", r"\s[–-]\s*([^–-]+)$", r"//\s*(.+)$", r",\s*([^,]+)$")])
    name = F.trim(F.regexp_replace(rest, r"\s*\([^()]*\)\s*$|\s[–-]\s*[^–-]+$|\s*//.*$|,.*$", ""))
    return F.struct(F.nullif(name, F.lit("")).alias("name"), country.alias("country"), seconds_of(F.nullif(at, F.lit(""))).alias("seconds"))


def speaker_index(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, idx, name, country, seconds): the lines of a description that are plausible entries; a line with a time alone
    takes the next line's name, and an entry without a country the next line, if that is short, has no time and is no sentence."""
    lines = texts.select(key, F.posexplode(F.split(text_col, "\n")).alias("idx", "line")).where(F.trim("line") != "")
    w = Window.partitionBy(key).orderBy("idx")
    bare = F.col("line").rlike(r"^\s*\d{1,2}(?::\d{2}){1,2}\s*$")
    joined = lines.withColumn("_next", F.lead("line").over(w)).withColumn("_taken", F.lag(bare).over(w)).withColumn("line", F.when(bare, F.concat_ws(" ", "line", "_next")).otherwise(F.col("line")))
    own = joined.where(~F.coalesce("_taken", F.lit(False))).withColumn("_after", F.trim(F.lead("line").over(w)))
    place = F.when(~F.col("_after").rlike(r"\d{1,2}:\d{2}") & (F.length("_after") < 60) & ~F.endswith("_after", F.lit(".")), F.col("_after"))
    parsed = own.select(key, "idx", speaker_line(F.col("line")).alias("s"), place.alias("_place"))
    ok = F.col("s.seconds").isNotNull() & F.col("s.name").rlike(r"(?U)^\p{L}[\p{L} .'’-]{1,60}$")
    return parsed.where(ok).select(key, "idx", "s.name", F.coalesce("s.country", "_place").alias("country"), "s.seconds")


def index_flags(texts: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """(key, entries, unparsed): how many lines of a description are entries, and how many others hold a time."""
    timed = F.size(F.filter(F.split(text_col, "\n"), lambda x: x.rlike(r"\b\d{1,2}(?::\d{2}){1,2}\b")))
    n = speaker_index(texts, key, text_col).groupBy(key).agg(F.count("*").alias("entries"))
    j = texts.select(key, timed.alias("timed")).join(n, key, "left")
    return j.select(key, F.coalesce("entries", F.lit(0)).cast("long").alias("entries"), (F.col("timed") - F.coalesce("entries", F.lit(0))).cast("long").alias("unparsed"))


def moderator(c: Column) -> Column:
    """Who moderates: on the line, or on the next where only punctuation follows."""
    return F.nullif(F.trim(F.regexp_extract(c, r"(?U)(?i:moderat(?:ed by|or))\s*[:\-–]?\s*\n?\s*(\p{Lu}[\p{L}.'’-]*(?:[ ]\p{Lu}[\p{L}.'’-]*){0,3})", 1)), F.lit(""))


def iso_duration(seconds: Column) -> Column:
    s = F.floor(seconds).cast("int")
    part = lambda n, u: F.when(n > 0, F.concat(n.cast("string"), F.lit(u))).otherwise("")
    h, m = F.floor(s / 3600).cast("int"), F.floor(s % 3600 / 60).cast("int")
    return F.concat(F.lit("PT"), part(h, "H"), part(m, "M"), F.when((s % 60 > 0) | (s == 0), F.concat((s % 60).cast("string"), F.lit("S"))).otherwise(""))


def fill_numbers(items: DataFrame, series: str, number: str, order: Sequence[str]) -> DataFrame:
    """items with the missing numbers of a series filled in: first the gaps below its largest, then on from there, in order.

    A gap lies between neighbouring numbers and is one row, however wide: the k-th item without a number takes its place in
    the last gap that begins at or before k free numbers.
    """
    known = items.where(F.col(number) >= 1).select(F.col(series).alias("_s"), F.col(number).cast("long").alias("_n")).distinct()
    by_number = Window.partitionBy("_s").orderBy("_n")
    below = known.select("_s", (F.coalesce(F.lag("_n").over(by_number), F.lit(0)) + 1).alias("_lo"), F.col("_n").alias("_hi"))
    above = items.select(F.col(series).alias("_s")).distinct().join(known.groupBy("_s").agg(F.max("_n").alias("_m")).hint("merge"), "_s", "left").select("_s", (F.coalesce("_m", F.lit(0)) + 1).alias("_lo"), F.lit(1 << 62).alias("_hi"))
    gaps = below.where("_hi > _lo").union(above)
    free = F.sum(F.col("_hi") - F.col("_lo")).over(Window.partitionBy("_s").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1))
    gaps = gaps.select(F.col("_s").alias(series), "_lo", F.coalesce(free, F.lit(0)).alias("_before")).withColumn("_at", F.col("_before") + 1)
    open_ = items.where(F.col(number).isNull()).withColumn("_k", F.row_number().over(Window.partitionBy(series).orderBy(*order)))
    placed = asof_last(open_, gaps, series, "_k", "_at", ["_lo", "_before"])
    filled = placed.withColumn(number, (F.col("_lo") + F.col("_k") - F.col("_before") - 1).cast(items.schema[number].dataType)).select(items.columns)
    return items.where(F.col(number).isNotNull()).union(filled)


def trusted_date(upload: Column, candidates: Sequence[tuple[str, Column]], most: int = 400) -> Column:
    """(date, origin): the first candidate up to so many days before the upload; else the upload."""
    ok = lambda d: F.datediff(upload, d).between(0, most)
    picked = F.coalesce(*[F.when(ok(d), F.struct(d.alias("date"), F.lit(n).alias("origin"))) for n, d in candidates])
    return F.coalesce(picked, F.struct(upload.alias("date"), F.lit("upload").alias("origin")))


def narrative(c: Column, heads: Sequence[str] = ()) -> Column:
    """The paragraphs of a description that tell something: no times, addresses, hashtags, rules or headings, and 25 letters or more."""
    drop = r"(?iU)^\s*(?:\(?\d{1,2}(?::\d{2}){1,2}|https?://\S+\s*$|#\S+|[-_=*]{3,}\s*$|[^.!?]*:\s*$)" + (f"|^(?:{either(heads)})" if heads else "")
    lines = F.filter(F.split(c, "\n"), lambda x: ~x.rlike(drop) & (F.length(F.regexp_replace(x, r"(?U)\P{L}", "")) >= 25))
    return F.array_join(lines, "\n")


def apply_overrides(rows: DataFrame, overrides: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """rows with fields replaced where overrides(key, field, value) sets them; a null value is a value."""
    made = overrides.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("value")))).alias("_o"))
    r = rows.join(made, key, "left")
    for f in fields:
        hit = F.try_element_at("_o", F.lit(f))
        r = r.withColumn(f, F.when(hit.isNotNull(), hit["value"].cast(rows.schema[f].dataType)).otherwise(F.col(f)))
    return r.drop("_o")


def slug(c: Column, most: int = 64) -> Column:
    """A folded title in words with dashes, cut at a word's end."""
    s = F.regexp_replace(F.regexp_replace(F.lower(fold(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    cut = F.regexp_extract(s, rf"^(.{{1,{most}}})(?:-|$)", 1)
    return F.when(cut == "", F.left(s, F.lit(most))).otherwise(cut)


def clip(c: Column, most: int = 158) -> Column:
    """At most so many characters, cut at a word's end, with an ellipsis."""
    c = F.trim(F.regexp_replace(c, r"\s+", " "))
    cut = F.regexp_replace(F.left(c, F.lit(most - 1)), r"\s+\S*$", "")
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.regexp_replace(cut, r"[,;:.\s]+$", ""), F.lit("…")))


def first_sentence(c: Column, least: int = 80, most: int = 260) -> Column:
    """From the start to the first sentence end after so many characters, at most so many."""
    c = F.trim(F.regexp_replace(c, r"\s+", " "))
    hit = F.regexp_extract(c, rf"^(.{{{least},{most - 1}}}?[.?!…])(?:\s|$)", 1)
    return F.when(hit != "", hit).otherwise(clip(c, most))


def show_date(iso: Column) -> Column:
    """A date as far as it is known: day, month or year."""
    month = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.greatest(F.coalesce(F.substring(iso, 6, 2).try_cast("int"), F.lit(1)), F.lit(1)))
    day = F.substring(iso, 9, 2).try_cast("int").cast("string")
    return F.when(F.length(iso) == 10, F.concat(month, F.lit(" "), day, F.lit(", "), F.left(iso, F.lit(4)))).when(F.length(iso) == 7, F.concat(month, F.lit(" "), F.left(iso, F.lit(4)))).otherwise(iso)


def citations(speaker: Column, title: Column, date: Column, url: Column, at: Column, accessed: str, site: str) -> list[Column]:
    """chicago, mla, apa, bibtex and ris of a passage; the day of access is a parameter."""
    link = F.concat(url, F.lit("&t="), at.cast("string"), F.lit("s"))
    year = F.left(date, F.lit(4))
    key = F.concat(F.regexp_replace(F.lower(fold(speaker)), "[^a-z]", ""), year)
    return [
        F.concat(speaker, F.lit(", in “"), title, F.lit(f"”, {site}, "), show_date(date), F.lit(", "), link, F.lit(".")).alias("chicago"),
        F.concat(speaker, F.lit(". “"), title, F.lit(f".” {site}, "), year, F.lit(", "), link, F.lit(f". Accessed {accessed}.")).alias("mla"),
        F.concat(speaker, F.lit(" ("), year, F.lit("). "), title, F.lit(f" [Video]. {site}. "), link).alias("apa"),
        F.concat(F.lit("@misc{"), key, F.lit(", author={"), speaker, F.lit("}, title={"), title, F.lit("}, year={"), year, F.lit("}, url={"), link, F.lit("}}")).alias("bibtex"),
        F.concat_ws("\n", F.lit("TY  - VIDEO"), F.concat(F.lit("AU  - "), speaker), F.concat(F.lit("TI  - "), title), F.concat(F.lit("PY  - "), year), F.concat(F.lit("UR  - "), link), F.lit("ER  - ")).alias("ris"),
    ]


def is_name_list(c: Column) -> Column:
    """Titles that are rosters or bare dates, not topics."""
    words = F.size(F.split(F.trim(c), r"\s+"))
    roster = c.rlike(r"(?U)^\s*\p{Lu}\p{L}+ \p{Lu}\p{L}+(?:\s*(?:,|&|and)\s*\p{Lu}\p{L}+ \p{Lu}\p{L}+)+\s*$")
    return roster | c.rlike(rf"^\s*(?:{LONG_DATE[5:]}|{SHORT_DATE[4:]})\s*$") | (words == 0)


def match_by_length(files: DataFrame, recordings: DataFrame, group: str, within: float = 0.15) -> DataFrame:
    """files(group, file, seconds) to the recording of the group nearest in length, within a part of it: (recording, file,
    gap); of equally near files the first. The nearest is the last one not longer or the first one not shorter: both sides
    are sorted by length once each way, and no pairs are made."""
    f = files.where("seconds is not null").groupBy(F.col(group).alias("_g"), F.col("seconds").cast("double").alias("_s")).agg(F.min("file").alias("file"))
    r = recordings.where("seconds is not null").select(F.col(group).alias("_g"), F.col("seconds").cast("double").alias("_s"), "recording")
    none = F.lit(None).cast(f.schema["file"].dataType)
    both = f.select("_g", "_s", F.struct("_s", "file").alias("_f"), F.lit(None).cast(r.schema["recording"].dataType).alias("recording")).union(
        r.select("_g", "_s", F.when(F.lit(False), F.struct("_s", none.alias("file"))), "recording")
    )
    # A file and a recording of one length meet either way: the file comes first in both orders.
    up = Window.partitionBy("_g").orderBy("_s", F.col("_f").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_g").orderBy(F.desc("_s"), F.col("_f").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("_a", F.last("_f", ignorenulls=True).over(up)).withColumn("_b", F.last("_f", ignorenulls=True).over(down)).where("_f is null")
    side = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(f"{c}._s") - F.col("_s")).alias("gap"), F.col(f"{c}.file").alias("file")))
    best = near.withColumn("_m", F.least(side("_a"), side("_b"))).where(F.col("_m.gap") <= within * F.col("_s"))
    return best.groupBy("recording").agg(F.min("_m").alias("_m")).select("recording", "_m.file", "_m.gap")


def match_by_preference(files: DataFrame, recordings: DataFrame, group: str, within: float = 0.01, plus: float = 2.0, width: float = 60.0) -> DataFrame:
    """files(group, file, seconds, preference) to a recording of the group: (recording, file, preference); of the files whose
    length is within a part of the recording's and some seconds, the one preferred most, then the first. Lengths are joined
    as intervals, so that only those within reach meet."""
    reach = within * F.col("seconds") + plus
    r = recordings.where("seconds is not null").select(group, "recording", (F.col("seconds") - reach).alias("start"), (F.col("seconds") + reach).alias("end"))
    f = files.where("seconds is not null").select(group, "file", "preference", F.col("seconds").alias("f_start"), F.col("seconds").alias("f_end"))
    met = interval_join(r, f, group, width, ("start", "end"), ("f_start", "f_end"))
    return met.groupBy("recording").agg(F.min(F.struct("preference", "file")).alias("m")).select("recording", "m.file", "m.preference")


def select_recordings(rows: DataFrame, slug_col: str, wanted: Sequence[str]) -> DataFrame:
    """By slug, or by bare number in any series."""
    numbers = [w for w in wanted if w.isdigit()]
    return rows.where(F.col(slug_col).isin(*wanted) | F.regexp_extract(slug_col, r"-0*(\d+)$", 1).isin(*[str(int(n)) for n in numbers]))


def role_index(lines: DataFrame, key: str, order: str, label: str, roles: dict[str, str] = ROLES) -> DataFrame:
    """lines with roles named alike; 'end' and what repeats the line before are dropped."""
    known = F.create_map(*[F.lit(x) for kv in roles.items() for x in kv])
    named = lines.withColumn(label, F.coalesce(F.try_element_at(known, F.lower(F.trim(label))), F.col(label))).where(F.lower(label) != "end")
    return named.withColumn("_b", F.lag(label).over(Window.partitionBy(key).orderBy(order))).where(~F.col(label).eqNullSafe(F.col("_b"))).drop("_b")
