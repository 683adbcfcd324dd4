"""The given tables in the shape of recordings, segments and words, in Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import table

SECONDS = 30.0


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations as segments: (slug, seg, speaker, start, end, text); system is nobody."""
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("slug"),
        F.col("turn").alias("seg"),
        F.when(F.col("role") != "system", F.col("role")).alias("speaker"),
        (F.col("turn") * SECONDS).alias("start"),
        (F.col("turn") * SECONDS + SECONDS).alias("end"),
        "text",
    )


SEG = """seg AS (SELECT conv_id AS slug, turn AS seg, CASE WHEN role <> 'system' THEN role END AS speaker,
  turn * 30::DOUBLE AS start, turn * 30::DOUBLE + 30 AS "end", text FROM conversations)"""


def with_suffix(spark: SparkSession, sf_dir: str, suffix: str) -> DataFrame:
    """documents with a text added to each, so that a rule has something to find in all of them."""
    return table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(suffix)).alias("text"))


def suffixed(suffix: str) -> str:
    return "d AS (SELECT doc_id, text || '" + suffix.replace("'", "''").replace("\n", "' || chr(10) || '") + "' AS t FROM documents)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a time series: (slug, idx, t seconds in the month, kind, value)."""
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), F.col("event_id").alias("idx"), (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / 1e6).alias("t"), F.col("event_type").alias("kind"), "value")


EV = "ev AS (SELECT user_id AS slug, event_id AS idx, (epoch_us(ts) - 1704067200000000) / 1e6::DOUBLE AS t, event_type AS kind, value FROM events)"

#: Sentences of segments, by the line: (slug, seg, speaker, para, sent, sentence).
SENT = (
    SEG
    + r""",
para AS (SELECT slug, seg, speaker, start, unnest(string_split(text, chr(10))) AS p, unnest(range(len(string_split(text, chr(10))))) AS para FROM seg),
tok AS (SELECT *, unnest(range(len(ws))) AS i, unnest(ws) AS w FROM (SELECT slug, seg, speaker, start, para, regexp_extract_all(p, '\S+') AS ws FROM para)),
flag AS (SELECT *, (regexp_matches(w, '[.?!…]["''”’)\]]*$') AND lower(w) NOT IN ('mr.', 'mrs.', 'ms.', 'dr.', 'st.', 'vs.', 'etc.', 'e.g.', 'i.e.', 'no.', 'jr.', 'sr.', 'prof.')) AS last FROM tok),
num AS (SELECT *, coalesce(sum(last::INT) OVER (PARTITION BY slug, seg, para ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent FROM flag),
sent AS (SELECT slug, seg, any_value(speaker) AS speaker, any_value(start) AS start, para, sent, string_agg(w, ' ' ORDER BY i) AS sentence FROM num GROUP BY slug, seg, para, sent)"""
)


def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of segments: (slug, seg, speaker, start, para, text)."""
    return segments(spark, sf_dir).select("slug", "seg", "speaker", "start", F.posexplode(F.split("text", "\n")).alias("para", "text"))
