"""Queries of the streams, in their batch form and as streams that run over the files there are."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessitura.streaming import streams

from tessitura.functions.tables import shared_dir

from .registry import query, table


def _folder(spark) -> str:
    """A new folder where driver and executors both reach it."""
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


SESSIONS = """WITH e AS (SELECT user_id AS slug, ts FROM events), n AS (SELECT *, CASE WHEN ts - lag(ts) OVER w > INTERVAL 6 HOUR THEN 1 ELSE 0 END AS nw FROM e WINDOW w AS (PARTITION BY slug ORDER BY ts)), r AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY ts) AS run FROM n)
SELECT slug, epoch_us(min(ts)) AS start_us, epoch_us(max(ts)) AS end_us, count(*)::BIGINT AS samples FROM r GROUP BY slug, run HAVING max(ts) - min(ts) >= INTERVAL 1 HOUR"""


def _micros(c):
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({c} as timestamp_ntz))").alias(f"{c}_us")


@query("r1_share_sessions", SESSIONS)
def r1_share_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), "ts")
    return streams.share_sessions(e, gap="6 hours", least_seconds=3600.0).select("slug", _micros("start"), _micros("end"), "samples")


@query("r2_suggestions", """WITH s AS (SELECT conv_id AS slug, turn, role AS old, CASE turn % 4 WHEN 0 THEN role WHEN 1 THEN 'see http://x' ELSE 'fix ' || turn % 3 END AS new, turn // 2 AS src FROM conversations), o AS (SELECT slug, arg_min(old, turn) AS old, arg_min(new, turn) AS new, min(turn) AS t0 FROM s GROUP BY slug, src)
SELECT slug, sha256(old) AS old_hash, new, count(*)::BIGINT AS count, min(t0)::BIGINT AS first_at FROM o WHERE old <> new AND NOT contains(new, 'http') GROUP BY slug, old, new""")
def r2_suggestions(spark, sf_dir):
    """Two turns at a time share a source id."""
    k = F.col("turn") % 4
    new = F.when(k == 0, F.col("role")).when(k == 1, "see http://x").otherwise(F.concat(F.lit("fix "), (F.col("turn") % 3).cast("string")))
    c = table(spark, sf_dir, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.floor(F.col("turn") / 2).cast("string")).alias("source_id"), F.col("conv_id").alias("slug"), F.col("role").alias("old"), new.alias("new"), F.col("turn").alias("at"))
    return streams.merge_suggestions(c).drop("large")


@query("r3_search_counts", "WITH s AS (SELECT user_id, event_type AS term, ts, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_type) AS b FROM events) SELECT date_trunc('day', ts)::DATE AS day, term, count(*)::BIGINT AS n FROM s WHERE term IS DISTINCT FROM b GROUP BY ALL")
def r3_search_counts(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("slug"), F.col("event_type").alias("term"), "ts")
    return streams.search_counts(streams.distinct_searches_batch(e)).withColumn("day", F.to_date("day"))


@query("r4_new_recordings", "SELECT o_orderkey, length(o_orderpriority) AS n FROM orders")
def r4_new_recordings(spark, sf_dir):
    """Two runs over a file source: the second finds nothing new, so that each row is there once."""
    # A pattern, so that the table may be a file or a folder.
    source, out, checkpoint = f"{sf_dir}/order[s].parquet", _folder(spark), _folder(spark)
    schema = table(spark, sf_dir, "orders").schema
    for _ in range(2):
        run = streams.new_recordings(spark, source, schema, out, checkpoint, lambda b: b.select("o_orderkey", F.length("o_orderpriority").cast("long").alias("n")))
        run.awaitTermination()
    return spark.read.schema("o_orderkey long, n long, batch int").parquet(out).select("o_orderkey", "n")
