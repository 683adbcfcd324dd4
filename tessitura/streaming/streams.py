"""Incremental work as Structured Streaming.

Each stream has a batch form that gives the same rows once all input has come; tests hold one against the other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessitura.functions.tables import written
from tessitura.operators.names import multiset_bound, ratcliff_ratio, ratio_bound


def share_sessions(samples: DataFrame, gap: str = "30 seconds", late: str = "1 minute", key: str = "slug", at: str = "ts", least_seconds: float = 20.0) -> DataFrame:
    """samples(key, at) to sessions (key, start, end, samples), on a batch or a stream; a stream drops samples later than the watermark."""
    rows = samples.withWatermark(at, late) if samples.isStreaming else samples
    s = rows.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("samples"), F.min(at).alias("start"), F.max(at).alias("end"))
    long_enough = F.expr("timestampdiff(MICROSECOND, `start`, `end`)") >= least_seconds * 1e6
    return s.where(long_enough).select(key, "start", "end", "samples")


FIX = ["slug", "old_hash", "new"]


def _merged(once: DataFrame) -> DataFrame:
    """(slug, old_hash, new, old, count, first_at) of suggestions whose source ids were counted once."""
    ok = once.where((F.trim("old") != F.trim("new")) & ~F.col("new").rlike(r"(?i)https?://|www\."))
    return ok.groupBy("slug", F.sha2("old", 256).alias("old_hash"), "new").agg(F.min("old").alias("old"), F.count("*").alias("count"), F.min("at").alias("first_at"))


def _with_large(fixes: DataFrame, least: float = 0.6) -> DataFrame:
    """fixes with large: the old text and the new are alike by less than so much. Only those that lengths and letters leave
    open are scored."""
    open_ = (ratio_bound(F.col("old"), F.col("new")) >= least) & (multiset_bound(F.col("old"), F.col("new")) >= least)
    close = F.when(open_, ratcliff_ratio("old", "new") >= least).otherwise(False)
    return fixes.withColumn("large", ~F.coalesce(close, F.lit(False))).select(*FIX, "count", "first_at", "large")


def merge_suggestions(rows: DataFrame) -> DataFrame:
    """suggestions(source_id, slug, old, new, at) to one for each fix: repeated source ids count once, fixes without a change
    and with links are rejected, identical ones are merged with a count; large says that most of the text changes."""
    once = rows.groupBy("source_id").agg(F.min_by(F.struct("slug", "old", "new", "at"), "at").alias("r")).select("r.*")
    return _with_large(_merged(once))


class SuggestionTable:
    """The merged fixes as a stream keeps them: in buckets by fix, of which a batch rewrites those it touches. A commit names
    each bucket's folder and is written last, under the batch's number: readers go by the newest, a batch that broke off
    or is sent again starts from the commit before it and writes its own anew."""

    SCHEMA = "slug {slug}, old_hash string, new string, old string, count long, first_at timestamp"

    def __init__(self, spark: SparkSession, path: str, slug_type: str = "long", buckets: int = 16):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.schema = self.SCHEMA.format(slug=slug_type)

    def _folders(self, before: int | None = None) -> dict[int, str]:
        """Each bucket's folder by the newest commit, or the newest before a batch; a row a bucket."""
        try:
            commits = self.spark.read.schema("bucket int, folder string, number long").option("basePath", f"{self.path}/commits").parquet(f"{self.path}/commits/*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}
        if before is not None:
            commits = commits.where(F.col("number") < before)
        newest = commits.agg(F.max("number")).first()[0]
        return {} if newest is None else {r["bucket"]: r["folder"] for r in commits.where(F.col("number") == newest).collect() if r["folder"]}

    def _read(self, folders: dict[int, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/fixes/{f}" for f in folders.values()])

    def upsert(self, batch: DataFrame, number: int) -> None:
        """Add a batch's fixes to those known: counts add up, the first time stays."""
        bucket = F.pmod(F.xxhash64("old_hash", "new"), F.lit(self.buckets)).cast("int")
        new = written(_merged(batch).withColumn("bucket", bucket), "fixes")
        folders = self._folders(number)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # the number of buckets at most
        known = self._read({b: f for b, f in folders.items() if b in touched})
        both = new.drop("bucket").unionByName(known).groupBy(*FIX).agg(F.min("old").alias("old"), F.sum("count").alias("count"), F.min("first_at").alias("first_at"))
        both.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/fixes/batch={number}")
        folders |= {b: f"batch={number}/bucket={b}" for b in touched}
        rows = list(folders.items()) or [(0, "")]
        self.spark.createDataFrame(rows, "bucket int, folder string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/number={number}")

    def fixes(self) -> DataFrame:
        """What merge_suggestions gives for all that has come."""
        return _with_large(self._read(self._folders()))


def suggestion_intake(stream: DataFrame, table: SuggestionTable, checkpoint: str, late: str = "7 days", **trigger):
    """Keep a table of merged fixes up to date. A source id that comes again within the watermark's delay counts once, and
    its state goes after that, so that state does not grow for ever."""
    once = stream.withWatermark("at", late).dropDuplicatesWithinWatermark(["source_id"])
    return once.writeStream.foreachBatch(lambda batch, number: table.upsert(batch, number)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


class DropRepeats(StatefulProcessor):
    """Terms of a key in the order of their times, without those that repeat the one before within a time.

    Rows wait until the watermark has passed them, as earlier ones may still come. A timer then lets them out, sorted; when
    nothing has come for the time in which a repeat counts, a timer empties the key's state.
    """

    def __init__(self, forget_ms: int):
        self.forget_ms = forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "term string, ts timestamp")
        self.waiting = handle.getListState("waiting", "term string, ts timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for term, ts in zip(pdf["term"], pdf["ts"], strict=True):
                self.waiting.appendValue((term, ts.to_pydatetime()))
                self.handle.registerTimer(_ms(ts) + 1)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = [(pd.Timestamp(ts), term) for term, ts in self.waiting.get()] if self.waiting.exists() else []
        due = sorted((r for r in rows if _ms(r[0]) < now), key=lambda r: (r[0], r[1] is not None, r[1]))
        last = self.last.get() if self.last.exists() else None
        before = (pd.Timestamp(last[1]), last[0]) if last else None
        out = []
        for ts, term in due:
            if before is None or term != before[1] or (ts - before[0]).total_seconds() * 1000 > self.forget_ms:
                out.append((*key, term, ts))
            before = (ts, term)
        if due:
            left = [(term, ts.to_pydatetime()) for ts, term in rows if _ms(ts) >= now]
            self.waiting.clear()
            if left:
                self.waiting.put(left)
            self.last.update((before[1], before[0].to_pydatetime()))
            self.handle.registerTimer(_ms(before[0]) + self.forget_ms + 1)
        elif before is not None and not rows and _ms(before[0]) + self.forget_ms < now:
            self.last.clear()
            self.waiting.clear()
        yield pd.DataFrame(out, columns=["slug", "term", "ts"])

    def close(self) -> None:
        pass


def _ms(ts: pd.Timestamp) -> int:
    return ts.value // 1_000_000


def distinct_searches(stream: DataFrame, late: str = "10 minutes", forget: str = "1 day") -> DataFrame:
    """stream(slug, term, ts) without consecutive repeats of a user within a time. Rows may come late and out of order, by the
    watermark's delay; needs the RocksDB state store."""
    forget_ms = int(pd.Timedelta(forget).total_seconds() * 1000)
    schema = f"slug {stream.schema['slug'].dataType.simpleString()}, term string, ts timestamp"
    rows = stream.withWatermark("ts", late)
    return rows.groupBy("slug").transformWithStateInPandas(DropRepeats(forget_ms), schema, "Append", "EventTime")


def distinct_searches_batch(rows: DataFrame, forget: str | None = None) -> DataFrame:
    """The same of a table; without a time, repeats count however long after."""
    w = Window.partitionBy("slug").orderBy("ts", "term")
    again = F.col("term").eqNullSafe(F.lag("term").over(w)) & F.lag("ts").over(w).isNotNull()
    if forget is not None:
        again = again & (F.expr("timestampdiff(MILLISECOND, lag(ts) OVER (PARTITION BY slug ORDER BY ts, term), ts)") <= int(pd.Timedelta(forget).total_seconds() * 1000))
    return rows.withColumn("_again", again).where("not _again").select("slug", "term", "ts")


def search_counts(rows: DataFrame, every: str = "1 day", late: str = "1 hour", at: str = "ts") -> DataFrame:
    """(day, term, n): how often each term was searched in each window, on a batch or a stream."""
    r = rows.withWatermark(at, late) if rows.isStreaming else rows
    return r.groupBy(F.window(at, every).alias("w"), "term").agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), "term", "n")


def new_recordings(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, process: Callable[[DataFrame], DataFrame]):
    """Process the files that have come since the last run, and only those."""

    def keep(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
