"""An inverted index in a shared folder, kept in segments.

A segment has a row for each term of a block of texts: the texts that hold it, their lengths, and where it stands in them,
packed in one array. Blocks are made where the texts are read, so building an index shuffles no words. Rows are
partitioned by a hash of the term, so that a lookup reads its terms' partitions alone. Adding writes a new segment;
deleting writes a segment of keys that no older one counts for; merging writes what is left as one segment that stands for
all before it. A segment counts once its marker is written, which is last: one that broke off is never read, and a batch
that was committed is not taken again.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .search import parse_query

#: A word, in the classes that SQL's pattern names: letters, marks, numbers of any kind, low lines and apostrophes.
TERM = r"[\p{L}\p{M}\p{N}_']+"
#: Of the rules that a stored index was made by: one made by others is not taken up.
RULES = 2
#: Partitions by term, and slices of a partition by key when it is written, so that a very common term is not one task's.
PARTS, SLICES = 16, 4
#: Words of a block of texts; a longer text is a block of its own.
BLOCK_WORDS = 1 << 18
#: The partition whose rows, without a term, list a block's texts.
TEXTS = -1
MARKER = "seg long, batch string, folder string, since long, docs long, words long, deletes long"


def _lower(c: Column) -> Column:
    """In lower case. A capital I with a dot is one letter, as in SQL and in _phrases, not an i and a mark."""
    return F.lower(F.replace(c, F.lit("İ"), F.lit("i")))


def _phrases(query: str) -> list[list[str]]:
    return parse_query(query.replace("İ", "i"))


def _back(positions: Column, k: int) -> Column:
    return F.transform(positions, lambda x: x - k)


def _block(keys: pa.Array, words: pa.ListArray) -> pa.RecordBatch:
    """A block's rows: one for each of its terms, and one without a term for all its texts."""
    lens = words.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32)
    said = words.flatten().dictionary_encode()
    code = said.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(lens)), lens)
    at = np.arange(len(code)) - np.repeat(np.cumsum(lens, dtype=np.int64) - lens, lens)
    order = np.argsort(code, kind="stable")  # by term, then text, then place
    code, text, at = code[order], text[order], at[order].astype(np.int32)
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])][: len(code)])  # of a text's places of a term
    opens = np.flatnonzero(np.r_[True, np.diff(code[first]) != 0][: len(first)])  # of a term's texts
    counts = np.diff(np.r_[first, len(code)]).astype(np.int32)
    of_terms = pa.array(np.r_[opens, len(first), len(first) + len(lens)].astype(np.int32))
    of_places = pa.array(np.r_[first[opens], len(code), len(code)].astype(np.int32))
    columns = {
        "term": pa.concat_arrays([said.dictionary.take(pa.array(code[first][opens])), pa.nulls(1, said.dictionary.type)]),
        "keys": pa.ListArray.from_arrays(of_terms, keys.take(pa.array(np.r_[text[first], np.arange(len(lens))]))),
        "lens": pa.ListArray.from_arrays(of_terms, pa.array(np.r_[lens[text[first]], lens])),
        "counts": pa.ListArray.from_arrays(of_terms, pa.array(np.r_[counts, np.zeros(len(lens), np.int32)])),
        "places": pa.ListArray.from_arrays(of_places, pa.array(at)),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, w), w a text's terms in order, to the rows of their blocks."""
    for b in batches:
        ends = np.cumsum(b.column(1).value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
        lo = 0
        while lo < b.num_rows:
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + BLOCK_WORDS, "right")))
            yield _block(b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo))
            lo = hi


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of blocks to a row (seg, key, len, term, positions, part) for each text and term."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            keys, lens, counts, places = (row.column(c).flatten() for c in ("keys", "lens", "counts", "places"))
            each = pa.array(np.zeros(len(keys), np.int32))
            ends = pa.array(np.r_[0, np.cumsum(counts.to_numpy())].astype(np.int32))
            columns = {"seg": row.column("seg").take(each), "key": keys, "len": lens, "term": row.column("term").take(each), "positions": pa.ListArray.from_arrays(ends, places), "part": row.column("part").take(each)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


class TextIndex:
    """An index over texts with a key; keys are unique and not null (rows without a key are left out)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "doc_id", key_type: str = "long", parts: int = PARTS, slices: int = SLICES):
        self.spark, self.path, self.key, self.key_type, self.parts, self.slices = spark, path.rstrip("/"), key, key_type, parts, slices

    def _files(self, kind: str, folders: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*[f"{self.path}/{kind}/{f}" for f in folders])

    def markers(self) -> list:
        """The segments that count, oldest first: those since the last merge."""
        try:
            found = sorted(self.spark.read.schema(MARKER).parquet(f"{self.path}/commits/*").collect(), key=lambda r: r["seg"])  # one for each segment
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        since = max((r["since"] for r in found), default=0)
        return [r for r in found if r["seg"] >= since]

    def _facts(self, docs: DataFrame):
        """The number of texts that have a word, and of their words: a text without one is listed, but counts for nothing in a score."""
        return docs.agg(F.count_if(F.col("len") > 0).alias("docs"), F.coalesce(F.sum("len"), F.lit(0)).alias("words")).first()

    def _commit(self, seg: int, batch: str, folder: str, since: int, docs: int, words: int, deletes: int) -> None:
        row = self.spark.createDataFrame([(seg, batch, folder, since, docs, words, deletes)], MARKER)
        row.coalesce(1).write.parquet(f"{self.path}/commits/seg-{seg:012d}")  # fails where another writer took the number

    def add(self, batch: str, texts: DataFrame, text_col: str = "text") -> bool:
        """Add texts as a segment; one whose key is known takes the older one's place. False if the batch was committed before."""
        marks = self.markers()
        if any(m["batch"] == batch for m in marks):
            return False
        seg, folder = max((m["seg"] for m in marks), default=0) + 1, f"run={uuid.uuid4().hex}"
        terms = F.regexp_extract_all(_lower(F.col(text_col)), F.lit(TERM), F.lit(0))
        rows = texts.where(F.col(self.key).isNotNull()).select(F.col(self.key).cast(self.key_type).alias("key"), F.coalesce(terms, F.array().cast("array<string>")).alias("w"))
        self._write(rows.mapInArrow(_blocks, self._blocks_schema()), folder, seg)
        listed = self._files("postings", [folder], f"{self._blocks_schema()}, part int").where(F.col("part") == TEXTS)
        listed.select(F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("lens").alias("len")))).write.parquet(f"{self.path}/docs/{folder}")
        docs = self._files("docs", [folder], f"key {self.key_type}, len int")
        facts = self._facts(docs)
        if docs.groupBy("key").count().where("count > 1").limit(1).count():
            raise ValueError(f"batch {batch} repeats a key")
        known = self._live_docs(marks).select("key").join(docs.select("key").hint("merge"), "key", "left_semi") if marks else docs.select("key").limit(0)
        self._commit(seg, batch, folder, 0, facts["docs"], facts["words"], self._write_deletes(known, folder))
        return True

    def delete(self, batch: str, keys: DataFrame) -> bool:
        """Take texts out by their keys; unknown ones change nothing. False if the batch was committed before."""
        marks = self.markers()
        if any(m["batch"] == batch for m in marks):
            return False
        seg, folder = max((m["seg"] for m in marks), default=0) + 1, f"run={uuid.uuid4().hex}"
        gone = keys.select(F.col(self.key).alias("key")).distinct()
        known = self._live_docs(marks).select("key").join(gone.hint("merge"), "key", "left_semi") if marks else gone.limit(0)
        self._commit(seg, batch, folder, 0, 0, 0, self._write_deletes(known, folder))
        return True

    def merge(self) -> None:
        """Write what counts as one segment, which stands for all before it."""
        marks = self.markers()
        if not marks:
            return
        seg, folder = marks[-1]["seg"] + 1, f"run={uuid.uuid4().hex}"
        docs = self._live_docs(marks)
        docs.select("key", "len").write.parquet(f"{self.path}/docs/{folder}")
        facts = self._facts(self._files("docs", [folder], f"key {self.key_type}, len int"))
        rows = self._live_postings(marks, None).repartition("part", F.pmod(F.xxhash64("key"), F.lit(self.slices)))
        self._write(rows.select("term", F.array("key").alias("keys"), F.array("len").alias("lens"), F.array(F.size("positions")).alias("counts"), F.col("positions").alias("places")), folder, seg)
        self._commit(seg, f"merge-{seg}", folder, seg, facts["docs"], facts["words"], 0)

    def _blocks_schema(self) -> str:
        return f"term string, keys array<{self.key_type}>, lens array<int>, counts array<int>, places array<int>"

    def _part(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.parts)).cast("int")

    def _write(self, rows: DataFrame, folder: str, seg: int) -> None:
        part = F.when(F.col("term").isNull(), TEXTS).otherwise(self._part(F.col("term")))
        rows.select(F.lit(seg).cast("long").alias("seg"), "term", "keys", "lens", "counts", "places", part.alias("part")).sortWithinPartitions("part", "term").write.partitionBy("part").parquet(f"{self.path}/postings/{folder}")

    def _write_deletes(self, keys: DataFrame, folder: str) -> int:
        keys.write.parquet(f"{self.path}/deletes/{folder}")
        return self._files("deletes", [folder], f"key {self.key_type}").count()

    def _deletes(self, marks: list) -> DataFrame | None:
        """(key, until): a key's rows in older segments don't count."""
        folders = {m["folder"]: m["seg"] for m in marks if m["deletes"]}
        if not folders:
            return None
        seg_of = F.create_map(*[F.lit(x) for kv in folders.items() for x in (kv[0].removeprefix("run="), kv[1])])
        gone = self._files("deletes", list(folders), f"key {self.key_type}, run string")
        return gone.groupBy(F.col("key").alias("d_key")).agg(F.max(F.try_element_at(seg_of, F.col("run"))).alias("until"))

    def _live(self, rows: DataFrame, marks: list) -> DataFrame:
        gone = self._deletes(marks)
        if gone is None:
            return rows
        return rows.join(gone.hint("merge"), (F.col("key") == F.col("d_key")) & (F.col("seg") < F.col("until")), "left_anti")

    def _live_docs(self, marks: list) -> DataFrame:
        folders = {m["folder"]: m["seg"] for m in marks if m["docs"]}
        if not folders:
            return self.spark.createDataFrame([], f"key {self.key_type}, len int, seg long")
        seg_of = F.create_map(*[F.lit(x) for kv in folders.items() for x in (kv[0].removeprefix("run="), kv[1])])
        docs = self._files("docs", list(folders), f"key {self.key_type}, len int, run string")
        return self._live(docs.withColumn("seg", F.try_element_at(seg_of, F.col("run")).cast("long")).drop("run"), marks)

    def _live_postings(self, marks: list, terms: list[str] | None) -> DataFrame:
        folders = [m["folder"] for m in marks if m["docs"]]
        if not folders:
            return self.spark.createDataFrame([], f"seg long, key {self.key_type}, len int, term string, positions array<int>, part int")
        rows = self._files("postings", folders, f"seg long, {self._blocks_schema()}, run string, part int").where(F.col("part") != TEXTS)
        if terms is not None:
            wanted = self.spark.range(1).select(*[self._part(F.lit(t)).alias(f"p{i}") for i, t in enumerate(terms)]).first()
            rows = rows.where(F.col("part").isin(*sorted(set(wanted))) & F.col("term").isin(*terms))
        rows = rows.mapInArrow(_unpacked, f"seg long, key {self.key_type}, len int, term string, positions array<int>, part int")
        return self._live(rows, marks)

    def postings(self, terms: list[str]) -> DataFrame:
        """(key, len, term, positions) of some terms: only their partitions are read."""
        return self._live_postings(self.markers(), terms).select(F.col("key").alias(self.key), "len", "term", "positions")

    def find_all(self, query: str) -> DataFrame:
        """(key, hits): the texts that hold every word and phrase of a query, and how often."""
        wanted = _phrases(query)
        if not wanted:
            return self.postings([""]).select(self.key, F.lit(0).cast("long").alias("hits")).limit(0)
        terms = sorted({w for p in wanted for w in p})
        held = self.postings(terms).groupBy(self.key).agg(*[F.max(F.when(F.col("term") == t, F.col("positions"))).alias(f"t{i}") for i, t in enumerate(terms)])
        at = {t: F.coalesce(F.col(f"t{i}"), F.array().cast("array<int>")) for i, t in enumerate(terms)}
        counts = []
        for phrase in wanted:
            starts = at[phrase[0]]
            for k, word in enumerate(phrase[1:], 1):
                starts = F.array_intersect(starts, _back(at[word], k))
            counts.append(F.size(starts))
        hits = sum(counts[1:], counts[0]).cast("long")
        return held.where(F.least(*counts) > 0 if len(counts) > 1 else counts[0] > 0).select(self.key, hits.alias("hits"))

    def bm25(self, query: str, k1: float = 1.2, b: float = 0.75) -> DataFrame:
        """(key, score) of texts that hold a word of the query. Their number and mean length are of the texts that have a word."""
        terms = sorted({w for p in _phrases(query) for w in p})
        marks = self.markers()
        if any(m["deletes"] for m in marks):
            whole = self._facts(self._live_docs(marks))
            n, words = whole["docs"], whole["words"]
        else:
            n, words = sum(m["docs"] for m in marks), sum(m["words"] for m in marks)
        mean = words / n if n else 1.0
        rows = self._live_postings(marks, terms or [""])
        df = {r["term"]: r["n"] for r in rows.groupBy("term").agg(F.count("*").alias("n")).collect()}  # a row for each term asked for
        idf = F.create_map(*[F.lit(x) for t in terms or [""] for x in (t, math.log(1 + (n - df.get(t, 0) + 0.5) / (df.get(t, 0) + 0.5)))])
        tf = F.size("positions")
        part = F.element_at(idf, F.col("term")) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / mean))
        return rows.groupBy(F.col("key").alias(self.key)).agg(F.sum(part).alias("score")).where("score > 0")


def stored_index(spark: SparkSession, folder: str, table: DataFrame, key: str, text_col: str = "text") -> TextIndex:
    """The index of a table's texts, built in folder on first use and found there as long as the table's files stay the same."""
    files = table.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    state = files.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time")).alias("x")).first()
    index = TextIndex(spark, f"{folder}/text-index-{RULES}-{state['n']}-{(state['x'] or 0) & (1 << 64) - 1:016x}", key, table.schema[key].dataType.simpleString())
    index.add("table", table, text_col)
    return index
