"""Importance resampling toward a target text: documents are drawn by how much likelier the target's words make them.

A table of 256 bytes lower-cases A-Z and blanks separators, bytes.split gives the words, and crc32 with the crc of the
words before as its seed gives each run of words its hash without joining them. Counters sum features in each task, which
gives at most one row a bucket to the shuffle. A bucket's gain is the logarithm of its share in the target over its share
in the corpus, both smoothed by one; a document's weight is the mean gain of its features. Weight plus Gumbel noise,
which each document's id alone decides, is the score; the highest scores are a draw without replacement.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, texts

BUCKETS, LONGEST = 10_000, 1
#: Of the documents with at least LEAST_WORDS words, DRAWN in 100 are drawn.
LEAST_WORDS, DRAWN = 20, 10
SEED = 2024
#: Distinct hashes that a counter holds before it is added to the buckets, and words whose hashes a worker remembers.
COUNTED = REMEMBERED = 1 << 16
#: Letters and digits stay, A-Z in lower case, as does all that is not ASCII; other bytes separate.
TABLE = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())


def words_of(text: bytes) -> list[bytes]:
    return text.translate(TABLE).split()


class _Crc(dict):
    """crc32 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = found = zlib.crc32(word)
        return found


_crc = _Crc()


def feature_hashes(words: list[bytes], longest: int = LONGEST) -> list[int]:
    """crc32 of each run of 1 to longest words joined by one space: all single words first, then all pairs, and so on."""
    found = last = list(map(_crc.__getitem__, words))
    for n in range(1, longest):
        last = [zlib.crc32(b" " + w, seed) for seed, w in zip(last, words[n:])]  # noqa: B905 - the last run has no next word
        found = found + last
    return found


def bucket_counts(rows: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): the features of all texts, repeats counted; buckets without one have no row. Null texts have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counter = np.zeros(buckets, np.int64), Counter()

        def add() -> None:
            hashes = np.fromiter(counter.keys(), np.int64, len(counter))
            np.add.at(sums, hashes % buckets, np.fromiter(counter.values(), np.int64, len(counter)))
            counter.clear()

        for b in batches:
            for text in texts(b.column(0)):
                counter.update(feature_hashes(words_of(text), longest))
                if len(counter) >= COUNTED:
                    add()
        add()
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    return rows.select(text_col).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """For each bucket floor(1000 * ln of its smoothed share in the target over that in the corpus).

    The counts come to the driver: one number for each of a fixed number of buckets.
    """
    counts = []
    for rows, col in ((corpus, text_col), (target, target_col)):
        n = [0] * buckets
        for r in bucket_counts(rows, col, buckets, longest).collect():
            n[r["bucket"]] = r["n"]
        counts.append((n, sum(n)))
    (s, all_s), (t, all_t) = counts
    return np.array([floor(1000 * log(float(t[i] + 1) * (all_s + buckets) / (float(s[i] + 1) * (all_t + buckets)))) for i in range(buckets)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", longest: int = LONGEST) -> DataFrame:
    """(id, n_words, n_features, weight) for each row of docs: weight is the floored mean gain of its features, 0 for none."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)  # a number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for b in batches:
            rows = []
            for text in texts(b.column(1)):
                words = words_of(text)
                hashes = feature_hashes(words, longest)
                total = int(gains[np.fromiter(hashes, np.int64, len(hashes)) % len(gains)].sum())
                rows.append((len(words), len(hashes), total // len(hashes) if hashes else 0))
            columns = np.array(rows, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(np.ascontiguousarray(c)) for c in columns)], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def noise(id_col: Column, seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) by the id alone; a null id counts as an empty one."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    least_words: int = LEAST_WORDS,
    drawn: int = DRAWN,
    seed: int = SEED,
) -> DataFrame:
    """One row for each row of docs: id_col, n_features, weight, score, rank.

    Of the rows with at least least_words words, the drawn per cent (rounded down) with the highest scores have a rank from
    1 on; of equal scores the smaller id is first, a null id before all. Other rows have a null rank. Null texts have no
    features and weight 0. Rows that repeat an id get ranks of their own. Other columns are not looked at. An empty target
    gives gains by the corpus alone; no rows give no rows.

    Ranks need no sort of all rows: gains lie within 45,000 of zero (1000 * ln of 64-bit counts), noise between -3,200 and
    22,900, so scores have some 115,000 values at most. Counts by score say which are drawn and how many rows lie above
    each; rows are numbered only within a score.
    """
    gains = bucket_gains(docs, target, text_col, target_col, buckets, longest)
    weighed = weigh(docs, gains, id_col, text_col, longest)
    scored = materialize(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    may_be = scored.where(F.col("n_words") >= least_words)
    counts = may_be.groupBy("score").agg(F.count("*").alias("n"))
    above = materialize(counts.select("score", (F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).alias("above"), "n"), "above")
    total = above.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    cut = drawn * total // 100
    wanted = above.where(F.col("above") < cut).select("score", "above")
    within = F.row_number().over(Window.partitionBy("score").orderBy("id"))
    ranked = may_be.join(F.broadcast(wanted), "score").withColumn("rank", F.col("above") + within)
    rest = scored.join(F.broadcast(wanted), "score", "left").where((F.col("n_words") < least_words) | F.col("above").isNull()).withColumn("rank", F.lit(None).cast("long"))
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return ranked.select(*columns, F.when(F.col("rank") <= cut, F.col("rank")).alias("rank")).union(rest.select(*columns, "rank"))
