"""SimHash near-dedup with pigeonring filtering.

The fingerprint's bits form a ring of equal segments. If two fingerprints differ in at most k of all bits, then some
segment starts a chain in which, for every length, the differences summed so far stay within that length's share of k.
For as long as that share is under one bit the chain must agree outright, so those segments make the join key; the
longer chains are checked inside the join, before the full Hamming distance. Buckets over hot_bucket fingerprints, where
pairs would be too many, are linked instead through the points that two fingerprints' neighbourhoods of k/2 flipped
bits share: that too is exact, and linear in the bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import letting_go, materialize, small_batches, texts
from .components import connected_components
from .near_copies import SENT_IDS, WORDS, near_components

BITS = 64
SEGMENTS = 8
MAX_DIFF = 2
SHINGLE_WORDS = 3
HOT_BUCKET = 4096
#: Texts, or pairs of sets, that near_dedup hands to Python at a time.
BATCH_ROWS = 1000
#: Shingles hashed at a time, so that one long text takes bounded memory.
BLOCK = 65536


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = 42) -> int:
    """Majority of the bits of the shingles' XXH64; A-Z are lower-cased; a text without words gives 0."""
    w = text.lower().split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    joined, starts, ends, at = b" ".join(w), [], [], 0
    for x in w:
        starts.append(at)
        at += len(x)
        ends.append(at)
        at += 1
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        h = b"".join([digest(joined[starts[i] : ends[min(i + words, len(w)) - 1]], seed) for i in range(lo, hi)])
        counts += np.unpackbits(np.frombuffer(h, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the fingerprint as a signed long."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in texts(b.column(1))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(letting_go(make), f"id {rows.schema['id'].dataType.simpleString()}, fp long")


def chain_budgets(segments: int = SEGMENTS, max_diff: int = MAX_DIFF) -> list[int]:
    """The whole bits that a chain of 1, 2, ... segments may differ in."""
    return [n * max_diff // segments for n in range(1, segments + 1)]


def _rotated(fp: Column, bits: int) -> Column:
    return fp if bits == 0 else F.shiftleft(fp, bits).bitwiseOR(F.shiftrightunsigned(fp, BITS - bits))


def similar_pairs(distinct: DataFrame, max_diff: int = MAX_DIFF, segments: int = SEGMENTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """distinct(fp) to links (u, v), so that fingerprints within max_diff bits are joined by links, directly or over
    fingerprints that are within max_diff bits in turn; every link joins two such fingerprints or a fingerprint to the
    least one with which it shares a neighbouring point."""
    if BITS % segments:
        raise ValueError("segments must divide 64")
    width, budgets = BITS // segments, chain_budgets(segments, max_diff)
    exact = sum(b == 0 for b in budgets)
    if not exact:
        raise ValueError("more segments than differing bits are needed")
    # The key: the start's number, and the segments of the chain that must agree.
    rotations = F.array(*[F.struct(F.lit(r).alias("r"), F.shiftrightunsigned(_rotated(F.col("fp"), r * width), BITS - exact * width if exact < segments else 0).alias("key")) for r in range(segments)])
    rows = materialize(distinct.select("fp", F.explode(rotations).alias("k")).select("fp", "k.r", "k.key"), "segments")
    hot = materialize(rows.groupBy("r", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot_bucket).select("r", "key"), "hot")
    plain = rows
    if some_hot := not hot.isEmpty():
        plain = rows.join(hot.hint("merge"), ["r", "key"], "left_anti")
    a, b = plain.select("r", "key", F.col("fp").alias("u")), plain.select("r", "key", F.col("fp").alias("v"))
    diff = F.col("u").bitwiseXOR(F.col("v"))
    from_start = F.lit(None).cast("long")
    for r in range(segments):
        from_start = F.when(F.col("r") == r, _rotated(diff, r * width)).otherwise(from_start)
    within = F.lit(True)
    for n in range(exact + 1, segments):
        if budgets[n - 1] < budgets[n]:  # a longer chain with the same budget says more
            within = within & (F.bit_count(F.shiftrightunsigned(from_start, BITS - n * width)) <= budgets[n - 1])
    pairs = a.hint("merge").join(b.hint("merge"), ["r", "key"]).where((F.col("u") < F.col("v")) & within & (F.bit_count(diff) <= max_diff)).select("u", "v")
    if some_hot:
        pairs = pairs.union(_neighbour_links(rows.join(hot.hint("merge"), ["r", "key"], "left_semi").select("fp").distinct(), max_diff))
    return pairs.distinct()


def _neighbour_links(rows: DataFrame, max_diff: int) -> DataFrame:
    """Links through shared points: two fingerprints are within max_diff (even) bits if and only if some point is within half of it of both. An odd max_diff takes in points on one side of the middle as well, and is checked there."""
    if max_diff % 2:
        raise ValueError("buckets over hot_bucket need an even max_diff")
    masks = [sum(1 << i for i in flips) for n in range(max_diff // 2 + 1) for flips in combinations(range(BITS), n)]
    points = F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks]))
    near = materialize(rows.select("fp", points.alias("point")), "points")
    first = materialize(near.groupBy("point").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1").select("point", "u"), "firsts")
    return near.join(first.hint("merge"), "point").where("u <> fp").select("u", F.col("fp").alias("v"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_diff: int = MAX_DIFF, segments: int = SEGMENTS, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """One row for each row of docs: id_col, fp (signed long), component_id (the least id reachable over links).

    Null and empty texts, and texts of white space, have fingerprint 0 and are linked like any others. Texts with fewer
    words than a shingle are hashed whole. Null ids get a fingerprint and a component, but never name one unless all
    ids in it are null. Repeated rows each get their row. Other columns are not looked at; no rows give no rows.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = connected_components(similar_pairs(distinct.select("fp"), max_diff, segments, hot_bucket))
    named = distinct.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    linked = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = materialize(named.join(linked, "root").select("fp", "component_id"), "classes")
    return fps.join(classes.hint("merge"), "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def fingerprint_candidates(docs: DataFrame, words: int = WORDS, max_diff: int = MAX_DIFF) -> DataFrame:
    """docs(id, text) to pairs (u, v), u < v, that may be near copies by their fingerprints over so many words: a document and the
    least one with its fingerprint, and the least ones of fingerprints that similar_pairs links."""
    fps = materialize(fingerprints(docs.where(F.col("id").isNotNull()), "id", "text", words), "fingerprints")
    least = materialize(fps.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    same = fps.join(least.hint("merge"), "fp").select(F.col("least").alias("u"), F.col("id").alias("v"))
    ends = [least.select(F.col("fp").alias(x), F.col("least").alias(f"{x}_id")).hint("merge") for x in "uv"]
    linked = materialize(similar_pairs(least.select("fp"), max_diff), "fingerprint_pairs").hint("merge").join(ends[0], "u").join(ends[1], "v")
    return same.union(linked.select(F.least("u_id", "v_id"), F.greatest("u_id", "v_id"))).where("u <> v").distinct()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component of near copies: the one with the least id. All columns are kept. Near copies
    share 0.8 of their five-word shingles.

    Fingerprints over five words and pigeonring find candidates, and whole sets are compared. A search by 64 bits can't find
    all of them (see README), so what it misses is found by near_copies.near_components; op10's three words are not used here.

    A row whose id is null stays and links nothing (it can't be named as a copy of another). Where an id comes with several
    texts, each is a document of its own, after those of smaller ids and in the order of a hash; rows that repeat the kept id with
    the same text all stay: exact copies are another operator's work.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    name = F.col("id")
    if not rows.where("id is not null").groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        name = F.when(F.col("id").isNotNull(), F.struct("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("copy")))
    rows = rows.select(name.alias("id"), "text")
    with small_batches(docs.sparkSession, BATCH_ROWS):
        found = near_components(rows, candidates=fingerprint_candidates(rows))
        gone = materialize(found.where(F.col("id") != F.col("component_id")).select(F.col("id").alias("_gone")).distinct(), "gone")
    gone = F.broadcast(gone) if gone.count() <= SENT_IDS else gone.hint("merge")
    if not isinstance(gone.schema["_gone"].dataType, StructType):
        return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
    copy = F.xxhash64(F.coalesce(docs[text_col], F.lit("")))
    return docs.join(gone, (docs[id_col] == gone["_gone"]["id"]) & (copy == gone["_gone"]["copy"]), "left_anti")
