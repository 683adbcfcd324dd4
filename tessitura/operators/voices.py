"""Voices known by their vectors: matching against the labels' centroids, and the thresholds that labelled vectors allow.

Every vector meets every centroid, as a product of matrices: vectors are dealt to groups of a bounded number, centroids to
blocks, and each group meets each block in one task, which gives the best two of the block. The best two of all blocks
are then taken. A vector's own part is left out of its label's centroid.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessitura.functions.tables import written

#: Vectors of a group, and centroids of a block.
GROUP, BLOCK = 4096, 1024
#: A label has a threshold if its own vectors' similarities lie so far above all others', and bounds of its gap.
SEPARATION, LEAST_GAP, MOST_GAP = 0.08, 0.05, 0.10


def _norm(v: str) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))


def scored(vectors: DataFrame, id_col: str, vector: str, label: str, group: int = GROUP, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Two tables, written: for each vector (id, label, best, similarity, second, own, other), and for each label (label, others).

    best is the label of the nearest centroid, the smaller label of equals; second the next similarity; own that to its own
    label's other vectors; other the best to other labels. others is the best similarity of another label's vector to
    this label; vectors without a label don't count there. Null without such a centroid. Vectors that are null, empty or zero, or hold a null, have no rows; vectors
    of different lengths raise an error.
    """
    v = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.transform(vector, lambda x: x.cast("double")).alias("v")).where(F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))
    v = written(v.withColumn("len", _norm("v")).where("len > 0").select("id", "label", F.transform("v", lambda x: x / F.col("len")).alias("v")), "vectors")
    facts = v.agg(F.count("*").alias("n"), F.min(F.size("v")).alias("least"), F.max(F.size("v")).alias("most")).first()
    if facts["least"] != facts["most"]:
        raise ValueError(f"vectors have from {facts['least']} to {facts['most']} numbers")
    sums = v.where("label is not null").select("label", F.posexplode("v").alias("i", "x")).groupBy("label", "i").agg(F.sum("x").alias("s"), F.count("*").alias("n"))
    c = written(sums.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("c"), F.max("n").alias("n")), "centroids")
    groups, blocks = max(1, -(-facts["n"] // group)), max(1, -(-c.count() // block))
    salt = F.pmod(F.xxhash64("v"), F.lit(groups)).cast("int")
    left = v.withColumn("salt", salt).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = c.withColumn("block", F.pmod(F.xxhash64("label"), F.lit(blocks)).cast("int")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    id_type, label_type = v.schema["id"].dataType.simpleString(), v.schema["label"].dataType.simpleString()

    def product(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["row", "id", "label", "s1", "l1", "s2", "own", "other"]
        if not len(a) or not len(b):
            return pd.DataFrame({n: pd.Series(dtype=object) for n in names})
        b = b.sort_values("label").reset_index(drop=True)
        x, y, n, labels = np.stack(a["v"].to_numpy()), np.stack(b["c"].to_numpy()), b["n"].to_numpy(), b["label"].to_numpy()
        length = np.linalg.norm(y, axis=1)
        dots = x @ y.T
        with np.errstate(divide="ignore", invalid="ignore"):
            sims = dots / length
            at = pd.Index(labels).get_indexer(a["label"])
            rows = np.flatnonzero(at >= 0)
            cols = at[rows]
            rest = np.sqrt(np.maximum(length[cols] ** 2 - 2 * dots[rows, cols] + 1, 0))
            own = np.where(n[cols] > 1, (dots[rows, cols] - 1) / rest, -np.inf)
        mine = np.full(len(a), -np.inf)
        mine[rows] = own
        others = sims.copy()
        others[rows, cols] = -np.inf
        sims[rows, cols] = own
        best = np.argmax(sims, axis=1)
        top = sims[np.arange(len(a)), best]
        rest_of = sims.copy()
        rest_of[np.arange(len(a)), best] = -np.inf
        made = pd.DataFrame({"row": "v", "id": a["id"].to_numpy(), "label": a["label"].to_numpy(), "s1": top, "l1": labels[best], "s2": rest_of.max(axis=1), "own": mine, "other": others.max(axis=1)})
        per = pd.DataFrame({"row": "c", "id": None, "label": labels, "s1": None, "l1": None, "s2": None, "own": None, "other": others[a["label"].notna().to_numpy()].max(axis=0, initial=-np.inf)})
        return pd.concat([made.astype(object), per.astype(object)], ignore_index=True)[names]

    schema = f"row string, id {id_type}, label {label_type}, s1 double, l1 {label_type}, s2 double, own double, other double"
    met = written(left.groupBy("salt", "block").cogroup(right.groupBy("salt", "block")).applyInPandas(product, schema), "products")
    known = lambda x: F.when(x > float("-inf"), x)  # noqa: E731 - minus infinity stands for none
    tops = F.flatten(F.collect_list(F.array("s1", "s2")))  # two for each block of centroids
    by_id = met.where("row = 'v'").groupBy("id", "label").agg(F.min_by("l1", F.struct(-F.col("s1"), F.col("l1"))).alias("best"), F.sort_array(tops, False).alias("t"), F.max("own").alias("own"), F.max("other").alias("other"))
    rows = by_id.where(F.col("t")[0] > float("-inf")).select("id", "label", "best", F.col("t")[0].alias("similarity"), known(F.col("t")[1]).alias("second"), known(F.col("own")).alias("own"), known(F.col("other")).alias("other"))
    per_label = met.where("row = 'c'").groupBy("label").agg(known(F.max("other")).alias("others"))
    return written(rows, "scored"), per_label


def _thresholds(rows: DataFrame, per_label: DataFrame) -> DataFrame:
    own = rows.where("own is not null").groupBy("label").agg(F.min("own").alias("lowest"), F.min(F.col("own") - F.coalesce("other", F.lit(0.0))).alias("clear"))
    t = own.join(per_label.hint("merge"), "label").withColumn("others", F.coalesce("others", F.lit(0.0)))
    apart = F.col("lowest") - F.col("others") > SEPARATION
    gap = F.least(F.lit(MOST_GAP), F.greatest(F.lit(LEAST_GAP), F.col("clear") / 2))
    return t.select("label", "lowest", "others", F.when(apart, F.round((F.col("lowest") + F.col("others")) / 2, 3)).alias("threshold"), F.when(apart, F.round(gap, 3)).alias("gap"))


def voice_thresholds(vectors: DataFrame, id_col: str, vector: str, label: str, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """(label, lowest, others, threshold, gap): the lowest similarity of a label's vectors to the rest of them, and the
    highest of any other vector. Where they are well apart, the threshold lies between; else there is none."""
    return _thresholds(*scored(vectors, id_col, vector, label, group, block)).withColumnRenamed("label", label)


def voice_match(vectors: DataFrame, id_col: str, vector: str, label: str, threshold: float | None = 0.5, gap: float = 0.05, group: int = GROUP, block: int = BLOCK) -> DataFrame:
    """(id, best, similarity, matched, threshold): each vector against the other vectors' centroids, its own left out of its label's.

    Matched if the best is over the threshold and clear of the second by the gap. With no threshold given, each label has
    its own (see voice_thresholds), and a label without one matches nothing. A label with no other vector has no centroid.
    """
    rows, per_label = scored(vectors, id_col, vector, label, group, block)
    t = _thresholds(rows, per_label).select(F.col("label").alias("best"), "threshold", "gap")
    least, apart = (F.col("threshold"), F.col("gap")) if threshold is None else (F.lit(threshold), F.lit(gap))
    met = (F.col("similarity") >= least) & (F.col("similarity") - F.coalesce("second", F.lit(-1.0)) >= apart)
    found = rows.join(t.hint("merge"), "best", "left")
    return found.select(F.col("id").alias(id_col), "best", "similarity", F.coalesce(met, F.lit(False)).alias("matched"), "threshold")
