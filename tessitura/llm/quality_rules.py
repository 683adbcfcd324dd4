"""Host-level quality rules.

Each document is measured once, in Arrow batches. Rules turn the measures into failures, which are summed by host; a
host's failure rate is shrunk toward all hosts' by an empirical beta prior, so that a host with few documents is judged
mostly by the prior. A host loses its documents if for some rule its posterior says with about 95 % that its rate is over
the limit: twice the prior's mean, one half at most. Hosts that are all alike are all kept, however large they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts

SYMBOLS = b"#*$%&|<>"
SPACES = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: A rate is too high beyond so many times the prior's mean, and beyond this in any case; so many standard deviations of the
#: posterior must lie above.
TIMES_MEAN, MAX_RATE, SURE = 2.0, 0.5, 1.645
#: Up to so many hosts are sent to all executors.
SENT_HOSTS = 200_000
SALT = 16
#: The prior's weights in documents that are tried, and the one where no host has two documents.
WEIGHTS, EVEN_WEIGHT = tuple(float(1 << k) for k in range(11)), 10.0


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows that the list holds twice or more, the first time included."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    if len(seen) == len(words):
        return 0
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) < 1 << 20:
        keys = pairs[:-1] * len(seen) + ids[2:]
    else:  # beyond 64 bits
        keys = np.unique(pairs, return_inverse=True)[1][:-1] * len(seen) + ids[2:]
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(keys)] |= twice
    return int(covered.sum())


def measure_text(text: bytes) -> tuple[int, int, int, int, int]:
    """The MEASURES of a whole text."""
    words = text.split()
    dup, seen = 0, set()
    for line in text.split(b"\n"):
        if line.strip():
            if line in seen:
                dup += 1
            seen.add(line)
    chars = len(text.decode("utf-8")) - sum(text.count(s) for s in SPACES)
    return len(words), chars, len(text) - len(text.translate(None, SYMBOLS)), dup, repeated_words(words)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(id, host) and the MEASURES for each row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([measure_text(t) for t in texts(b.column(2))], np.int64).reshape(b.num_rows, len(MEASURES))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(np.ascontiguousarray(c)) for c in found.T)], names=["id", "host", *MEASURES])

    rows = docs.select(F.col(id_col).alias("id"), F.col(host_col).cast("string").alias("host"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """What a document fails, by name."""
    return {
        "base": base_failed(),
        "symbols": F.col("n_symbols") * 10 > F.col("n_words"),
        "dup_lines": F.col("n_dup_lines") * 10 > F.col("n_words"),
        "word_length": (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words")),
    }


def _likelihoods(counts: DataFrame, means: dict[str, float]) -> DataFrame:
    """(rule, weight, ll): for each weight of the prior the log likelihood of counts(rule, docs, failed, hosts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, float], float] = {}
        g = lgamma
        for b in batches:
            for rule, n, k, hosts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for w in WEIGHTS:
                    x, y = means[rule] * w, (1 - means[rule]) * w
                    sums[rule, w] = sums.get((rule, w), 0.0) + hosts * (g(k + x) - g(x) + g(n - k + y) - g(y) + g(w) - g(n + w))
        rows = [(r, w, ll) for (r, w), ll in sums.items()]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.float64()), strict=True)], names=["rule", "weight", "ll"])

    return counts.select("rule", "docs", "failed", "hosts").mapInArrow(run, "rule string, weight double, ll double").groupBy("rule", "weight").agg(F.sum("ll").alias("ll"))


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE, times_mean: float = TIMES_MEAN, sure: float = SURE) -> DataFrame:
    """(host, docs, host_kept) for each host: kept unless for some rule the shrunk failure rate, less sure standard
    deviations of its posterior, is over times_mean the prior's mean or over max_rate.

    The prior's mean is all documents' rate. Its weight is the one of WEIGHTS under which the hosts' counts are likeliest
    (beta-binomial, so that chance is not taken for difference); of equals the largest. Hosts of one document say nothing
    about it, however many they are, and where there are no others it is a middle one. Rows with a null host count for none.
    """
    names = rules()
    hosts = measured.where("host is not null").groupBy("host").agg(F.count("*").alias("docs"), *[F.count_if(c).alias(n) for n, c in names.items()])
    hosts = materialize(hosts, "hosts")
    facts = hosts.agg(F.sum("docs").alias("docs"), *[F.sum(n).alias(n) for n in names]).first()
    means = {n: facts[n] / facts["docs"] for n in names} if facts["docs"] else {}
    each = hosts.where("docs > 1").select(F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), "docs", F.col(n).alias("failed")) for n in names])).alias("r")).select("r.*")
    mixed = [n for n, m in means.items() if 0 < m < 1]
    counts = each.where(F.col("rule").isin(*mixed or [""])).groupBy("rule", "docs", "failed").agg(F.count("*").alias("hosts"))
    best: dict[str, tuple[float, float]] = {}
    for r in _likelihoods(counts, means).collect():  # a row for each rule and weight
        best[r["rule"]] = max(best.get(r["rule"], (float("-inf"), 0.0)), (round(r["ll"], 6), r["weight"]))
    kept = F.lit(True)
    for n, mean in means.items():
        weight = best[n][1] if n in best else EVEN_WEIGHT
        shrunk = (F.col(n) + mean * weight) / (F.col("docs") + weight)
        kept = kept & (shrunk - sure * F.sqrt(shrunk * (1 - shrunk) / (F.col("docs") + weight + 1)) <= min(max_rate, times_mean * mean))
    return hosts.select("host", "docs", kept.alias("host_kept"))


def apply_quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row for each row of docs: id_col, the MEASURES, base_failed, kept.

    kept is false if base_failed or if the host is not kept. A null host is no host: its documents are judged alone.
    Null ids and repeated rows are carried through. Other columns are not looked at; no rows give no rows.
    """
    measured = materialize(measure(docs, id_col, text_col, host_col), "measured")
    bad = materialize(host_verdicts(measured, max_rate).where("not host_kept").select("host", F.lit(True).alias("_bad")), "bad_hosts")
    # A row a host: where they are many, rows are dealt by host and a hash, and hosts repeated for each, so that no host is one task.
    if bad.count() <= SENT_HOSTS:
        judged = measured.withColumn("base_failed", base_failed()).join(F.broadcast(bad), "host", "left")
    else:
        salted = bad.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("_salt"))
        judged = measured.withColumn("base_failed", base_failed()).withColumn("_salt", F.pmod(F.xxhash64("id", *MEASURES), F.lit(SALT)).cast("int")).join(salted.hint("merge"), ["host", "_salt"], "left")
    return judged.select(F.col("id").alias(id_col), *MEASURES, "base_failed", (~F.col("base_failed") & F.col("_bad").isNull()).alias("kept"))
