"""The registered queries of the corpus operators, and their SQL."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc32_id, read, shared_dir
from .exact_dedup import exact_dedup
from .importance import resample
from .language_id import identify, is_held_out
from .line_dedup import drop_repeated_lines
from .mixing import mix
from .packing import pack
from .quality_rules import apply_quality_rules
from .runs import find_runs, strongest
from .sentence_pieces import encode_pieces
from .simhash import simhash_components
from .token_counts import TokenRollup, count_tokens
from .toxicity import toxicity
from .url_filter import judge_urls


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches: all documents come in; those of low quality go; toxic ones come anew with white space squeezed."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    tokenizers = {"byte_bpe_50k": public_tokenizers.path("byte_bpe_50k.json"), "words": None}
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    rollup.apply("1-insert", count_tokens(docs, tokenizers))
    revised = docs.join(labels.where("toxic = 1 and quality = 1").select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").withColumn("text", F.regexp_replace("text", r"\s+", " "))
    rollup.apply("2-review", count_tokens(revised, tokenizers), labels.where("quality = 0").select("doc_id"))
    return rollup.totals()


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(read(spark, sf_dir, "documents"))


OP3_SQL = r"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
l AS (SELECT doc_id, unnest(l) AS x, unnest(range(len(l))) AS i FROM s),
w AS (SELECT doc_id, i AS first, x AS a, lead(x) OVER d AS b, lead(x, 2) OVER d AS c, lead(i, 2) OVER d AS last
  FROM l WHERE regexp_matches(x, '[^\x20\x09-\x0D]') WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
t AS (SELECT doc_id, first, last, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, first) AS k FROM w WHERE c IS NOT NULL),
gone AS (SELECT DISTINCT l.doc_id, l.i FROM l JOIN t ON l.doc_id = t.doc_id AND l.i BETWEEN t.first AND t.last WHERE t.k > 1)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(gone.i)::BIGINT AS n_removed,
  coalesce(string_agg(l.x, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents")).select("doc_id", is_held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read(spark, sf_dir, "documents"))


OP5_SQL = """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT doc_id, sha256(t) AS text_sha256, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM n)
SELECT doc_id, keep_id, CAST(group_size AS BIGINT) AS group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages"))


OP6_SQL = r"""
WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
r AS (SELECT *, CASE
  WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN regexp_matches(host || path, '^([^/]*[.-])?(ads|track|casino)[.-]|/(login|cart|feed)([/.]|$)') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(read(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, unnest(ws) AS x, unnest(range(len(ws))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d)),
v AS (SELECT *, lead(x) OVER o AS b, lead(x, 2) OVER o AS c FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT *, CASE WHEN c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, x, b, c) > 1 THEN 1 ELSE 0 END AS twice FROM v),
k AS (SELECT *, max(twice) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM n),
a AS (SELECT doc_id, count(*) AS n_words, sum(length(x)) AS word_chars, sum(hit) AS n_repeat_words FROM k GROUP BY doc_id),
l AS (SELECT doc_id, sum(m - 1) AS n_dup_lines FROM (SELECT doc_id, x, count(*) AS m FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS x FROM d)
  WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id, x) GROUP BY doc_id),
f AS (SELECT d.doc_id, source, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN a USING (doc_id) LEFT JOIN l USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS n, count_if(base_failed) AS k1, count_if(n_symbols * 10 > n_words) AS k2, count_if(n_dup_lines * 10 > n_words) AS k3,
  count_if(word_chars < 3 * n_words OR word_chars > 12 * n_words) AS k4 FROM b WHERE source IS NOT NULL GROUP BY source),
u AS (SELECT source, n, unnest([1, 2, 3, 4]) AS j, unnest([k1, k2, k3, k4]) AS k FROM h),
m AS (SELECT j, sum(k)::DOUBLE / sum(n) AS mean FROM u GROUP BY j), e AS (SELECT unnest([1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024])::DOUBLE AS w),
z AS (SELECT j, w, round(sum(lgamma(k + mean * w) - lgamma(mean * w) + lgamma(n - k + (1 - mean) * w) - lgamma((1 - mean) * w) + lgamma(w) - lgamma(n + w)), 6) AS ll FROM u JOIN m USING (j), e WHERE n > 1 AND mean > 0 AND mean < 1 GROUP BY j, w),
q AS (SELECT j, mean, coalesce((SELECT arg_max(w, (ll, w)) FROM z WHERE z.j = m.j), 10)::DOUBLE AS weight FROM m),
y AS (SELECT source, n, mean, weight, (k + mean * weight) / (n + weight) AS p FROM u JOIN q USING (j)),
bad AS (SELECT DISTINCT source FROM y WHERE p - 1.645::DOUBLE * sqrt(p * (1 - p) / (n + weight + 1)) > least(0.5::DOUBLE, 2 * mean))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.source IS NULL AS kept FROM b LEFT JOIN bad ON b.source = bad.source
"""


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read(spark, sf_dir, "documents"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS i FROM d GROUP BY source),
w AS (SELECT source, n, 2::DOUBLE * n AS lim, CASE i WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS w FROM s),
o AS (SELECT *, 1.5::DOUBLE * (sum(n) OVER ())::DOUBLE - coalesce(sum(lim) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
  sum(w) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share FROM w WINDOW r AS (ORDER BY lim / w, source NULLS LAST)),
t AS (SELECT source, n AS source_size, least(lim, coalesce((SELECT lft / share FROM o WHERE lft / share * w < lim ORDER BY lim / w, source NULLS LAST LIMIT 1) * w, lim)) AS target FROM o),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0::DOUBLE END AS f FROM t),
q AS (SELECT *, floor(f) AS whole, target - floor(f) * source_size AS rest FROM p),
e AS (SELECT d.source, d.size, any_value(rest) AS rest, count(*) AS k FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source WHERE rest > 0 AND size > 0 GROUP BY d.source, d.size),
r AS (SELECT source, size, (rest - coalesce(sum(size * k) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE) / (sum(size::HUGEINT * size * k) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
  FROM e WINDOW o AS (PARTITION BY source ORDER BY size DESC)),
z AS (SELECT source, arg_max(rate, size) AS rate FROM r WHERE rate * size < 1 GROUP BY source),
u AS (SELECT doc_id, size, q.*, least(1::DOUBLE, rate * size) AS pi, (('0x' || substr(md5(doc_id::VARCHAR), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source LEFT JOIN z ON d.source IS NOT DISTINCT FROM z.source),
g AS (SELECT *, CASE WHEN rest > 0 AND pi > 0 THEN (u / (1 - u)) * ((1 - pi) / pi) END AS odds FROM u),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY odds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS reached FROM g)
SELECT doc_id, size, source_size, target, (whole + CASE WHEN odds IS NOT NULL AND reached <= rest THEN 1 ELSE 0 END)::INTEGER AS copies,
  ((whole + CASE WHEN odds IS NOT NULL AND reached <= rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM c
"""


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(crc32_id(F.col("doc_id")) % 5 == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def periodic_words(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words, or for the ids that op11's contract names, words that repeat from some place on. A null id is not named."""
    n, h = len(words), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    root = words[a : a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (root * (-(-(n - a) // len(root))))[: n - a]


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_runs(read(spark, sf_dir, "documents"), words_of=periodic_words).withColumn("best", strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
o AS (SELECT doc_id, unnest(ws) AS w FROM d),
p AS (SELECT unnest(ws) AS w FROM b),
v AS (SELECT DISTINCT w FROM (SELECT w FROM o UNION ALL SELECT w FROM p)),
y AS (SELECT w, list_transform(range(1, length(hex(w)), 2), lambda i: ('0x' || substr(hex(w), i, 2))::BIGINT) AS bytes FROM v),
h AS (SELECT w, xor(list_reduce(list_prepend(4294967295, bytes), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS bucket FROM y, crc),
s AS (SELECT bucket, count(*) AS n FROM o JOIN h USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM p JOIN h USING (w) GROUP BY bucket),
g AS (SELECT i AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM o) + 10000) / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM p) + 10000)))) AS gain
  FROM range(10000) r(i) LEFT JOIN s ON s.bucket = i LEFT JOIN t ON t.bucket = i),
m AS (SELECT doc_id, count(*) AS n, floor(sum(gain) / count(*)) AS weight FROM o JOIN h USING (w) JOIN g USING (bucket) GROUP BY doc_id),
k AS (SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score FROM d LEFT JOIN m ON d.doc_id = m.doc_id),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM k WHERE n_features >= 20)
SELECT k.doc_id, n_features, weight, score, CASE WHEN place <= (SELECT count(*) FROM r) * 10 // 100 THEN place END::BIGINT AS rank FROM k LEFT JOIN r ON k.doc_id = r.doc_id
"""


def op13_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_simhash": op10_simhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_importance": op12_importance,
    "op13_sentence_pieces": op13_sentence_pieces,
}
ORACLES: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op5_exact_dedup": OP5_SQL,
    "op6_url_filter": OP6_SQL,
    "op7_quality_rules": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op12_importance": OP12_SQL,
}
