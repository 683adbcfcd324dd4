"""Queries of the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions.strings import count_words
from tessitura.operators import clean, reports

from .fixtures import EV, SEG, SENT, events, segments
from .registry import query, table

TROUBLE = (
    f"WITH {SENT}"
    + r""", o AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seg, para, sent) AS r FROM sent),
l AS (SELECT *, coalesce(lower(sentence) = lag(lower(sentence)) OVER w AND len(regexp_extract_all(lag(sentence) OVER w, '\S+')) >= 3, false) AS same FROM o WINDOW w AS (PARTITION BY slug ORDER BY r)),
g AS (SELECT *, sum((NOT same)::INT) OVER (PARTITION BY slug ORDER BY r) AS run FROM l), lp AS (SELECT slug, count(*) FILTER (n >= 3) AS loops FROM (SELECT slug, run, count(*) AS n FROM g GROUP BY ALL) GROUP BY slug),
ph AS (SELECT slug, count(*) FILTER (regexp_matches(sentence, '(?i)thanks? for watching|thank you for watching|subtitles? by|amara\.org|please subscribe|like and subscribe|transcribed by')) AS phantoms FROM sent GROUP BY slug),
b AS (SELECT slug, sum(len(regexp_extract_all(text, '\S+'))) AS words, sum(CASE WHEN speaker IS NULL THEN len(regexp_extract_all(text, '\S+')) ELSE 0 END) AS un, sum(len(regexp_extract_all(text, '\[[^\]]{2,25}\]'))) AS brackets, max("end") AS seconds FROM seg GROUP BY slug),
st AS (SELECT slug, start, coalesce(lead(start) OVER (PARTITION BY slug ORDER BY start), b.seconds) AS nxt FROM seg JOIN b USING (slug)),
ga AS (SELECT slug, count(*) AS gaps FROM st WHERE nxt - start >= 90 GROUP BY slug)
SELECT (coalesce(loops, 0) * 5 + coalesce(phantoms, 0) * 3 + coalesce(gaps, 0) * 2 + brackets // 5)::BIGINT AS score, slug, words::BIGINT AS words, round(words / (seconds / 60) * 10)::BIGINT AS wpm_x10, round(100 * un / greatest(words, 1))::BIGINT AS unattributed_pct,
coalesce(loops, 0)::BIGINT AS loops, coalesce(phantoms, 0)::BIGINT AS phantoms, coalesce(gaps, 0)::BIGINT AS gaps, '' AS gap_list, brackets::BIGINT AS brackets FROM b LEFT JOIN lp USING (slug) LEFT JOIN ph USING (slug) LEFT JOIN ga USING (slug)"""
)


@query("a2_trouble_report", TROUBLE)
def a2_trouble_report(spark, sf_dir):
    """Sorted worst first."""
    return reports.trouble_report(segments(spark, sf_dir)).orderBy(F.desc("score"), "slug")


DOC_TROUBLE = r"""WITH p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS p, unnest(range(len(string_split(text, chr(10))))) AS para FROM documents),
t AS (SELECT *, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT doc_id, para, regexp_extract_all(p, '\S+') AS ws FROM p)),
f AS (SELECT *, (regexp_matches(w, '[.?!…]["''”’)\]]*$') AND lower(w) NOT IN ('mr.', 'mrs.', 'ms.', 'dr.', 'st.', 'vs.', 'etc.', 'e.g.', 'i.e.', 'no.', 'jr.', 'sr.', 'prof.')) AS fin FROM t),
n AS (SELECT *, coalesce(sum(fin::INT) OVER (PARTITION BY doc_id, para ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sent FROM f),
s AS (SELECT doc_id, para, sent, string_agg(w, ' ' ORDER BY i) AS sentence, count(*) AS k FROM n GROUP BY ALL),
l AS (SELECT *, coalesce(lower(sentence) = lag(lower(sentence)) OVER w AND lag(k) OVER w >= 3, false) AS same FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY para, sent)),
g AS (SELECT doc_id, sum((NOT same)::INT) OVER (PARTITION BY doc_id ORDER BY para, sent) AS run FROM l)
SELECT doc_id, count(*) FILTER (n >= 3)::BIGINT AS loops FROM (SELECT doc_id, run, count(*) AS n FROM g GROUP BY ALL) GROUP BY doc_id"""


@query("a2_sentence_loops", DOC_TROUBLE)
def a2_sentence_loops(spark, sf_dir):
    from tessitura.operators.sentences import sentences

    paras = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("para", "text"))
    return reports.sentence_loops(sentences(paras, ["doc_id", "para"]), "doc_id", ["para", "sent"])


@query("a1_quality", rf"""WITH {SEG}, q AS (SELECT slug, sum(len(regexp_extract_all(text, '\S+'))) AS words, sum(len(regexp_extract_all(text, '\[[^\]]+\]'))) AS markers, max("end") AS s FROM seg GROUP BY slug)
SELECT slug, words::BIGINT AS words, s::BIGINT AS seconds, round(words / (s / 60) * 10)::BIGINT AS wpm_x10, markers::BIGINT AS markers, words / (s / 60) < 60 OR markers / greatest(words, 1) > 0.05 AS low_confidence FROM q""")
def a1_quality(spark, sf_dir):
    return reports.transcript_quality(segments(spark, sf_dir))


@query("a3_speech_totals", rf"WITH {SEG} SELECT speaker, count(DISTINCT slug)::BIGINT AS recordings, count(*)::BIGINT AS turns, sum(len(regexp_extract_all(text, '\S+')))::BIGINT AS words, min(slug) AS first_slug, arg_min(seg, (slug, seg)) AS first_seg, arg_min(text, (slug, seg)) AS first_text FROM seg WHERE speaker IS NOT NULL GROUP BY speaker")
def a3_speech_totals(spark, sf_dir):
    return reports.speech_totals(segments(spark, sf_dir))


@query("a5_archive_stats", "SELECT o_orderpriority AS type, count(*)::BIGINT AS n, round(sum(o_totalprice) / 3600)::BIGINT AS hours, min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year FROM orders GROUP BY GROUPING SETS ((o_orderpriority), ())")
def a5_archive_stats(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "type")
    return reports.stats_by_type(o, "type", "o_orderdate", "o_totalprice")


@query(
    "a6_ordinary_words",
    r"""WITH t AS (SELECT unnest(regexp_extract_all(text, '(?:[.?!…]["''”’)\]]*\s+)?[A-Za-z]+')) AS t FROM documents), w AS (SELECT regexp_extract(t, '([A-Za-z]+)$', 1) AS w, regexp_matches(t, '\s') AS st FROM t)
SELECT lower(w) AS word, sum((w = lower(w))::INT)::BIGINT AS "lower", sum((regexp_matches(w, '^[A-Z]') AND NOT st)::INT)::BIGINT AS "upper" FROM w GROUP BY lower(w) HAVING sum((w = lower(w))::INT) >= 30 AND sum((w = lower(w))::INT) >= 30 * sum((regexp_matches(w, '^[A-Z]') AND NOT st)::INT)""",
)
def a6_ordinary_words(spark, sf_dir):
    return reports.ordinary_words(table(spark, sf_dir, "documents"))


def _list(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


@query(
    "a7_capital_suspects",
    r"""WITH tok AS (SELECT doc_id, ws, unnest(ws) AS tok, unnest(range(len(ws))) AS idx FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents)),
b AS (SELECT *, trim(tok, '"''“”‘’()[]_.,;:!?…-') AS bare FROM tok),
c AS (SELECT *, CASE WHEN regexp_full_match(bare, '[A-Za-z''’-]+') THEN bare ELSE '' END AS core, right(rtrim(tok, '''’)]'), 1) IN ('.', '?', '!', '…', ':', '”', '"') AS fin FROM b),
f AS (SELECT *, coalesce(lag(fin) OVER o, true) AS first, lag(core) OVER o AS prev FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY idx)),
s AS (SELECT *, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS sentence, (regexp_matches(core, '^[A-Z]') AND core <> 'I' AND NOT first)::INT AS cap FROM f),
n AS (SELECT *, sum(cap) OVER (PARTITION BY doc_id, sentence ORDER BY idx RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) - cap AS near FROM s),
t AS (SELECT unnest(regexp_extract_all(text, '(?:[.?!…]["''”’)\]]*\s+)?[A-Za-z]+')) AS t FROM documents), w AS (SELECT regexp_extract(t, '([A-Za-z]+)$', 1) AS w, regexp_matches(t, '\s') AS st FROM t),
o AS (SELECT lower(w) AS word FROM w GROUP BY lower(w) HAVING sum((w = lower(w))::INT) >= 5 AND sum((w = lower(w))::INT) >= 2 * sum((regexp_matches(w, '^[A-Z]') AND NOT st)::INT)),
h AS (SELECT doc_id, idx, core AS word, array_to_string(ws[greatest(idx - 4, 0) + 1:idx + 5], ' ') AS context FROM n WHERE NOT first AND near = 0 AND regexp_full_match(core, '[A-Z][a-z''’-]*[a-z][a-z''’-]*')
AND prev IN ("""
    + _list(clean.CONTINUERS)
    + ") AND lower(core) NOT IN ("
    + _list(clean.KEEP_CAPITAL)
    + ") AND lower(core) IN (SELECT word FROM o)) SELECT doc_id, idx::INT AS idx, word, count(*) OVER (PARTITION BY word)::BIGINT AS total, context FROM h",
)
def a7_capital_suspects(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return reports.capital_suspects(docs, reports.ordinary_words(docs, least=5, times=2), "doc_id")


@query("a8_review_queue", """SELECT count(*)::BIGINT AS n, arg_min(props, event_id) AS matched, event_type AS candidate, max(value) AS similarity, arg_max(user_id, (value, -event_id)) AS context, string_agg(DISTINCT user_id::VARCHAR, ', ' ORDER BY user_id::VARCHAR) AS sessions, count(*) >= 10 AS noise FROM events GROUP BY lower(trim(props)), event_type""")
def a8_review_queue(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("row"), F.col("user_id").cast("string").alias("session"), F.col("event_type").alias("candidate"), F.col("props").alias("matched"), F.col("value").alias("similarity"), F.col("user_id").alias("context"))
    return reports.collapse_queue(e)


@query("a9_regular_speakers", f"WITH {SEG}, n AS (SELECT speaker, seg % 7 AS part, count(DISTINCT slug) AS recordings FROM seg WHERE speaker IS NOT NULL GROUP BY ALL) SELECT speaker, part, recordings::BIGINT AS recordings FROM n QUALIFY row_number() OVER (ORDER BY recordings DESC, speaker, part) <= 15")
def a9_regular_speakers(spark, sf_dir):
    """Roles by turn of the week stand for people. A top-k report."""
    s = segments(spark, sf_dir).where("speaker is not null").withColumn("part", F.col("seg") % 7)
    return s.groupBy("speaker", "part").agg(F.count_distinct("slug").alias("recordings")).orderBy(F.desc("recordings"), "speaker", "part").limit(15)


@query("a12_missing_information", """SELECT 'no date' AS gap, o_orderkey FROM orders WHERE year(o_orderdate) < 1993 UNION ALL SELECT 'urgent', o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT' UNION ALL SELECT 'no label', o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM labels)""")
def a12_missing_information(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("o_orderkey"), F.lit(True).alias("labelled")).distinct()
    o = table(spark, sf_dir, "orders").join(lab, "o_orderkey", "left")
    return reports.gap_report(o, "o_orderkey", {"no date": F.year("o_orderdate") < 1993, "urgent": F.col("o_orderpriority") == "1-URGENT", "no label": F.col("labelled").isNull()})


@query("a11_review_coverage", f"WITH {EV}, s AS (SELECT slug, kind, sum(value) AS seconds FROM ev GROUP BY ALL), d AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) SELECT slug, count(*)::BIGINT AS voices, count_if(d.doc_id IS NOT NULL)::BIGINT AS decided, round(1000 * coalesce(sum(seconds) FILTER (d.doc_id IS NOT NULL), 0) / sum(seconds))::BIGINT AS per_mille FROM s LEFT JOIN d ON d.doc_id = slug * 5 + ascii(kind) % 5 GROUP BY slug")
def a11_review_coverage(spark, sf_dir):
    """A voice is decided if its label row approves it."""
    s = events(spark, sf_dir).groupBy("slug", "kind").agg(F.sum("value").alias("seconds")).withColumn("doc_id", F.col("slug") * 5 + F.ascii("kind") % 5)
    d = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id", F.lit(True).alias("ok")).distinct()
    j = s.join(d, "doc_id", "left")
    return j.groupBy("slug").agg(F.count("*").alias("voices"), F.count_if(F.col("ok").isNotNull()).alias("decided"), F.round(1000 * F.sum(F.when(F.col("ok"), F.col("seconds")).otherwise(0.0)) / F.sum("seconds")).cast("long").alias("per_mille"))


@query("a15_digest", rf"""WITH {SEG}, t AS (SELECT slug, seg, text, row_number() OVER (PARTITION BY slug ORDER BY seg) - 1 AS i, count(*) OVER (PARTITION BY slug) AS n FROM seg WHERE len(regexp_extract_all(text, '\S+')) >= 30),
j AS (SELECT DISTINCT slug, floor(k * n / 4)::BIGINT AS i FROM t, range(4) r(k)) SELECT slug, seg, text FROM t WHERE n <= 4 OR (slug, i) IN (SELECT slug, i FROM j)""")
def a15_digest(spark, sf_dir):
    long = segments(spark, sf_dir).where(count_words(F.col("text")) >= 30)
    return reports.even_sample(long, "slug", ["seg"], 4).select("slug", "seg", "text")


@query("a16_non_latin", "SELECT doc_id, 'где' AS hit, right(text, 29) || ' где ' || left(coalesce(lang, ''), 29) AS context FROM documents")
def a16_non_latin(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "text", F.lit("где"), "lang").alias("text"))
    return reports.occurrences(d, "doc_id", clean.NON_LATIN)


@query("a17_metrics", """WITH f AS (SELECT event_type, date_trunc('day', ts)::DATE AS day, (event_id % 5) AS clicks, 5 + event_id % 50 AS impressions, value AS position FROM events)
SELECT event_type, day, sum(clicks)::BIGINT AS clicks, sum(impressions)::BIGINT AS impressions, round(10000 * sum(clicks) / sum(impressions))::BIGINT AS ctr_bp, round(100 * sum(position * impressions) / sum(impressions))::BIGINT AS position_x100 FROM f GROUP BY ALL""")
def a17_metrics(spark, sf_dir):
    return reports.metric_rollup(_facts(spark, sf_dir), ["event_type", "day"])


def _facts(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_type", "user_id", F.to_date("ts").alias("day"), (F.col("event_id") % 5).alias("clicks"), (5 + F.col("event_id") % 50).alias("impressions"), F.col("value").alias("position"))


@query("a17_change", "WITH f AS (SELECT user_id, ts < TIMESTAMP '2024-01-16' AS early, event_id % 5 AS clicks FROM events) SELECT user_id, coalesce(sum(clicks) FILTER (early), 0)::BIGINT AS before, coalesce(sum(clicks) FILTER (NOT early), 0)::BIGINT AS after, (coalesce(sum(clicks) FILTER (NOT early), 0) - coalesce(sum(clicks) FILTER (early), 0))::BIGINT AS change FROM f GROUP BY user_id")
def a17_change(spark, sf_dir):
    f = _facts(spark, sf_dir)
    half = lambda c: f.where(c).groupBy("user_id").agg(F.sum("clicks").alias("clicks"))
    return reports.change_between(half("day < date'2024-01-16'"), half("day >= date'2024-01-16'"), ["user_id"], "clicks")


@query("a18_publication_state", "SELECT doc_id, CASE WHEN l.doc_id IS NULL THEN 'to do' WHEN l.toxic = 1 THEN 'failed' WHEN l.quality = 1 THEN 'current' ELSE 'changed' END AS state FROM documents d LEFT JOIN labels l USING (doc_id)")
def a18_publication_state(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    seen = docs.join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.when(F.col("quality") == 1, F.col("hash")).otherwise("").alias("hash"), (F.col("toxic") == 1).alias("failed"))
    return reports.publication_state(docs, seen, "doc_id", "hash")


#: An address; in the SQL, where patterns do not look ahead, junk hosts lose their @ first.
ADDRESS = r"[a-z0-9][a-z0-9._%+-]*@[a-z0-9-]+(?:[.][a-z0-9-]+)*[.][a-z]{2,}"


@query("a19_contact_counts", rf"""WITH p AS (SELECT page_id, lower(html || ' <a href="mailto:x@big.org">x@big.org</a> b@a.example.com lee at big dot org') AS t FROM pages),
h AS (SELECT page_id, t, regexp_replace(t, '@((?:[a-z0-9-]+[.])*(?:example|sentry|wixpress)[.])', chr(1) || '\1', 'g') AS h FROM p),
n AS (SELECT page_id, len(regexp_extract_all(h, 'mailto:{ADDRESS}')) AS mailto, len(regexp_extract_all(h, '{ADDRESS}')) AS shown, len(regexp_extract_all(t, '[a-z0-9._-]+ at [a-z0-9-]+ dot [a-z]{{2,}}\b|data-cfemail=')) AS obfuscated FROM h)
SELECT page_id, mailto::BIGINT AS mailto, (shown - mailto)::BIGINT AS plain, obfuscated::BIGINT AS obfuscated FROM n""")
def a19_contact_counts(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit(' <a href="mailto:x@big.org">x@big.org</a> b@a.example.com lee at big dot org')).alias("html"))
    return reports.contact_counts(p, "page_id", "html")


@query("a21_latest_per_type", "SELECT o_orderpriority AS type, o_orderkey, rank::INT AS rank, n::BIGINT AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate DESC, o_orderkey DESC) AS rank, count(*) OVER (PARTITION BY o_orderpriority) AS n FROM orders) WHERE rank <= 3")
def a21_latest_per_type(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "type")
    n = o.groupBy("type").agg(F.count("*").alias("n"))
    return reports.top_per(o, ["type"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 3).join(n.hint("merge"), "type").select("type", "o_orderkey", "rank", "n")


@query("a22_shared_pictures", r"WITH u AS (SELECT page_id, regexp_extract(url, '://([^/]*)', 1) AS picture FROM pages), n AS (SELECT *, count(*) OVER (PARTITION BY picture) AS used FROM u) SELECT page_id, picture, used::BIGINT AS used, used >= 2 AS generic, CASE WHEN used < 2 THEN 'own' WHEN l.doc_id IS NOT NULL THEN 'labelled' ELSE 'none' END AS tier FROM n LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = page_id")
def a22_shared_pictures(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "://([^/]*)", 1).alias("picture"))
    used = u.groupBy("picture").agg(F.count("*").alias("used"))
    lab = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.lit(True).alias("l")).distinct()
    j = u.join(used, "picture").join(lab, "page_id", "left")
    return j.select("page_id", "picture", "used", (F.col("used") >= 2).alias("generic"), F.when(F.col("used") < 2, "own").when(F.col("l"), "labelled").otherwise("none").alias("tier"))


@query("a23_name_index", "WITH w AS (SELECT string_split(p_name, ' ') AS w FROM part) SELECT w[1] AS first, w[-1] AS last, count(*)::BIGINT AS n FROM w WHERE len(w) BETWEEN 2 AND 3 GROUP BY ALL")
def a23_name_index(spark, sf_dir):
    w = table(spark, sf_dir, "part").select(F.split("p_name", " ").alias("w")).where(F.size("w").between(2, 3))
    return w.groupBy(F.element_at("w", 1).alias("first"), F.element_at("w", -1).alias("last")).agg(F.count("*").alias("n"))


@query("a14_prominence", """WITH m AS (SELECT user_id AS k, sum(5 + event_id % 50) AS imp, sum(value * (5 + event_id % 50)) / sum(5 + event_id % 50) AS pos FROM events GROUP BY user_id),
s AS (SELECT s_suppkey, s_name, CASE WHEN imp >= 10 AND pos <= 40 THEN 100 WHEN imp >= 10 AND pos <= 60 THEN 60 WHEN s_acctbal > 5000 THEN 40 ELSE 10 END AS score FROM supplier LEFT JOIN m ON s_suppkey = k) SELECT s_suppkey, s_name, score, row_number() OVER (ORDER BY score DESC, s_suppkey)::INT AS place FROM s""")
def a14_prominence(spark, sf_dir):
    m = _facts(spark, sf_dir).groupBy(F.col("user_id").alias("k")).agg(F.sum("impressions").alias("imp"), (F.sum(F.col("position") * F.col("impressions")) / F.sum("impressions")).alias("pos"))
    s = table(spark, sf_dir, "supplier").join(m, F.col("s_suppkey") == F.col("k"), "left")
    score = F.when((F.col("imp") >= 10) & (F.col("pos") <= 40), 100).when((F.col("imp") >= 10) & (F.col("pos") <= 60), 60).when(F.col("s_acctbal") > 5000, 40).otherwise(10)
    from .ranking import global_rank

    return global_rank(s.select("s_suppkey", "s_name", score.alias("score")), [F.desc("score"), F.col("s_suppkey")], "place")
