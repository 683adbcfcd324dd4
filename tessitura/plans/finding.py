"""Queries of links and of search."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions.tables import shared_dir
from tessitura.operators import links, names, search, sentences, text_index

from .fixtures import SENT, paragraphs
from .registry import query, table

HOST = r"lower(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1), '^www\.', ''))"


@query("l1_hosts", f"WITH h AS (SELECT page_id, {HOST} AS h FROM pages), p AS (SELECT *, string_split(h, '.') AS p FROM h) SELECT page_id, h AS host, p[-2] || '.' || p[-1] AS site, 'website' AS kind FROM p")
def l1_hosts(spark, sf_dir):
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", links.host(u).alias("host"), links.registrable(links.host(u)).alias("site"), links.kind_of(u).alias("kind"))


# A page that offers its domain is parked if it has few words, those of the page included; an address that ends in /404 is
# a missing page's, whatever the page says; an address without a path has no front page to fall back to.
@query("l2_page_verdicts", rf"""WITH n AS (SELECT page_id, len(regexp_extract_all(regexp_replace(regexp_replace(regexp_replace(html || '<p>The domain a.org is for sale</p>', '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '[^\s\x0B\x85\p{{Z}}]+')) AS n, trim(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/') AS path FROM pages),
g AS (SELECT *, regexp_matches(lower(path), '(?:^|/)(?:missing|not-?found|404)$') AS gone FROM n)
SELECT page_id, CASE WHEN gone AND page_id % 11 IN (0, 3, 9) THEN 'broken' ELSE CASE page_id % 11 WHEN 1 THEN 'parked' WHEN 2 THEN 'broken' WHEN 3 THEN CASE WHEN n < {links.SHORT_OFFER} THEN 'parked' ELSE 'ok' END WHEN 4 THEN 'changed' WHEN 5 THEN CASE WHEN path = '' THEN 'ok' ELSE 'changed' END WHEN 6 THEN 'broken' WHEN 8 THEN 'parked' WHEN 9 THEN 'parked' ELSE 'ok' END END AS verdict FROM g""")
def l2_page_verdicts(spark, sf_dir):
    """Pages as they were fetched: one in eleven as it is, others sent on, offered, missing, renamed or empty."""
    site = F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1)
    titled = lambda t: F.concat(F.lit(f"<title>{t}</title>"), F.col("html"))
    body = {2: titled("Error 404 - nothing"), 3: F.concat("html", F.lit("<p>The domain a.org is for sale</p>")), 8: F.lit("<script>location.href = '/lander'</script>"), 9: F.lit("<title>Coming soon</title>")}
    final = {1: F.lit("https://www.hugedomains.com/x"), 4: F.lit("https://elsewhere.org/a"), 5: F.concat(site, F.lit("/")), 6: F.concat(site, F.lit("/not-found/")), 7: F.lit("https://elsewhere.org/a"), 10: F.lit("https://www.x.com/a")}
    k = F.col("page_id") % 11
    pick = lambda of, rest: F.coalesce(*[F.when(k == i, c) for i, c in of.items()], rest)
    asked = pick({7: F.lit("https://bit.ly/a"), 10: F.lit("https://twitter.com/a")}, F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", links.page_verdict(pick(body, F.col("html")), pick(final, asked), asked).alias("verdict"))


@query("l3_status", "SELECT event_id, CASE WHEN code BETWEEN 200 AND 399 THEN 'ok' WHEN code IN (0, 404, 410) THEN 'broken' ELSE 'unverified' END AS status FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 403 WHEN 3 THEN 0 ELSE 301 END AS code FROM events)")
def l3_status(spark, sf_dir):
    code = F.element_at(F.array(*[F.lit(x) for x in (200, 404, 403, 0, 301)]), (F.col("event_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", links.http_status(code).alias("status"))


def _status(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderkey % 3 > 0").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "broken").otherwise("ok").alias("status"), F.to_date("o_orderdate").alias("checked"), F.when(F.col("o_orderkey") % 10 == 0, 0).otherwise(1).alias("v"))


@query("l4_due", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 10 = 0 OR DATE '1999-01-01' - o_orderdate::DATE > 365")
def l4_due(spark, sf_dir):
    return links.due_for_check(table(spark, sf_dir, "orders").select("o_orderkey"), _status(spark, sf_dir), "o_orderkey", "1999-01-01", 365)


@query("l4_broken", "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0 AND o_orderstatus = 'F'")
def l4_broken(spark, sf_dir):
    return links.due_for_check(table(spark, sf_dir, "orders").select("o_orderkey"), _status(spark, sf_dir), "o_orderkey", "1999-01-01", only_broken=True)


def _links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select((F.col("page_id") % 40).alias("person"), F.regexp_extract("url", "/(..)/", 1).alias("kind"), "url", F.col("page_id").alias("idx"), (F.col("page_id") % 3 > 0).alias("works"), (F.col("page_id") % 11 == 0).alias("override"))


@query("l5_best_links", r"""WITH l AS (SELECT page_id % 40 AS person, regexp_extract(url, '/(..)/', 1) AS kind, page_id, regexp_replace(regexp_replace(regexp_replace(url, '^http://', 'https://'), '#.*$', ''), '/+$', '') AS url FROM pages)
SELECT person, kind, arg_min(url, ((page_id % 11 <> 0)::INT, (page_id % 3 = 0)::INT, page_id)) AS url, count(DISTINCT url)::BIGINT AS known FROM l GROUP BY ALL""")
def l5_best_links(spark, sf_dir):
    return links.best_links(_links(spark, sf_dir), "person")


@query("l6_candidate_sites", "WITH t AS (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part), h AS (SELECT p_partkey, unnest(list_distinct([w[1] || w[2] || '.com', w[1] || w[2] || '.net', w[1] || w[2] || '.art', w[1] || '-' || w[2] || '.com', w[1] || '-' || w[2] || '.net', w[1] || '-' || w[2] || '.art', w[2] || w[1] || '.com', w[2] || w[1] || '.net', w[2] || w[1] || '.art', w[1] || w[2] || 'art.com', w[1] || w[2] || 'studio.com'])) AS host FROM t) SELECT p_partkey, host, 'https://a.example/' || p_partkey AS target FROM h")
def l6_candidate_sites(spark, sf_dir):
    detail = F.concat(F.lit("301, redirects to https://a.example/"), F.col("p_partkey").cast("string"), F.lit("."))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(links.candidate_sites(F.initcap("p_name"))).alias("host"), links.redirect_target(detail).alias("target"))


@query("l7_cache", "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 2 WHEN o_orderkey % 3 = 1 THEN 1 ELSE 2 END::INT AS rev, CASE o_orderkey % 3 WHEN 0 THEN 'added' WHEN 1 THEN 'kept' ELSE 'updated' END AS action FROM orders WHERE o_orderstatus <> 'P'")
def l7_cache(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("k", F.col("o_orderkey"))
    cache = o.where("k % 3 > 0").select("k", F.lit(1).alias("rev"), F.lit("old").alias("body"))
    fetched = o.select("k", F.when(F.col("k") % 3 == 1, 1).otherwise(2).alias("rev"), F.lit("new").alias("body"))
    return links.refresh_cache(cache, fetched, o.where("o_orderstatus = 'P'"), "k").select("k", "rev", "action")


@query("l8_directory_pages", "WITH p AS (SELECT p_name, max(CASE WHEN p_partkey % 50 = 0 THEN p_partkey END) AS page FROM part WHERE p_partkey % 2 = 0 GROUP BY p_name) SELECT p_partkey, CASE WHEN p.p_name IS NULL THEN 'unmatched' WHEN page IS NULL THEN 'no page' ELSE 'matched' END AS status FROM part LEFT JOIN p ON part.p_name = p.p_name")
def l8_directory_pages(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    pages = part.where("p_partkey % 2 = 0").select(F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 50 == 0, F.col("p_partkey")).alias("page"))
    lines = part.select("p_partkey", F.initcap("p_name").alias("line"))
    return links.match_directory(lines, pages, names.person_key(F.col("line")), names.person_key(F.col("name"))).select("p_partkey", "status")


@query("a13_link_report", r"""WITH l AS (SELECT page_id % 40 AS person, regexp_extract(url, '/(..)/', 1) AS kind, coalesce(min(CASE WHEN page_id % 3 = 0 THEN 'broken' ELSE 'ok' END) FILTER (page_id % 3 < 2) OVER (PARTITION BY url), 'unverified') AS st, url FROM pages)
SELECT person, coalesce(string_agg(st || ' ' || url, '; ' ORDER BY st || ' ' || url) FILTER (kind = 'en'), '') AS en, coalesce(string_agg(st || ' ' || url, '; ' ORDER BY st || ' ' || url) FILTER (kind = 'fr'), '') AS fr, count(*) FILTER (st = 'ok') = 0 AS none_works FROM l GROUP BY person""")
def a13_link_report(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    status = p.where("page_id % 3 < 2").groupBy("url").agg(F.min(F.when(F.col("page_id") % 3 == 0, "broken").otherwise("ok")).alias("status"))
    return links.link_report(_links(spark, sf_dir).select("person", "kind", "url"), status, "person", ["en", "fr"])


TERM = r"post AS (SELECT doc_id, unnest(ws) AS term, unnest(range(len(ws))) AS pos FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_'']+') AS ws FROM documents))"


def _index(spark, sf_dir):
    return text_index.stored_index(spark, shared_dir(spark), table(spark, sf_dir, "documents"), "doc_id")


@query("q1_find_all", f"WITH {TERM}, b AS (SELECT doc_id, term, lead(term) OVER (PARTITION BY doc_id ORDER BY pos) AS nxt FROM post), c AS (SELECT doc_id, count(*) FILTER (term = 'of' AND nxt = 'the') AS a, count(*) FILTER (term = 'and') AS x, count(*) FILTER (term = 'this') AS y FROM b GROUP BY doc_id) SELECT doc_id, (a + y)::BIGINT AS hits FROM c WHERE a > 0 AND y > 0")
def q1_find_all(spark, sf_dir):
    return _index(spark, sf_dir).find_all('this and "of the"')


@query("q2_sentences", rf"WITH {SENT} SELECT slug, seg, para::INT AS para, sent::INT AS sent, sentence FROM sent WHERE regexp_matches(sentence, '(?i)(^|[^\p{{L}}\p{{M}}\p{{N}}_''])the($|[^\p{{L}}\p{{M}}\p{{N}}_''])') AND regexp_matches(sentence, '(?i)(^|[^\p{{L}}\p{{M}}\p{{N}}_''])of($|[^\p{{L}}\p{{M}}\p{{N}}_''])')")
def q2_sentences(spark, sf_dir):
    return search.sentences_with(sentences.sentences(paragraphs(spark, sf_dir), ["slug", "seg", "para"]), ["the", "of"])


@query("q3_context", rf"WITH {SENT}, c AS (SELECT slug, speaker, seg, para, sent, sentence, lag(sentence) OVER w AS before, lead(sentence) OVER w AS after FROM sent WINDOW w AS (PARTITION BY slug, speaker ORDER BY seg, para, sent)) SELECT slug, seg, para::INT AS para, sent::INT AS sent, before, sentence, after FROM c WHERE contains(sentence, 'tion')")
def q3_context(spark, sf_dir):
    s = sentences.sentences(paragraphs(spark, sf_dir), ["slug", "speaker", "seg", "para"])
    return search.with_context(s, ["slug", "speaker"], ["seg", "para", "sent"], F.col("sentence").contains("tion")).select("slug", "seg", "para", "sent", "before", "sentence", "after")


@query("q4_facets", "SELECT 'lang' AS facet, lang AS value, count(*)::BIGINT AS n FROM documents WHERE n_chars > 500 GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents WHERE n_chars > 500 GROUP BY source")
def q4_facets(spark, sf_dir):
    return search.facets(table(spark, sf_dir, "documents").where("n_chars > 500"), ["lang", "source"])


@query("q5_identified_only", "SELECT conv_id, turn FROM conversations WHERE role <> 'system'")
def q5_identified_only(spark, sf_dir):
    return table(spark, sf_dir, "conversations").where("role <> 'system'").select("conv_id", "turn")


@query("q6_newest", "SELECT o_orderkey, o_orderdate::DATE AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 50")
def q6_newest(spark, sf_dir):
    """A page of results, newest first: the limit is the feature."""
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50).select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query(
    "q6_relevance",
    f"""WITH {TERM}, d AS (SELECT doc_id, count(*) AS len, count(*) FILTER (term = 'thing') AS a, count(*) FILTER (term = 'eau') AS b FROM post GROUP BY doc_id), w AS (SELECT count(*) AS n, avg(len) AS m, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM d)
SELECT doc_id, round(10000 * (ln(1 + (n - da + 0.5) / (da + 0.5)) * a * 2.2 / (a + 1.2 * (0.25 + 0.75 * len / m)) + ln(1 + (n - db + 0.5) / (db + 0.5)) * b * 2.2 / (b + 1.2 * (0.25 + 0.75 * len / m))))::BIGINT AS score FROM d, w WHERE a > 0 OR b > 0""",
)
def q6_relevance(spark, sf_dir):
    return _index(spark, sf_dir).bm25("thing eau").select("doc_id", F.round(F.col("score") * 10000).cast("long").alias("score"))


@query("q7_snippets", "SELECT doc_id, 'word Ann Lee said more and' AS snippet FROM documents WHERE length(text) > 40")
def q7_snippets(spark, sf_dir):
    d = table(spark, sf_dir, "documents").where("length(text) > 40")
    text = F.concat("text", F.lit(" longerword word Ann Lee said more and furtherwordsfurther words after that"))
    return d.select("doc_id", search.snippet(text, "ann lee", 16).alias("snippet"))
