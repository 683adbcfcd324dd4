"""Queries of readers and writers: texts in each format are made from the tables, then read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.sources import captions, sinks, sites

from .fixtures import EV, SEG, events, segments
from .registry import query, table


def _flat(spark, sf_dir):
    return segments(spark, sf_dir).withColumn("text", F.trim(F.regexp_replace("text", r"\s+", " "))).where("text <> ''")


FLAT = SEG + r", fl AS (SELECT slug, seg, speaker, start, 'x' AS e, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM seg WHERE trim(regexp_replace(text, '\s+', ' ', 'g')) <> '')"


@query("s1_vtt", f"WITH {FLAT} SELECT slug, round(start * 1000)::BIGINT AS start_ms, round((start + 30) * 1000)::BIGINT AS end_ms, text FROM fl")
def s1_vtt(spark, sf_dir):
    texts = sinks.caption_files(_flat(spark, sf_dir))
    return captions.parse_vtt(texts).select("slug", F.round(F.col("start") * 1000).cast("long").alias("start_ms"), F.round(F.col("end") * 1000).cast("long").alias("end_ms"), "text")


@query("s2_labelled_cues", f"WITH {FLAT} SELECT slug, speaker, (start * 100)::BIGINT AS start_cs, regexp_replace(text, '\\s+([,.!?])', '\\1', 'g') AS text FROM fl")
def s2_labelled_cues(spark, sf_dir):
    labelled = _flat(spark, sf_dir).withColumn("text", F.concat(F.coalesce(F.concat("speaker", F.lit(": ")), F.lit("")), F.lit("Um, "), "text"))
    found = captions.labelled_cues(captions.parse_vtt(sinks.caption_files(labelled)))
    return found.select("slug", "speaker", F.round(F.col("start") * 100).cast("long").alias("start_cs"), "text")


@query("s3_caption_words")
def s3_caption_words(spark, sf_dir):
    """Rolling captions: each cue repeats the last words of the one before, then tags its own."""
    return captions.caption_words(_rolling(spark, sf_dir)).select("slug", "idx", F.round(F.col("start") * 100).cast("long").alias("start_cs"), "word")


def _rolling(spark, sf_dir):
    from pyspark.sql import Window

    s = _flat(spark, sf_dir).withColumn("w", F.split("text", " "))
    before = F.lag("w").over(Window.partitionBy("slug").orderBy("seg"))
    stamp = F.concat(F.lit("<"), sinks.stamp(F.col("start")), F.lit("><c> "))
    tagged = F.array_join(F.transform("w", lambda x: F.concat(stamp, x, F.lit("</c>"))), "")
    shown = F.concat(F.coalesce(F.array_join(F.slice(before, -F.least(F.size(before), F.lit(3)), 3), " "), F.lit("")), tagged)
    return sinks.caption_files(s.withColumn("text", shown))


@query("s4_caption_kind", f"WITH {FLAT} SELECT slug, true AS auto FROM fl GROUP BY slug UNION ALL SELECT slug + 1000000, false FROM fl GROUP BY slug")
def s4_caption_kind(spark, sf_dir):
    plain = sinks.caption_files(_flat(spark, sf_dir)).withColumn("slug", F.col("slug") + 1000000)
    return captions.caption_kind(_rolling(spark, sf_dir).union(plain))


@query("s5_asr_words", f"""WITH {EV}, n AS (SELECT *, CASE WHEN idx % 3 > 0 OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS nw FROM ev WINDOW w AS (PARTITION BY slug ORDER BY idx)), r AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY idx) - 1 AS word FROM n)
SELECT slug, word::BIGINT AS word, round(min(t) * 100)::BIGINT AS start_cs, string_agg(kind, '' ORDER BY idx) AS text FROM r GROUP BY slug, word""")
def s5_asr_words(spark, sf_dir):
    tokens = events(spark, sf_dir).select("slug", "idx", F.col("t").alias("start"), F.concat(F.when(F.col("idx") % 3 > 0, " ").otherwise(""), "kind").alias("token"))
    return captions.asr_words(tokens).select("slug", "word", F.round(F.col("start") * 100).cast("long").alias("start_cs"), "text")


@query("s8_html_text", r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', '', 'g') AS h FROM pages), b AS (SELECT page_id, regexp_replace(regexp_replace(h, '(?i)\[/?[a-z][a-z0-9_-]*[^\]]*\]|<br\s*/?>|</(?:p|div|li|h[1-6]|tr|ul|ol|article|nav|footer)>', chr(10), 'g'), '<[^>]+>', '', 'g') AS h FROM a)
SELECT page_id, trim(regexp_replace(regexp_replace(h, '[ \t]+', ' ', 'g'), '\s*\n\s*', chr(10), 'g'), ' ' || chr(10)) AS text FROM b""")
def s8_html_text(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sites.strip_tags(F.col("html")).alias("text"))


@query("s8_html_entities")
def s8_html_entities(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sites.html_to_text(F.col("html")).alias("text"))


@query("s9_index", "SELECT p_partkey, CASE i WHEN 0 THEN 'Peru' ELSE 'Chad' END AS section, CASE i WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bob Ray' ELSE upper(left(p_name, 1)) || substr(p_name, 2) END AS name, CASE i WHEN 0 THEN 'Lima' WHEN 2 THEN p_type END AS location FROM part, range(3) r(i)")
def s9_index(spark, sf_dir):
    name = F.concat(F.upper(F.left("p_name", F.lit(1))), F.substring("p_name", 2, 100))
    page = F.concat(F.lit("<p>Top</p><h3>Peru</h3><p><b>Ann Lee</b>, Lima<br>www:</p><h3 class='x'>Chad</h3>Bob Ray<br/>"), name, F.lit(", "), "p_type")
    return sites.parse_index(table(spark, sf_dir, "part").select("p_partkey", page.alias("html")), "p_partkey")


@query("s10_listing", "WITH t AS (SELECT conv_id, turn, role, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS e FROM conversations) SELECT conv_id, 'entry ' || e AS entry, 'u' || turn AS url FROM t WHERE role <> 'user' AND e IS NOT NULL")
def s10_listing(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    tokens = c.select("conv_id", F.col("turn").alias("idx"), F.when(F.col("role") == "user", "entry").otherwise("link").alias("kind"), F.when(F.col("role") == "user", F.concat(F.lit("entry "), F.col("turn").cast("string"))).otherwise(F.concat(F.lit("u"), F.col("turn").cast("string"))).alias("value"))
    return sites.parse_listing(tokens, "conv_id")


@query("s11_reel", "SELECT p_partkey, 'Ann Lee' AS name, (p_partkey % 50 * 60 + 5)::INT AS seconds FROM part UNION ALL SELECT p_partkey, 'Bob', 3605 FROM part")
def s11_reel(spark, sf_dir):
    text = F.concat(F.lit("Reel\n"), F.format_string("%d:05", (F.col("p_partkey") % 50).cast("int")), F.lit(" Ann Lee\n1:00:05 – Bob\n1:02 x\n0:10 Al"))
    return sites.parse_reel(table(spark, sf_dir, "part").select("p_partkey", text.alias("text")), "p_partkey")


@query("s12_markdown", rf"""WITH {FLAT}, b AS (SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY seg) - 1 AS seg, speaker, start, text FROM fl) SELECT slug, seg::INT AS seg, speaker, start::INT AS start, i::INT AS para, CASE i WHEN 0 THEN text ELSE 'More.' END AS text FROM b, range(2) r(i)""")
def s12_markdown(spark, sf_dir):
    s = _flat(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n\nMore.")))
    return captions.parse_markdown(sinks.corpus_documents(s))


@query("s13_edited", f"WITH {FLAT}, b AS (SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY seg) - 1 AS turn, speaker, start, text FROM fl) SELECT slug, turn::INT AS turn, speaker, start::INT AS start, text FROM b")
def s13_edited(spark, sf_dir):
    s = _flat(spark, sf_dir)
    head = F.concat(F.lit("["), F.left(sinks.stamp(F.col("start")), F.lit(8)), F.lit("] "), F.coalesce("speaker", F.lit("")), F.lit("\n"), "text")
    return captions.parse_edited(sinks.ordered_text(s, ["slug"], ["seg"], head, "\n\n"))


@query("s16_reviewed", "SELECT doc_id AS slug, 'reviewed' AS status, trim(text, ' ' || chr(10)) AS text FROM documents WHERE doc_id % 3 = 0")
def s16_reviewed(spark, sf_dir):
    status = F.when(F.col("doc_id") % 3 == 0, "Status: reviewed\n").when(F.col("doc_id") % 3 == 1, "status: draft\n").otherwise("")
    return sites.reviewed_texts(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("slug"), F.concat(status, "text").alias("text")))


@query("s17_index_links", "WITH l AS (SELECT conv_id, turn, max(CASE WHEN turn % 4 = 0 THEN turn END) OVER w AS s, max(CASE WHEN turn % 4 = 1 THEN turn END) OVER w AS p FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id, turn AS idx, 'S' || s AS section, CASE WHEN p > s THEN 'P' || p END AS person, 'u' || turn AS url FROM l WHERE turn % 4 > 0")
def s17_index_links(spark, sf_dir):
    n, k = F.col("turn").cast("string"), F.col("turn") % 4
    link = F.concat(F.lit('<a href="u'), n, F.lit('">x</a>'))
    html = F.when(k == 0, F.concat(F.lit("<h3>S"), n, F.lit("</h3>"))).when(k == 1, F.concat(F.lit("<b>P"), n, F.lit("</b> "), link)).otherwise(link)
    return sites.index_links(table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").alias("idx"), html.alias("html")), "conv_id")


@query("s17_page_links", r"""SELECT page_id, count(*)::BIGINT AS links, count(DISTINCT u)::BIGINT AS urls FROM (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href=["'']([^"'']*)["''][^>]*>.*?</a>', 1)) AS u FROM pages) GROUP BY page_id""")
def s17_page_links(spark, sf_dir):
    return sites.page_links(table(spark, sf_dir, "pages"), "page_id").groupBy("page_id").agg(F.count("*").alias("links"), F.count_distinct("url").alias("urls"))


@query("s18_profiles", "SELECT p_partkey, p_name AS name, p_type AS location, 'Work ' || p_size || '; Other' AS works FROM part")
def s18_profiles(spark, sf_dir):
    page = F.concat(F.lit("<h2>"), "p_name", F.lit(" – "), "p_type", F.lit("</h2><figcaption><i>Work "), F.col("p_size").cast("string"), F.lit("</i>, $1,200</figcaption><figcaption>Other NFS</figcaption>"))
    return sites.parse_profiles(table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(" at The Hall")).alias("title"), page.alias("html")), "p_partkey", "title", "html")


@query("s19_synopsis_points", "SELECT doc_id, (doc_id % 50 * 60 + 5)::INT AS seconds, 'the start' AS label, length(text) + 14 AS n FROM documents UNION ALL SELECT doc_id, 3605, 'end', length(text) + 14 FROM documents")
def s19_synopsis_points(spark, sf_dir):
    text = F.concat("text", F.lit(" [["), F.format_string("%d:05", (F.col("doc_id") % 50).cast("int")), F.lit("|the start]] [[1:00:05|end]]"))
    d = table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))
    plain = d.select("doc_id", F.length(sites.synopsis_plain(F.col("text"))).cast("long").alias("n"))
    return sites.synopsis_points(d, "doc_id").hint("merge").join(plain.hint("merge"), "doc_id")


@query("k1_corpus_documents", rf"""WITH {FLAT}, b AS (SELECT slug, string_agg('## ' || coalesce(speaker, 'Unattributed') || ' [' || printf('%02d:%02d', start::INT // 60, start::INT % 60) || '](https://v.example/?v=' || slug || '&t=' || start::INT || 's)' || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY seg) AS t, count(*) AS n, sum(len(regexp_extract_all(text, '\S+'))) AS w FROM fl GROUP BY slug)
SELECT slug, '---' || chr(10) || 'id: "' || slug || '"' || chr(10) || 'segments: ' || n || chr(10) || 'words: ' || w || chr(10) || '---' || chr(10) || chr(10) || t AS text FROM b""")
def k1_corpus_documents(spark, sf_dir):
    return sinks.corpus_documents(_flat(spark, sf_dir))


@query("k2_merge_rebuilt", "SELECT doc_id, CASE WHEN lang IN ('fr', 'de') THEN 'new ' || lang ELSE lang END AS lang FROM documents")
def k2_merge_rebuilt(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return sinks.merge_rebuilt(d, d.where("lang in ('fr', 'de')").withColumn("lang", F.concat(F.lit("new "), "lang")), "doc_id")


@query("k3_caption_index", f"WITH {FLAT} SELECT slug, count(*)::BIGINT AS cues, max(start + 30)::BIGINT AS last_end, 30000::BIGINT AS longest_ms, max(length(text))::BIGINT AS widest FROM fl GROUP BY slug")
def k3_caption_index(spark, sf_dir):
    return sinks.caption_index(_flat(spark, sf_dir))


@query("k3_srt", rf"""WITH {FLAT}, c AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY seg) AS n, start::INT AS a, start::INT + 30 AS b FROM fl) SELECT slug, string_agg(n || chr(10) || printf('%02d:%02d:%02d,000 --> %02d:%02d:%02d,000', a // 3600, a // 60 % 60, a % 60, b // 3600, b // 60 % 60, b % 60) || chr(10) || text, chr(10) || chr(10) ORDER BY seg) || chr(10) AS text FROM c GROUP BY slug""")
def k3_srt(spark, sf_dir):
    return sinks.caption_files(_flat(spark, sf_dir), vtt=False)


@query("k4_recordings_export", "SELECT o_orderkey, o_orderpriority, coalesce(c_name, '') AS page FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_custkey % 2 = 0")
def k4_recordings_export(spark, sf_dir):
    c = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("page"))
    o = table(spark, sf_dir, "orders").join(c, "o_custkey", "left").select("o_orderkey", "o_orderpriority", "page")
    return sinks.ordered_export(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], "o_orderkey")


@query("k6_type_listing", "WITH n AS (SELECT role, conv_id, count(*) AS n FROM conversations GROUP BY ALL) SELECT role, string_agg(conv_id || ' (' || n || ')', ', ' ORDER BY conv_id) AS listing FROM n GROUP BY role")
def k6_type_listing(spark, sf_dir):
    n = table(spark, sf_dir, "conversations").groupBy("role", "conv_id").agg(F.count("*").alias("n"))
    item = F.concat(F.col("conv_id").cast("string"), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    return sinks.ordered_text(n, ["role"], ["conv_id"], item, ", ").withColumnRenamed("text", "listing")


@query("k8_transcript", f"WITH {SEG}, r AS (SELECT slug, seg, 0 AS para, printf('[%d:%02d:%02d] ', start::INT // 3600, start::INT // 60 % 60, start::INT % 60) || coalesce(speaker, 'Unattributed') AS line FROM seg UNION ALL SELECT slug, seg, unnest(range(1, len(string_split(text, chr(10))) + 1)), unnest(string_split(text, chr(10))) FROM seg) SELECT slug, row_number() OVER (PARTITION BY slug ORDER BY seg, para)::INT AS ord, line FROM r")
def k8_transcript(spark, sf_dir):
    return sinks.transcript_lines(segments(spark, sf_dir))


@query("k9_failures", "SELECT doc_id, 'language' AS stage, 'failed language' AS error FROM documents WHERE lang <> 'en' UNION ALL SELECT doc_id, 'length', 'failed length' FROM documents WHERE n_chars < 500")
def k9_failures(spark, sf_dir):
    return sinks.split_failures(table(spark, sf_dir, "documents"), {"language": F.col("lang") == "en", "length": F.col("n_chars") >= 500}, "doc_id")[1]
