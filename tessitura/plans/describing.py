"""Queries of metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions.strings import clock
from tessitura.operators import metadata as m

from .fixtures import SEG, segments
from .registry import query, table


@query("m1_dates", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN DATE '2021-03-05' WHEN doc_id % 3 = 1 THEN DATE '2022-11-30' END AS found FROM documents")
def m1_dates(spark, sf_dir):
    k = F.col("doc_id") % 3
    added = F.when(k == 0, " Published on January 2, 2020 as ever. Held March 5th, 2021 and 1/2/22").when(k == 1, " on 13/45/2020 then 11/30/22").otherwise(" on February 31, 2020")
    return table(spark, sf_dir, "documents").select("doc_id", m.find_date(F.concat("text", added), ["published on"]).alias("found"))


@query("m2_titles", "SELECT p_partkey, (p_partkey % 900 + 1)::INT AS number, CASE WHEN p_partkey % 3 = 2 THEN 'Talk' ELSE p_name END AS topic FROM part")
def m2_titles(spark, sf_dir):
    n = (F.col("p_partkey") % 900 + 1).cast("string")
    k = F.col("p_partkey") % 3
    title = F.when(k == 0, F.concat(F.lit("Talk #"), n, F.lit(" | "), "p_name", F.lit(" | March 5, 2021"))).when(k == 1, F.concat(F.lit("Talk No. "), n, F.lit(": "), "p_name", F.lit(" | Moderated by Ann"))).otherwise(F.concat(F.lit("Talk #"), n))
    return table(spark, sf_dir, "part").select("p_partkey", m.number_and_topic(title).alias("t")).select("p_partkey", "t.number", "t.topic")


@query("m3_speaker_lines", "SELECT p_partkey, upper(p_name) AS name, CASE WHEN p_partkey % 4 < 3 THEN 'Peru' END AS country, (p_partkey % 50 * 60 + 5)::INT AS seconds FROM part")
def m3_speaker_lines(spark, sf_dir):
    time, name, k = F.format_string("%02d:05", (F.col("p_partkey") % 50).cast("int")), F.upper("p_name"), F.col("p_partkey") % 4
    line = F.when(k == 0, F.concat(time, F.lit(" "), name, F.lit(" (Peru)"))).when(k == 1, F.concat(name, F.lit(" // Peru "), time)).when(k == 2, F.concat(F.lit("["), time, F.lit("] "), name, F.lit(", Peru"))).otherwise(F.concat(name, F.lit(" "), time))
    return table(spark, sf_dir, "part").select("p_partkey", m.speaker_line(line).alias("s")).select("p_partkey", "s.name", "s.country", "s.seconds")


@query("m5_speaker_index", "SELECT doc_id, CASE i WHEN 0 THEN 'Ann Lee' WHEN 1 THEN 'Bob Ray' ELSE 'Cy Orr' END AS name, CASE i WHEN 0 THEN 'Peru' WHEN 1 THEN 'Lima' WHEN 2 THEN 'Chad' END AS country, (CASE i WHEN 0 THEN 65 WHEN 1 THEN 130 ELSE 3605 END)::INT AS seconds FROM documents, range(3) r(i)")
def m5_speaker_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n01:05 Ann Lee (Peru)\n\n02:10\nBob Ray\n\nLima\n[1:00:05] Cy Orr, Chad")).alias("text"))
    return m.speaker_index(docs, "doc_id").drop("idx")


@query("m6_moderators", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'Ann Lee' ELSE 'Bob' END AS moderator FROM part")
def m6_moderators(spark, sf_dir):
    text = F.concat("p_name", F.when(F.col("p_partkey") % 2 == 0, "\nModerated by Ann Lee and others").otherwise("\nmoderator:\nBob, again"))
    return table(spark, sf_dir, "part").select("p_partkey", m.moderator(text).alias("moderator"))


@query("m7_timecodes", "SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) ELSE printf('%02d:%02d', s // 60, s % 60) END AS shown, 'PT' || CASE WHEN s >= 3600 THEN (s // 3600) || 'H' ELSE '' END || CASE WHEN s % 3600 >= 60 THEN (s % 3600 // 60) || 'M' ELSE '' END || CASE WHEN s % 60 > 0 OR s = 0 THEN (s % 60) || 'S' ELSE '' END AS iso, s::INT AS back FROM (SELECT o_orderkey, o_orderkey * 7 % 20000 AS s FROM orders)")
def m7_timecodes(spark, sf_dir):
    from tessitura.functions.strings import seconds_of

    s = F.col("o_orderkey") * 7 % 20000
    return table(spark, sf_dir, "orders").select("o_orderkey", clock(s).alias("shown"), m.iso_duration(s).alias("iso"), seconds_of(clock(s)).alias("back"))


@query(
    "m8_fill_numbers",
    """WITH i AS (SELECT o_orderkey, o_orderpriority AS series, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS n FROM orders), t AS (SELECT series, max(n) AS mx, count(*) FILTER (n IS NULL) AS need FROM i GROUP BY series),
f AS (SELECT series, n, row_number() OVER (PARTITION BY series ORDER BY n) AS k FROM (SELECT series, unnest(range(1, (coalesce(mx, 0) + need + 1)::BIGINT)) AS n FROM t WHERE need > 0) x WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.series = x.series AND i.n = x.n)),
o AS (SELECT o_orderkey, series, row_number() OVER (PARTITION BY series ORDER BY o_orderkey) AS k FROM i WHERE n IS NULL)
SELECT o_orderkey, series, n::BIGINT AS number FROM i WHERE n IS NOT NULL UNION ALL SELECT o_orderkey, o.series, f.n::BIGINT FROM o JOIN f ON o.series = f.series AND o.k = f.k""",
)
def m8_fill_numbers(spark, sf_dir):
    i = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("series"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")).alias("number"))
    return m.fill_numbers(i, "series", "number", ["o_orderkey"])


@query("m9_role_index", "WITH r AS (SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN 'Introduction' WHEN 1 THEN 'Introduction' WHEN 2 THEN 'Summary' WHEN 3 THEN 'end' ELSE role END AS label FROM conversations), k AS (SELECT *, lag(label) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM r WHERE label <> 'end') SELECT conv_id, turn, label FROM k WHERE label IS DISTINCT FROM b")
def m9_role_index(spark, sf_dir):
    k = F.col("turn") % 5
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(k == 0, "Welcome").when(k == 1, " intro ").when(k == 2, "Wrap up").when(k == 3, "END").otherwise(F.col("role")).alias("label"))
    return m.role_index(rows, "conv_id", "turn", "label")


@query("m10_trusted_dates", """WITH d AS (SELECT o_orderkey, o_orderdate::DATE AS u, (o_orderdate - INTERVAL 1 DAY * (o_orderkey % 700 - 50))::DATE AS a, (o_orderdate - INTERVAL 1 DAY * (o_orderkey % 300))::DATE AS b, o_orderkey % 2 = 0 AS has FROM orders)
SELECT o_orderkey, CASE WHEN u - a BETWEEN 0 AND 400 THEN a WHEN has AND u - b BETWEEN 0 AND 400 THEN b ELSE u END AS date, CASE WHEN u - a BETWEEN 0 AND 400 THEN 'title' WHEN has AND u - b BETWEEN 0 AND 400 THEN 'text' ELSE 'upload' END AS origin FROM d""")
def m10_trusted_dates(spark, sf_dir):
    u = F.to_date("o_orderdate")
    a, b = F.date_sub(u, (F.col("o_orderkey") % 700 - 50).cast("int")), F.when(F.col("o_orderkey") % 2 == 0, F.date_sub(u, (F.col("o_orderkey") % 300).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", m.trusted_date(u, [("title", a), ("text", b)]).alias("d")).select("o_orderkey", "d.date", "d.origin")


@query("m11_narrative", r"SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^\s*(\(?\d{1,2}(:\d{2}){1,2}|https?://\S+\s*$|#\S+|[-_=*]{3,}\s*$|[^.!?]*:\s*$)') AND length(regexp_replace(x, '[^\p{L}]', '', 'g')) >= 25), chr(10)) AS text FROM documents")
def m11_narrative(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n01:02 A time with a name and many letters\n#hashtag with a lot of letters in it\nhttps://a.example/with/letters/enough/to/count")).alias("text"))
    return docs.select("doc_id", m.narrative(F.col("text")).alias("text"))


@query("m12_overrides", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'name ' || c_custkey ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer")
def m12_overrides(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    o = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("c_name").alias("field"), F.concat(F.lit("name "), F.col("c_custkey").cast("string")).alias("value")).union(c.where("c_custkey % 5 = 0").select("c_custkey", F.lit("c_mktsegment"), F.lit(None).cast("string")))
    return m.apply_overrides(c, o, "c_custkey", ["c_name", "c_mktsegment"])


@query("m13_addresses", "SELECT p_partkey, lower(replace(p_name, ' ', '-')) || '-ete-' || lower(p_type) || '-one-two-three-four-five' AS slug FROM part WHERE length(p_name) + length(p_type) <= 20")
def m13_addresses(spark, sf_dir):
    p = table(spark, sf_dir, "part").where("length(p_name) + length(p_type) <= 20")
    return p.select("p_partkey", m.slug(F.concat("p_name", F.lit(" — Été! "), "p_type", F.lit(" one two three four five sixsevenninesixsevenninesixsevennine"))).alias("slug"))


@query("m14_clips", r"""WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents), c AS (SELECT doc_id, t, regexp_replace(left(t, 157), '\s+\S*$', '') AS cut, regexp_extract(t, '^(.{80,259}?[.?!…])(?:\s|$)', 1) AS s, regexp_replace(left(t, 259), '\s+\S*$', '') AS cut2 FROM t)
SELECT doc_id, CASE WHEN length(t) <= 158 THEN t ELSE regexp_replace(cut, '[,;:.\s]+$', '') || '…' END AS clip, CASE WHEN s <> '' THEN s WHEN length(t) <= 260 THEN t ELSE regexp_replace(cut2, '[,;:.\s]+$', '') || '…' END AS quote FROM c""")
def m14_clips(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", m.clip(F.col("text")).alias("clip"), m.first_sentence(F.col("text")).alias("quote"))


@query("m15_dates_shown", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN monthname(o_orderdate) || ' ' || day(o_orderdate) || ', ' || year(o_orderdate) WHEN 1 THEN monthname(o_orderdate) || ' ' || year(o_orderdate) ELSE year(o_orderdate)::VARCHAR END AS shown FROM orders")
def m15_dates_shown(spark, sf_dir):
    iso = F.left(F.date_format("o_orderdate", "yyyy-MM-dd"), F.element_at(F.array(F.lit(10), F.lit(7), F.lit(4)), (F.col("o_orderkey") % 3 + 1).cast("int")))
    return table(spark, sf_dir, "orders").select("o_orderkey", m.show_date(iso).alias("shown"))


@query("m16_citations", f"""WITH {SEG}, c AS (SELECT slug, seg, speaker, 'Talk ' || slug AS title, 'https://v.example/?v=' || slug || '&t=' || (seg * 30) || 's' AS link FROM seg WHERE speaker IS NOT NULL)
SELECT slug, seg, speaker || ', in “' || title || '”, Archive, March 5, 2021, ' || link || '.' AS chicago, speaker || '. “' || title || '.” Archive, 2021, ' || link || '. Accessed 1 May 2024.' AS mla, speaker || ' (2021). ' || title || ' [Video]. Archive. ' || link AS apa,
'@misc{{' || speaker || '2021, author={{' || speaker || '}}, title={{' || title || '}}, year={{2021}}, url={{' || link || '}}}}' AS bibtex, 'TY  - VIDEO' || chr(10) || 'AU  - ' || speaker || chr(10) || 'TI  - ' || title || chr(10) || 'PY  - 2021' || chr(10) || 'UR  - ' || link || chr(10) || 'ER  - ' AS ris FROM c""")
def m16_citations(spark, sf_dir):
    s = segments(spark, sf_dir).where("speaker is not null")
    made = m.citations(F.col("speaker"), F.concat(F.lit("Talk "), F.col("slug").cast("string")), F.lit("2021-03-05"), F.concat(F.lit("https://v.example/?v="), F.col("slug").cast("string")), F.col("start").cast("long"), "1 May 2024", "Archive")
    return s.select("slug", "seg", *made)


@query("m17_name_lists", "SELECT p_partkey, p_partkey % 4 IN (0, 1) AS roster FROM part")
def m17_name_lists(spark, sf_dir):
    k = F.col("p_partkey") % 4
    title = F.when(k == 0, "Ann Lee, Bob Ray and Cy Orr").when(k == 1, "March 5, 2021").when(k == 2, F.col("p_name")).otherwise("Art and Code")
    return table(spark, sf_dir, "part").select("p_partkey", m.is_name_list(title).alias("roster"))


@query("m18_match_by_length", "WITH p AS (SELECT s_suppkey AS recording, c_custkey AS file, abs(c_acctbal - s_acctbal) AS gap FROM supplier JOIN customer ON s_nationkey = c_nationkey WHERE abs(c_acctbal - s_acctbal) <= 0.15::DOUBLE * s_acctbal) SELECT recording, arg_min(file, (gap, file)) AS file, round(min(gap) * 100)::BIGINT AS gap_c FROM p GROUP BY recording")
def m18_match_by_length(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_custkey").alias("file"), F.col("c_acctbal").alias("seconds"))
    r = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("recording"), F.col("s_acctbal").alias("seconds"))
    return m.match_by_length(f, r, "g").select("recording", "file", F.round(F.col("gap") * 100).cast("long").alias("gap_c"))


@query("m18_preferred", "SELECT s_suppkey AS recording, arg_min(c_custkey, (c_custkey % 3, c_custkey)) AS file, min(c_custkey % 3)::BIGINT AS preference FROM supplier JOIN customer ON s_nationkey = c_nationkey AND abs(c_acctbal - s_acctbal) <= 0.01::DOUBLE * s_acctbal + 2 GROUP BY s_suppkey")
def m18_preferred(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("g"), F.col("c_custkey").alias("file"), F.col("c_acctbal").alias("seconds"), (F.col("c_custkey") % 3).cast("long").alias("preference"))
    r = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("g"), F.col("s_suppkey").alias("recording"), F.col("s_acctbal").alias("seconds"))
    return m.match_by_preference(f, r, "g")


@query("m19_headings", f"WITH {SEG}, p AS (SELECT slug, speaker, min(seg) AS f FROM seg WHERE speaker IS NOT NULL GROUP BY ALL) SELECT slug, string_agg(speaker, ', ' ORDER BY f) AS people, 'Talk ' || slug AS heading FROM p GROUP BY slug")
def m19_headings(spark, sf_dir):
    p = segments(spark, sf_dir).where("speaker is not null").groupBy("slug", "speaker").agg(F.min("seg").alias("f"))
    return p.groupBy("slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("f", "speaker"))), lambda x: x["speaker"]), ", ").alias("people")).withColumn("heading", F.concat(F.lit("Talk "), F.col("slug").cast("string")))


@query("m20_selection", "SELECT o_orderkey, printf('talk-%03d', o_orderkey) AS slug FROM orders WHERE o_orderkey IN (7, 12, 1003)")
def m20_selection(spark, sf_dir):
    """The selection is the feature."""
    return m.select_recordings(table(spark, sf_dir, "orders").select("o_orderkey", F.format_string("talk-%03d", "o_orderkey").alias("slug")), "slug", ["talk-007", "12", "1003"])
