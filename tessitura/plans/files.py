"""Queries of file readers: Spark writes the files from the tables, then the readers read them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.functions.strings import clock
from tessitura.operators import clean, metadata, names, sentences, timejoins
from tessitura.sources import sinks, sites

from .fixtures import EV, SEG, events, segments
from .registry import query, table
from .streams import _folder


@query("s6_metadata", "SELECT 'v' || o_orderkey AS id, o_orderpriority AS title, o_orderdate::DATE AS upload_date, o_totalprice AS duration FROM orders")
def s6_metadata(spark, sf_dir):
    path = _folder(spark)
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("v"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderpriority").alias("title"), F.date_format("o_orderdate", "yyyyMMdd").alias("upload_date"), F.col("o_totalprice").alias("duration"), F.lit("unknown field").alias("extra"))
    o.write.json(path)
    return sites.read_metadata(spark, path, lines=True).select("id", "title", "upload_date", "duration")


#: Items of a file of an export: a file is read by one task, as XML is not split.
ITEMS = 50_000


@query("s7_site_export", "SELECT p_name AS title, 'u' || p_partkey AS link, CASE WHEN p_partkey % 4 = 2 THEN 'page' ELSE 'post' END AS kind, p_type AS content FROM part WHERE p_partkey % 4 IN (0, 2)")
def s7_site_export(spark, sf_dir):
    path, k = _folder(spark), F.col("p_partkey") % 4
    items = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("title"), F.concat(F.lit("u"), F.col("p_partkey").cast("string")).alias("link"), F.when(k == 2, "page").when(k == 3, "image").otherwise("post").alias("post_type"),
        F.when(k == 1, "draft").otherwise("publish").alias("status"), F.col("p_type").alias("encoded"), F.array(F.lit("a"), F.lit("b")).alias("category"),
    )
    items.write.format("xml").option("rowTag", "item").option("rootTag", "channel").option("maxRecordsPerFile", ITEMS).save(path)
    return sites.read_site_export(spark, path).select("title", "link", "kind", "content")


@query("s14_inventory", "SELECT 'kind=' || c_mktsegment AS folder, true AS captions, false AS transcript FROM customer GROUP BY c_mktsegment")
def s14_inventory(spark, sf_dir):
    path = _folder(spark)
    table(spark, sf_dir, "customer").select(F.col("c_name").alias("value"), F.col("c_mktsegment").alias("kind")).write.partitionBy("kind").option("compression", "none").text(path)
    inv = sites.file_inventory(spark, path).where("file like 'part-%'").withColumn("kind", F.lit("captions"))
    return sites.inventory_by_folder(inv).select("folder", "captions", "transcript")


@query("s15_form", "SELECT c_custkey::VARCHAR AS id, c_name AS new_text, c_mktsegment AS old_text, NULL::VARCHAR AS mail FROM customer")
def s15_form(spark, sf_dir):
    path = _folder(spark)
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("Entry Id"), F.col("c_mktsegment").alias("Original text (as shown)"), F.col("c_name").alias("Corrected Text")).write.option("header", True).csv(path)
    return sites.read_form_csv(spark, path, {"id": (["entry", "id"], []), "new_text": (["text"], ["original"]), "old_text": (["original"], []), "mail": (["mail"], [])})


@query("k5_review_queue", "SELECT event_id, event_type, 'r' || (event_id % 3) AS run FROM events")
def k5_review_queue(spark, sf_dir):
    """Three runs append their rows; the second is sent twice."""
    path, e = _folder(spark), table(spark, sf_dir, "events").select("event_id", "event_type")
    for n in (0, 1, 1, 2):
        sinks.append_run(e.where(F.col("event_id") % 3 == n), path, f"r{n}")
    return spark.read.parquet(path).select("event_id", "event_type", "run")


@query("k2_partial_rebuild", "SELECT o_orderkey, o_orderpriority AS type, CASE WHEN o_orderpriority IN ('1-URGENT', '5-LOW') THEN 2 ELSE 1 END AS v FROM orders")
def k2_partial_rebuild(spark, sf_dir):
    path, o = _folder(spark), table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("type"))
    sinks.replace_recordings(spark, path, o.select("o_orderkey", F.lit(1).alias("v"), "type"))
    sinks.replace_recordings(spark, path, o.where("type in ('1-URGENT', '5-LOW')").select("o_orderkey", F.lit(2).alias("v"), "type"))
    return spark.read.schema("o_orderkey long, v int, type string").parquet(path)


@query("k7_descriptions", rf"""WITH {SEG}, p AS (SELECT slug, speaker, min(start) AS t, sum(len(regexp_extract_all(text, '\S+'))) AS w FROM seg WHERE speaker IS NOT NULL GROUP BY ALL),
r AS (SELECT slug, string_agg(speaker, ', ' ORDER BY w DESC, speaker) AS people, string_agg(printf('%02d:%02d %s', t::INT // 60, t::INT % 60, speaker), chr(10) ORDER BY t, speaker) AS times FROM p GROUP BY slug) SELECT slug, 'Talk ' || slug || ' with ' || people || chr(10) || times AS text FROM r""")
def k7_descriptions(spark, sf_dir):
    """A draft: the title, people by how much they say, and when each first speaks."""
    from tessitura.functions.strings import count_words

    p = segments(spark, sf_dir).where("speaker is not null").groupBy("slug", "speaker").agg(F.min("start").alias("t"), (-F.sum(count_words(F.col("text")))).alias("w"))
    people = sinks.ordered_text(p, ["slug"], ["w", "speaker"], F.col("speaker"), ", ").withColumnRenamed("text", "people")
    times = sinks.ordered_text(p, ["slug"], ["t", "speaker"], F.concat_ws(" ", clock(F.col("t")), "speaker"), "\n").withColumnRenamed("text", "times")
    return people.join(times, "slug").select("slug", F.concat(F.lit("Talk "), F.col("slug").cast("string"), F.lit(" with "), "people", F.lit("\n"), "times").alias("text"))


@query("m4_index_flags", r"SELECT doc_id, 2::BIGINT AS entries, 1::BIGINT AS unparsed FROM documents")
def m4_index_flags(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit("\n01:05 Ann Lee (Peru)\n at 2:10 we 33 99 begin\nBob Ray // Chad 1:00:05")).alias("text"))
    return metadata.index_flags(docs, "doc_id")


@query("x6_target_word", "SELECT doc_id, text || ' Neoimpressionists and Neoimpressionism, Neotribalism.' AS text FROM documents")
def x6_target_word(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.lit(" Neo-impresionists and neoimpressionism, Neotribalism.")).alias("text"))
    return names.fix_target_word(docs, "doc_id", "Neoimpression", ["neo"])


@query("w5_time_maps", rf"""WITH {SEG}, w AS (SELECT slug, seg, unnest(ws) AS token, unnest(range(len(ws))) AS idx, start FROM (SELECT slug, seg, start, regexp_extract_all(text, '\S+') AS ws FROM seg)),
p AS (SELECT *, coalesce(sum(length(token) + 1) OVER (PARTITION BY slug, seg ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos, sum(length(token) + 1) OVER (PARTITION BY slug, seg) - 1 AS len FROM w)
SELECT slug, seg AS para, idx::INT AS idx, round(1000 * pos / len)::BIGINT AS per_mille, round((start + 0.1::DOUBLE * idx) * 10)::BIGINT AS sec_ds FROM p WHERE slug % 2 = 0""")
def w5_time_maps(spark, sf_dir):
    """Words of every other recording lack one, so that it has no map. Halves of a per mille go up: a fraction's last bit must not decide."""
    s = segments(spark, sf_dir)
    texts = s.select("slug", F.col("seg").alias("para"), "text")
    w = sentences.tokens(s.withColumn("para", F.col("seg")), ["slug", "seg"]).withColumn("start", F.col("seg") * 30.0 + 0.1 * F.col("idx"))
    w = w.where("slug % 2 = 0 or seg > 0 or idx > 0").select("slug", "idx", "start")
    return sentences.time_maps(w, texts, "slug").select("slug", "para", "idx", F.round(1000 * F.col("frac") + 1e-9).cast("long").alias("per_mille"), F.round(10 * F.col("sec")).cast("long").alias("sec_ds"))


@query("t4_paragraph_starts", f"WITH {SEG} SELECT slug, seg, i::INT AS para, CASE WHEN i = 0 THEN start WHEN seg % 2 = 0 THEN start + 10 * i END::BIGINT AS start FROM seg, range(3) r(i)")
def t4_paragraph_starts(spark, sf_dir):
    """Three paragraphs each; the times of odd segments lack one."""
    s = segments(spark, sf_dir).withColumn("text", F.lit("a\n\nb\n\nc"))
    times = F.transform(F.sequence(F.lit(0), F.when(F.col("seg") % 2 == 0, 2).otherwise(1)), lambda i: F.col("start") + 10 * i)
    return sentences.paragraph_starts(s.withColumn("starts", times), ["slug", "seg"]).withColumn("start", F.col("start").cast("long"))


@query("t3_word_segments", f"""WITH {EV}, st AS (SELECT slug, floor(t / 86400) * 86400 AS from_sec FROM ev GROUP BY ALL), a AS (SELECT ev.slug, from_sec, t, idx, kind FROM ev JOIN st ON ev.slug = st.slug AND floor(t / 86400) * 86400 = from_sec),
g AS (SELECT *, lead(t) OVER w - t AS gap, t - lag(t) OVER w AS after FROM a WINDOW w AS (PARTITION BY slug, from_sec ORDER BY t, idx))
SELECT slug, from_sec::BIGINT AS from_sec, string_agg(CASE WHEN after IS NULL OR after >= 7200 THEN upper(left(kind, 1)) || substr(kind, 2) ELSE kind END || CASE WHEN gap IS NULL OR gap >= 7200 THEN '.' ELSE '' END, ' ' ORDER BY t, idx) AS text FROM g GROUP BY ALL""")
def t3_word_segments(spark, sf_dir):
    """Words to segments by their boundaries, then punctuation by pauses within each."""
    e = events(spark, sf_dir)
    steps = e.select("slug", (F.floor(F.col("t") / 86400) * 86400.0).alias("from_sec")).distinct().withColumn("b", F.col("from_sec"))
    w = timejoins.asof_last(e, steps, "slug", "t", "from_sec", ["b"])
    w = w.select(F.struct("slug", "b").alias("k"), "idx", F.col("t").alias("start"), F.col("kind").alias("text"))
    done = clean.restore_punctuation(w, key="k", sentence_pause=7200.0, paragraph_pause=1e12)
    return done.select("k.slug", F.col("k.b").cast("long").alias("from_sec"), "text")
