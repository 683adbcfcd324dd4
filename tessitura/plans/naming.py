"""Queries of names: parts' names are people, suppliers and customers are lists of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.functions.strings import fold
from tessitura.functions.tables import written
from tessitura.operators import name_fixes, names, people, sentences

from .fixtures import SENT, paragraphs
from .ranking import global_rank
from .registry import query, table


def _people(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name")).distinct()


@query("n1_person_key", "SELECT p_partkey, lower(p_name) || ' elan' AS key FROM part")
def n1_person_key(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", names.person_key(F.concat(F.initcap("p_name"), F.lit(" Élan (@handle) / x9"))).alias("key"))


@query("n2_canonical_speaker", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Alias of ' || p_name ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') END AS speaker FROM part WHERE p_name <> 'x' AND p_partkey IS NOT NULL")
def n2_canonical_speaker(spark, sf_dir):
    """Names in capitals, with a number in front and a place behind; every third has an alias."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("12  "), F.upper("p_name"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" "), F.col("p_partkey").cast("string"))).otherwise(""), F.lit(" (Rome, NY USA)")).alias("raw"))
    aliases = table(spark, sf_dir, "part").where("p_partkey % 3 = 0").select(F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("alias"), F.concat(F.lit("Alias of "), F.col("p_name")).alias("name"))
    return names.canonical_speaker(p, aliases, table(spark, sf_dir, "region").select(F.col("r_name").alias("label")), "raw").select("p_partkey", "speaker")


@query("n3_finalize_speakers", """WITH r AS (SELECT conv_id AS slug, role AS name, turn * 30::DOUBLE AS start, CASE WHEN turn % 2 = 1 THEN 'place ' || turn END AS location FROM conversations WHERE role <> 'system'),
e AS (SELECT slug, CASE WHEN name = 'assistant' THEN unnest(['Ann', 'Bob']) ELSE name END AS name, start, location FROM r), u AS (SELECT DISTINCT * FROM e) SELECT slug, name, min(start)::BIGINT AS start, arg_min(location, start) FILTER (location IS NOT NULL) AS location FROM u GROUP BY slug, name""")
def n3_finalize_speakers(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("slug"), F.col("role").alias("name"), (F.col("turn") * 30.0).alias("start"), F.when(F.col("turn") % 2 == 1, F.concat(F.lit("place "), F.col("turn").cast("string"))).alias("location"))
    duos = spark.createDataFrame([("assistant", ["Ann", "Bob"])], "label string, names array<string>")
    return names.finalize_speakers(rows, duos, spark.createDataFrame([("system",)], "label string"), "slug").withColumn("start", F.col("start").cast("long"))


@query("n4_merge_lists", """WITH a AS (SELECT 'Person ' || s_suppkey AS name, CASE WHEN s_suppkey % 3 > 0 THEN 'N' || s_nationkey END AS country FROM supplier), b AS (SELECT 'person ' || c_custkey AS name, 'N' || c_nationkey AS country FROM customer)
SELECT coalesce(a.name, b.name) AS name, coalesce(a.country, b.country) AS country, a.name IS NULL AS added FROM a FULL JOIN b ON lower(a.name) = lower(b.name)""")
def n4_merge_lists(spark, sf_dir):
    a = table(spark, sf_dir, "supplier").select(F.concat(F.lit("Person "), F.col("s_suppkey").cast("string")).alias("name"), F.when(F.col("s_suppkey") % 3 > 0, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("country"))
    b = table(spark, sf_dir, "customer").select(F.concat(F.lit("person "), F.col("c_custkey").cast("string")).alias("name"), F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("country"))
    return names.merge_lists(a, b)


@query("n5_country", """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN replace(n_name, '_', ' ') WHEN c_custkey % 5 = 1 THEN 'United Kingdom' WHEN c_custkey % 5 = 2 THEN replace(n_name, '_', ' ') WHEN c_custkey % 5 = 3 THEN 'USA' END AS resolved FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def n5_country(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.replace("n_name", F.lit("_"), F.lit(" ")).alias("country"))
    c = table(spark, sf_dir, "customer").join(nation, "c_nationkey")
    k = F.col("c_custkey") % 5
    place = F.when(k == 1, "London, England").when(k == 2, F.concat(F.lit("Old Town, "), F.col("country"))).when(k == 3, "Brooklyn, NY").when(k == 4, "Nowhere")
    known = c.select(F.when(k == 0, F.col("c_name")).otherwise("").alias("name"), "country").where("name <> '' or country is not null")
    known = known.where("name <> ''").union(known.select(F.concat(F.lit("nobody in "), F.col("country")), "country").distinct())
    return names.resolve_country(c.select("c_custkey", "c_name", place.alias("place")), known, "c_name", "place").select("c_custkey", "resolved")


@query("n8_candidate_pools", "SELECT c_custkey FROM customer WHERE c_mktsegment || c_nationkey NOT IN (SELECT 'BUILDING' || n_nationkey FROM nation) AND c_custkey NOT IN (SELECT s_suppkey FROM supplier)")
def n8_candidate_pools(spark, sf_dir):
    pool = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.col("c_mktsegment"), F.col("c_nationkey").cast("string")).alias("name"))
    vocab = table(spark, sf_dir, "nation").select(F.concat(F.lit("building"), F.col("n_nationkey").cast("string")).alias("canonical"))
    kept = names.without_collisions(pool, vocab).withColumn("name", F.col("c_custkey").cast("string"))
    return names.without_collisions(kept, vocab, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("name"))).select("c_custkey")


@query("n9_suppressed_pairs", "SELECT event_id FROM events WHERE (props, event_type) NOT IN (SELECT DISTINCT props, event_type FROM events WHERE value > 200)")
def n9_suppressed_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.upper("props").alias("matched"), F.col("event_type").alias("candidate"), "value")
    return names.unsuppressed(e, e.where("value > 200").select("matched", "candidate")).select("event_id")


def _misspelt(spark, sf_dir):
    """Every document, with a name with a letter lost at its end where a part has its number."""
    p = table(spark, sf_dir, "part").select((F.col("p_partkey")).alias("doc_id"), F.concat(F.substring("p_name", 1, 3), F.substring("p_name", 5, 60)).alias("heard"))
    return table(spark, sf_dir, "documents").join(p, "doc_id", "left").select("doc_id", F.concat_ws(" ", "text", "heard", F.lit("spoke.")).alias("text"))


@query("n7_name_candidates")
def n7_name_candidates(spark, sf_dir):
    return names.name_candidates(_misspelt(spark, sf_dir), _people(spark, sf_dir), ["doc_id"], 0.85, sizes=(2,))


def _index_names(spark, sf_dir):
    """(name, number): suppliers as an index of names of one word each, numbered from 1. Suppliers' own names are nearly all
    alike, so that one said wrong would be close to them all; these are not: letters that stand for digits of their hash."""
    letters = F.translate(F.left(F.md5("s_name"), F.lit(13)), "0123456789abcdef", "aeioulmnrtdkbgvz")
    return global_rank(table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), letters).alias("name")).where("name is not null").distinct(), [F.col("name")], "number")


def _heard(spark, sf_dir, index):
    """Every document with two names said wrong at its end: its own, where it has one, with a letter lost, and one of the index with a
    letter doubled. Documents meet the index in turn, by their numbers."""
    p = table(spark, sf_dir, "part").groupBy(F.col("p_partkey").alias("doc_id")).agg(F.min("p_name").alias("own"))
    lost = F.concat(F.substring("own", 1, 3), F.substring("own", 5, 60))
    said = F.when(F.col("own").isNotNull(), F.concat(F.lit(". Then "), lost, F.lit("'s friend, and so on."))).otherwise("")
    doubled = F.concat(F.substring("listed", 1, 4), F.substring("listed", 4, 60))
    also = F.when(F.col("listed").isNotNull(), F.concat(F.lit(". Later "), doubled, F.lit(" came, and so on."))).otherwise("")
    listed = index.select(F.col("name").alias("listed"), (F.col("number") - 1).cast("long").alias("_turn"))
    d = table(spark, sf_dir, "documents").join(p, "doc_id", "left").withColumn("_turn", F.pmod("doc_id", F.lit(max(1, index.count()))))
    return d.join(listed, "_turn", "left").select("doc_id", F.concat(F.coalesce("text", F.lit("")), said, also).alias("text"), "own")


def _name_findings(spark, sf_dir):
    numbered = written(_index_names(spark, sf_dir), "index")
    d = _heard(spark, sf_dir, numbered)
    own = d.where("own is not null").select("doc_id", F.col("own").alias("name"))
    index = numbered.select("name")
    ordinary = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^a-z]+")).alias("word")).where("word <> ''").distinct()
    suppressed = spark.createDataFrame([], "matched string, candidate string")
    found = name_fixes.name_findings(d, ["doc_id"], own, ["doc_id"], index, ordinary, index, suppressed)
    return d, found


@query("n7_name_findings")
def n7_name_findings(spark, sf_dir):
    return _name_findings(spark, sf_dir)[1].select("doc_id", "name", "pool", F.col("idx").cast("long").alias("idx"), "heard", F.round(F.col("ratio") * 1000).cast("long").alias("ratio"), "action")


@query("n7_corrected_texts")
def n7_corrected_texts(spark, sf_dir):
    d, found = _name_findings(spark, sf_dir)
    return name_fixes.correct_names(d, found, ["doc_id"]).select("doc_id", F.sha2("text", 256).alias("text_sha256"))


@query("n6_session_speakers")
def n6_session_speakers(spark, sf_dir):
    """Parts are people and eight of them a recording; a label is a person's name with a letter lost, their first word, or whole."""
    p = table(spark, sf_dir, "part").select(F.floor(F.col("p_partkey") / 8).alias("slug"), "p_partkey", "p_name")
    k = F.col("p_partkey") % 3
    label = F.when(k == 0, F.concat(F.substring("p_name", 1, 3), F.substring("p_name", 5, 60))).when(k == 1, F.split("p_name", " ")[0]).otherwise(F.col("p_name"))
    speakers = p.where("p_partkey % 2 = 0").select("slug", F.col("p_name").alias("name"))
    return name_fixes.session_speakers(p.select("slug", "p_partkey", label.alias("label")), speakers, p.select(F.col("p_name").alias("name")), ["slug"]).select("p_partkey", "label", "speaker")


@query("n10_name_variants")
def n10_name_variants(spark, sf_dir):
    return names.name_variants(_misspelt(spark, sf_dir), _people(spark, sf_dir), "doc_id")


@query("n6_similar_names")
def n6_similar_names(spark, sf_dir):
    p = _people(spark, sf_dir)
    return names.similarity_join(p.select(F.col("name").alias("a")), p.select(F.reverse("name").alias("b")), "a", "b", 0.6)


@query("n14_merge_spellings")
def n14_merge_spellings(spark, sf_dir):
    c = table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("slug"), F.col("p_name").alias("name")).agg(F.count("*").alias("n"))
    return names.merge_spellings(c, "slug", 0.8)


@query("n16_absorbed_names", """WITH n AS (SELECT DISTINCT p_name AS name FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] || ' ' || lower(p_type) || ' ' || string_split(p_name, ' ')[-1] FROM part),
e AS (SELECT a.name, min(b.name) AS i FROM n a JOIN n b ON len(string_split(a.name, ' ')) = 2 AND len(string_split(b.name, ' ')) = 3 AND string_split(a.name, ' ')[1] = string_split(b.name, ' ')[1] AND string_split(a.name, ' ')[2] = string_split(b.name, ' ')[3] GROUP BY a.name)
SELECT n.name, coalesce(i, n.name) AS "into" FROM n LEFT JOIN e USING (name)""")
def n16_absorbed_names(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    long = p.select(F.concat_ws(" ", F.split("p_name", " ")[0], F.lower("p_type"), F.element_at(F.split("p_name", " "), -1)).alias("name"))
    return names.absorb_short_names(p.select(F.col("p_name").alias("name")).union(long))


@query("n17_directory", "WITH d AS (SELECT lower(p_name) AS k, min(p_partkey) AS id FROM part GROUP BY 1) SELECT p_partkey, id FROM part JOIN d ON k = lower(p_name)")
def n17_directory(spark, sf_dir):
    key = lambda c: F.lower(fold(c))
    p = table(spark, sf_dir, "part").select("p_partkey", F.initcap("p_name").alias("name"))
    d = table(spark, sf_dir, "part").groupBy(key(F.col("p_name")).alias("k")).agg(F.min("p_partkey").alias("id"))
    return p.join(d, key(F.col("name")) == F.col("k")).select("p_partkey", "id")


@query("n13_phrase_groups", rf"""WITH {SENT}, m AS (SELECT slug, sentence, unnest(regexp_extract_all(lower(sentence), '\p{{L}}*ention\p{{L}}*')) AS phrase FROM sent) SELECT phrase, count(*)::BIGINT AS n, count(DISTINCT slug)::BIGINT AS recordings, arg_min(sentence, (length(sentence), sentence)) AS example FROM m GROUP BY phrase""")
def n13_phrase_groups(spark, sf_dir):
    s = sentences.sentences(paragraphs(spark, sf_dir), ["slug", "seg", "para"])
    return names.phrase_groups(s, r"(?U)\p{L}*ention\p{L}*", "slug")


@query("n20_name_cards", "SELECT 'small ring' AS name, 3 AS score UNION ALL SELECT name, 2 FROM (SELECT DISTINCT p_name AS name FROM part WHERE p_name LIKE 'small ring_%' ORDER BY 1 LIMIT 2)")
def n20_name_cards(spark, sf_dir):
    """A search for a person: the top three are the feature."""
    return names.name_cards("small ring", _people(spark, sf_dir))


@query("n21_contact_match", """WITH m AS (SELECT s_suppkey, c_custkey, CASE WHEN s_suppkey = c_custkey THEN 1 WHEN s_nationkey = c_nationkey AND floor(s_acctbal / 10) = floor(c_acctbal / 10) THEN 2 END AS tier FROM supplier JOIN customer ON s_suppkey = c_custkey OR s_nationkey = c_nationkey AND floor(s_acctbal / 10) = floor(c_acctbal / 10))
SELECT s_suppkey, arg_min(c_custkey, (tier, c_custkey)) AS c_custkey, min(tier)::INT AS tier FROM m GROUP BY s_suppkey""")
def n21_contact_match(spark, sf_dir):
    near = lambda c: F.floor(F.col(c) / 10)
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_suppkey").alias("number"), F.col("s_nationkey").alias("nation"), near("s_acctbal").alias("balance"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("number"), F.col("c_nationkey").alias("nation"), near("c_acctbal").alias("balance"))
    return people.match_by_tiers(s, c, "s_suppkey", "c_custkey", [["number"], ["nation", "balance"]])


N21 = """WITH RECURSIVE p AS (SELECT 'c' || c_custkey AS id, c_custkey AS number, c_nationkey || ':' || floor(c_acctbal / 10)::BIGINT AS site, c_nationkey || '@' || c_custkey * 37 % 1009 AS handle, c_acctbal AS w, right(c_name, 2) AS surname, left(c_nationkey::VARCHAR, 1) AS initial FROM customer
  UNION ALL SELECT 's' || s_suppkey, s_suppkey, s_nationkey || ':' || floor(s_acctbal / 10)::BIGINT, s_nationkey || '@' || s_suppkey * 37 % 1009, s_acctbal, right(s_name, 2), left(s_nationkey::VARCHAR, 1) FROM supplier),
k AS (SELECT id, 'n' || number AS k FROM p UNION ALL SELECT id, 's' || site FROM p UNION ALL SELECT id, 'h' || handle FROM p), e AS (SELECT DISTINCT a.id AS a, b.id AS b FROM k a JOIN k b USING (k)),
r(id, root) AS (SELECT id, id FROM p UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.id), c AS (SELECT id, min(root) AS person FROM r GROUP BY id),
q AS (SELECT p.*, person, first_value(id) OVER (PARTITION BY person ORDER BY w DESC, id) AS survivor FROM p JOIN c USING (id)), n AS (SELECT surname, initial, count(DISTINCT person) - 1 AS possible FROM q GROUP BY ALL)
SELECT id, person, survivor, possible::INT AS possible FROM q JOIN n USING (surname, initial)"""


@query("n21_identities", N21)
def n21_identities(spark, sf_dir):
    """Customers and suppliers as records of persons: the number is a name, nation and balance a site, nation and a part of the number a handle."""

    def records(name: str, letter: str, number: str) -> DataFrame:
        t, nation, shown, balance = table(spark, sf_dir, name), F.col(f"{letter}_nationkey").cast("string"), F.col(f"{letter}_name"), F.col(f"{letter}_acctbal")
        site = F.concat(nation, F.lit(":"), F.floor(balance / 10).cast("long").cast("string"))
        return t.select(F.concat(F.lit(letter), F.col(number).cast("string")).alias("id"), F.col(number).cast("long").alias("number"), site.alias("site"), F.concat(nation, F.lit("@"), (F.col(number) * 37 % 1009).cast("string")).alias("handle"), balance.alias("when"), F.right(shown, F.lit(2)).alias("surname"), F.left(nation, F.lit(1)).alias("initial"))

    both = records("customer", "c", "c_custkey").union(records("supplier", "s", "s_suppkey"))
    return people.identities(both, "id", ["number", "site", "handle"], "when", F.col("surname"), F.col("initial"))


@query("n22_split_names", """WITH p AS (SELECT p_partkey, upper(left(w[1], 1)) || substr(w[1], 2) AS a, upper(left(w[2], 1)) || substr(w[2], 2) AS b FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part))
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN a WHEN 1 THEN 'Jan' WHEN 2 THEN '' ELSE a END AS first, CASE p_partkey % 4 WHEN 0 THEN 'van der ' || b WHEN 1 THEN 'de Wit' WHEN 2 THEN a || ' ' || b || ' Gallery' ELSE b END AS last FROM p""")
def n22_split_names(spark, sf_dir):
    """Names with particles, handles with the real name in brackets, galleries, and names with what follows a name."""
    w = F.split("p_name", " ")
    a, b = (F.concat(F.upper(F.left(x, F.lit(1))), F.substr(x, F.lit(2))) for x in (w[0], w[1]))
    shown = F.element_at(F.array(F.concat(a, F.lit(" van der "), b), F.concat(a, F.lit(" (Jan de Wit)")), F.concat_ws(" ", a, b, F.lit("Gallery")), F.concat(a, F.lit(' "Sparrow" '), b, F.lit(" aka Annie"))), (F.col("p_partkey") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", names.split_name(shown).alias("n")).select("p_partkey", "n.first", "n.last")


MENTION = f"""WITH {SENT}, x AS (SELECT slug, seg, para, sent, speaker, sentence || CASE WHEN (slug + seg) % 3 = 0 THEN ' small ring and red widget' ELSE '' END AS s FROM sent),
w AS (SELECT slug, seg, para, sent, speaker, regexp_extract_all(lower(s), '[\\p{{L}}\\p{{M}}\\p{{N}}_'']+') AS ws FROM x), t AS (SELECT *, unnest(ws) AS a, unnest(range(1, len(ws) + 1)) AS pos FROM w),
b AS (SELECT *, a || ' ' || lead(a) OVER (PARTITION BY slug, seg, para, sent ORDER BY pos) AS g FROM t)"""


def _mentions(spark, sf_dir):
    s = sentences.sentences(paragraphs(spark, sf_dir), ["slug", "seg", "speaker", "para"])
    s = s.withColumn("sentence", F.concat("sentence", F.when((F.col("slug") + F.col("seg")) % 3 == 0, F.lit(" small ring and red widget")).otherwise("")))
    return names.dictionary_mentions(s, _people(spark, sf_dir), ["slug", "seg", "para", "sent"])


@query("j23_mentions", MENTION + " SELECT slug, seg, para::INT AS para, sent::INT AS sent, pos::INT AS \"at\", g AS name FROM b WHERE g IN (SELECT p_name FROM part)")
def j23_mentions(spark, sf_dir):
    return _mentions(spark, sf_dir)


@query("a4_mentions_per_person", MENTION + " SELECT g AS name, count(*)::BIGINT AS mentions, count(DISTINCT slug)::BIGINT AS recordings FROM b WHERE g IN (SELECT p_name FROM part) GROUP BY g")
def a4_mentions_per_person(spark, sf_dir):
    return _mentions(spark, sf_dir).groupBy("name").agg(F.count("*").alias("mentions"), F.count_distinct("slug").alias("recordings"))


@query("m21_first_mentions", MENTION + ", h AS (SELECT slug, g AS name, seg, para, sent, pos, row_number() OVER (PARTITION BY slug, g ORDER BY seg, para, sent, pos) AS r FROM b WHERE g IN (SELECT p_name FROM part)) SELECT slug, name, seg, pos::INT AS \"at\" FROM h WHERE r = 1")
def m21_first_mentions(spark, sf_dir):
    place = F.struct("seg", "para", "sent", "at")
    return _mentions(spark, sf_dir).groupBy("slug", "name").agg(F.min(place).alias("p")).select("slug", "name", "p.seg", "p.at")


@query("a10_names_by_mentions", MENTION + ", c AS (SELECT slug, g AS name, count(*) AS n FROM b WHERE g IN (SELECT p_name FROM part) GROUP BY ALL) SELECT slug, name, n::BIGINT AS n, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY n DESC, name) AS rank FROM c) WHERE rank <= 25")
def a10_names_by_mentions(spark, sf_dir):
    from tessitura.operators.reports import top_per

    c = _mentions(spark, sf_dir).groupBy("slug", "name").agg(F.count("*").alias("n"))
    return top_per(c, ["slug"], [F.desc("n"), F.col("name")], 25)
