"""Queries of the text-cleaning rules and of tokens and sentences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.operators import clean, phrases, sentences

from .fixtures import EV, SEG, SENT, events, paragraphs, segments, suffixed, with_suffix
from .registry import query, table



def _rule(name, suffix, rule, sql=None):
    """Register a rule over all documents, each with a suffix that it must change; sql makes (doc_id, text) from d(doc_id, t)."""

    @query(name, f"WITH {suffixed(suffix)} {sql}" if sql else None)
    def run(spark, sf_dir):
        return with_suffix(spark, sf_dir, suffix).select("doc_id", rule(F.col("text")).alias("text"))


def _list(words):
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _alternating(word: str) -> str:
    """d as rows of words and what stands between them: tok(doc_id, i, w)."""
    return f"tok AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[{word}]+|[^{word}]+') AS ws FROM d))"


TIDY = r"regexp_replace(trim(regexp_replace({0}, '\s{{2,}}', ' ', 'g')), '\s+([,.!?])', '\1', 'g')"
SPACES = r"trim(regexp_replace(regexp_replace({0}, '[ \t]{{2,}}', ' ', 'g'), '[ \t]+([.!?,;:])', '\1', 'g'), ' ')"
_rule("x1_strip_fillers", " Uh, I um think , that uhh works .", clean.strip_fillers, "SELECT doc_id, " + TIDY.format("replace(t, ' Uh, I um think , that uhh works .', ' I think , that works .')") + " AS text FROM d")
_rule("x2_remove_fillers", " Um, so it was, uh, fine. uh-huh um", clean.remove_fillers)
_rule(
    "x3_collapse_stutters",
    " So so the The plan, bye bye and and and on",
    clean.collapse_stutters,
    ", "
    + _alternating(r"\p{L}\p{M}\p{N}_''")
    + f""", k AS (SELECT *, lag(w) OVER o AS gap, lag(w, 2) OVER o AS b FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT *, lower(w) = lower(b) AND regexp_full_match(gap, '[ \\t]+') AND lower(w) IN ({_list(clean.STUTTER_WORDS)}) AS again FROM k),
s AS (SELECT *, coalesce(again, false) OR coalesce(lead(again) OVER (PARTITION BY doc_id ORDER BY i), false) AND regexp_full_match(w, '[ \\t]+') AS gone FROM r)
SELECT doc_id, string_agg(w, '' ORDER BY i) FILTER (NOT gone) AS text FROM s GROUP BY doc_id""",
)
_rule("x4_remove_non_latin", " a 나무ish and кто things  .", clean.remove_non_latin, "SELECT doc_id, " + SPACES.format("regexp_replace(t, '[가-힣一-鿿぀-ヿЀ-ӿ]+', '', 'g')") + " AS text FROM d")
_rule(
    "x7_products",
    " My Ipad and wordpress, at instagram.com/x or @youtube with ai and open ai, chat gpt, GPT 4.",
    lambda c: clean.fix_products(clean.fix_ai_terms(c)),
    # The documents' French holds the word ai, which the rule writes as AI too. Of a row of them the first pass takes every
    # other one, whose blank the next one needs; the second takes the rest, so it must pass over what is written already.
    r"""SELECT doc_id, regexp_replace(regexp_replace(replace(t, ' My Ipad and wordpress, at instagram.com/x or @youtube with ai and open ai, chat gpt, GPT 4.',
  ' My iPad and WordPress, at instagram.com/x or @youtube with AI and OpenAI, ChatGPT, GPT-4.'), '(^|[^\p{L}\p{M}\p{N}_])(?:ai|aI|Ai)($|[^\p{L}\p{M}\p{N}_])', '\1AI\2', 'g'), '(^|[^\p{L}\p{M}\p{N}_])(?:ai|aI|Ai)($|[^\p{L}\p{M}\p{N}_])', '\1AI\2', 'g') AS text FROM d""",
)
_rule(
    "x8_articles",
    " a artist, an painting, a hour, a one, an nft, a aren't",
    clean.fix_articles,
    ", "
    + _alternating(r"\p{L}\p{M}\p{N}_")
    + rf""", k AS (SELECT *, regexp_full_match(lead(w) OVER o, ' +') AS near, lead(w, 2) OVER o AS n, lower(lead(w, 2) OVER o || coalesce(lead(w, 3) OVER o, '') || coalesce(lead(w, 4) OVER o, '')) AS ap FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY i))
SELECT doc_id, string_agg(CASE WHEN near AND w IN ('a', 'A') AND regexp_full_match(n, '(?i)([aeio][a-z]|hour|honest|honor|honour|heir)[a-z]*')
  AND lower(n) NOT IN ({_list(w for w in clean.FALSE_START if "'" not in w)}, 'one', 'once', 'ones', 'ewe', 'oui') AND lower(n) NOT LIKE 'eu%' AND ap <> 'aren''t' THEN w || 'n'
  WHEN near AND w IN ('an', 'An') AND regexp_full_match(n, '[bcdfgjklmnpqrstvwxz][a-z]{{2,}}') AND regexp_matches(n, '[aeiouy]') AND n NOT IN ({_list(clean.ACRONYMS)}) THEN left(w, 1)
  ELSE w END, '' ORDER BY i) AS text FROM k GROUP BY doc_id""",
)
NAMES = [(r"\bMira Veldt\b", "Mira Feldt"), (r"\bOto Lindqist\b", "Otto Lindqvist")]
_rule("x9_names", " by mira veldt and Oto Lindqist", lambda c: clean.fix_names(c, NAMES), "SELECT doc_id, replace(t, ' by mira veldt and Oto Lindqist', ' by Mira Feldt and Otto Lindqvist') AS text FROM d")
_rule("x10_punctuation", " What.. now,, then... end . . . ok", clean.fix_punctuation, "SELECT doc_id, regexp_replace(replace(t, ' What.. now,, then... end . . . ok', ' What. now, then... end … ok'), ',{2,}', ',', 'g') AS text FROM d")
MAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_rule(
    "x11_spell_out_emails",
    " Write to Ann.Lee@Big-Host.COM now",
    clean.spell_out_emails,
    rf""", m AS (SELECT doc_id, string_split_regex(t, '{MAIL}') AS p, regexp_extract_all(t, '{MAIL}') AS e FROM d),
x AS (SELECT doc_id, unnest(p) AS p, unnest(list_concat(e, [''])) AS e, unnest(range(len(p))) AS i FROM m)
SELECT doc_id, string_agg(p || CASE WHEN e = '' THEN '' ELSE split_part(e, '@', 1) || ' at ' || lower(regexp_extract(e, '@(.*)\.[^.]*$', 1)) || ' dot ' || lower(regexp_extract(e, '\.([^.]*)$', 1)) END, '' ORDER BY i) AS text FROM x GROUP BY doc_id""",
)
_rule("x12_decades", " In the 19 sixties and 1970s and eighties, 19 hundreds.", clean.fix_decades, "SELECT doc_id, replace(t, ' In the 19 sixties and 1970s and eighties, 19 hundreds.', ' In the 1960s and 70s and eighties, 1900s.') AS text FROM d")
_rule("x14_capitals", " i saw london tower. then london fell", lambda c: clean.capitalize_terms(c, ["London Tower", "London"]), r"""
, e AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(?i)(^|[^\p{L}\p{M}\p{N}_])london tower($|[^\p{L}\p{M}\p{N}_])', '\1London Tower\2', 'g'), '(?i)(^|[^\p{L}\p{M}\p{N}_])london($|[^\p{L}\p{M}\p{N}_])', '\1London\2', 'g') AS t FROM d),
f AS (SELECT doc_id, regexp_replace(regexp_replace(t, '(^|[^\p{L}\p{M}\p{N}_])i($|[^\p{L}\p{M}\p{N}_])', '\1I\2', 'g'), '(^|[^\p{L}\p{M}\p{N}_])i($|[^\p{L}\p{M}\p{N}_])', '\1I\2', 'g') AS t FROM e),
g AS (SELECT doc_id, string_split_regex(t, '(?:^|[.!?]\s+|\n\s*)[a-z]') AS parts, regexp_extract_all(t, '(?:^|[.!?]\s+|\n\s*)[a-z]') AS ms FROM f)
SELECT doc_id, array_to_string([parts[i] || coalesce(left(ms[i], length(ms[i]) - 1) || upper(right(ms[i], 1)), '') FOR i IN range(1, len(parts) + 1)], '') AS text FROM g""")
_rule("x16_continuation", "", lambda c: clean.lower_continuation(c, ("the", "that", "and", "in", "of")), r"SELECT doc_id, CASE WHEN regexp_matches(t, '^(The|That|And|In|Of)($|[^\p{L}\p{M}\p{N}_''])') THEN lower(left(t, 1)) || substr(t, 2) ELSE t END AS text FROM d")


def _phrases(spark, sf_dir):
    """The first three words of each benchmark text, in the order of their letters."""
    p = table(spark, sf_dir, "benchmark").select(F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("phrase")).where("length(phrase) > 6").distinct()
    return p.withColumn("replacement", F.upper("phrase")).withColumn("ord", F.lit(0))


PHRASES = "ph AS (SELECT DISTINCT p FROM (SELECT array_to_string(string_split(text, ' ')[1:3], ' ') AS p FROM benchmark) WHERE length(p) > 6)"


@query("x5_vocabulary", f"WITH {PHRASES}, l AS (SELECT list(p ORDER BY p) AS ps FROM ph) SELECT doc_id, list_reduce(list_concat([text], ps), lambda a, p: regexp_replace(a, '(?i)' || regexp_escape(p), upper(p), 'g')) AS text FROM documents, l")
def x5_vocabulary(spark, sf_dir):
    return phrases.replace_phrases(table(spark, sf_dir, "documents").select("doc_id", "text"), _phrases(spark, sf_dir), "doc_id")


@query("x13_titles", f"WITH {PHRASES} SELECT p AS phrase, coalesce(sum(len(regexp_extract_all(text, '(?i)' || regexp_escape(p)))), 0)::BIGINT AS hits, count(*) FILTER (regexp_matches(text, '(?i)' || regexp_escape(p)))::BIGINT AS texts FROM ph, documents GROUP BY p")
def x13_titles(spark, sf_dir):
    return phrases.count_phrases(table(spark, sf_dir, "documents"), _phrases(spark, sf_dir), "doc_id")


@query(
    "x15_midsentence_capitals",
    r"""WITH tok AS (SELECT doc_id, unnest(ws) AS tok, unnest(range(len(ws))) AS idx FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents)),
b AS (SELECT *, trim(tok, '"''“”‘’()[]_.,;:!?…-') AS bare FROM tok),
c AS (SELECT *, CASE WHEN regexp_full_match(bare, '[A-Za-z''’-]+') THEN bare ELSE '' END AS core, right(rtrim(tok, '''’)]'), 1) IN ('.', '?', '!', '…', ':', '”', '"') AS fin FROM b),
f AS (SELECT *, coalesce(lag(fin) OVER o, true) AS first, lag(core) OVER o AS prev FROM c WINDOW o AS (PARTITION BY doc_id ORDER BY idx)),
s AS (SELECT *, sum(first::INT) OVER (PARTITION BY doc_id ORDER BY idx) AS sentence, (regexp_matches(core, '^[A-Z]') AND core <> 'I' AND NOT first)::INT AS cap FROM f),
n AS (SELECT *, sum(cap) OVER (PARTITION BY doc_id, sentence ORDER BY idx RANGE BETWEEN 3 PRECEDING AND 3 FOLLOWING) - cap AS near FROM s)
SELECT doc_id, idx::INT AS idx, core AS word FROM n WHERE NOT first AND near = 0 AND regexp_full_match(core, '[A-Z][a-z''’-]*[a-z][a-z''’-]*')
AND prev IN ("""
    + _list(clean.CONTINUERS)
    + ") AND lower(core) NOT IN ("
    + _list(clean.KEEP_CAPITAL)
    + ") AND lower(core) IN (SELECT lower(array_to_string(string_split(text, ' ')[1:1], '')) FROM benchmark UNION SELECT unnest(string_split(lower(text), ' ')) FROM benchmark)",
)
def x15_midsentence_capitals(spark, sf_dir):
    ordinary = table(spark, sf_dir, "benchmark").select(F.explode(F.split(F.lower("text"), " ")).alias("word")).distinct()
    return clean.midsentence_capitals(table(spark, sf_dir, "documents"), ordinary, "doc_id")


@query(
    "x17_restore_punctuation",
    f"""WITH {EV}, g AS (SELECT *, lead(t) OVER o - t AS gap, t - lag(t) OVER o AS after FROM ev WINDOW o AS (PARTITION BY slug ORDER BY t, idx)),
p AS (SELECT *, sum(CASE WHEN after >= 7200 THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY t, idx) AS para FROM g)
SELECT slug, para::BIGINT AS para, round(min(t) * 100)::BIGINT AS start_cs,
string_agg(CASE WHEN after IS NULL OR after >= 1800 THEN upper(left(kind, 1)) || substr(kind, 2) ELSE kind END || CASE WHEN gap IS NULL OR gap >= 1800 THEN '.' ELSE '' END, ' ' ORDER BY t, idx) AS text FROM p GROUP BY slug, para""",
)
def x17_restore_punctuation(spark, sf_dir):
    words = events(spark, sf_dir).select("slug", "idx", F.col("t").alias("start"), F.col("kind").alias("text"))
    found = clean.restore_punctuation(words, sentence_pause=1800, paragraph_pause=7200)
    return found.select("slug", "para", F.round(F.col("start") * 100).cast("long").alias("start_cs"), "text")


@query(
    "w1_tokens",
    r"""WITH t AS (SELECT doc_id, unnest(ws) AS token, unnest(range(len(ws))) AS idx FROM (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents))
SELECT doc_id, idx::INT AS idx, token, coalesce(sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS at FROM t""",
)
def w1_tokens(spark, sf_dir):
    return sentences.tokens(table(spark, sf_dir, "documents"), ["doc_id"])


@query("w2_sentences", f"WITH {SENT} SELECT slug, seg, para::INT AS para, sent::INT AS sent, sentence FROM sent")
def w2_sentences(spark, sf_dir):
    return sentences.sentences(paragraphs(spark, sf_dir), ["slug", "seg", "para"])


@query("w3_time_at", "SELECT o_orderkey AS k, (CASE WHEN f <= 0.2 THEN 10 WHEN f <= 0.5 THEN round(10 + 30 * (f - 0.2) / 0.3, 2) WHEN f <= 0.9 THEN round(60 + 40 * (f - 0.5) / 0.4, 2) ELSE 100 END * 100)::BIGINT AS cs FROM (SELECT o_orderkey, (o_orderkey % 100) / 100::DOUBLE AS f FROM orders)")
def w3_time_at(spark, sf_dir):
    tmap = F.array(*[F.struct(F.lit(f).alias("frac"), F.lit(s).alias("sec")) for f, s in ((0.2, 10.0), (0.5, 40.0), (0.5, 60.0), (0.9, 100.0))])
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.round(F.round(sentences.time_at(tmap, F.col("o_orderkey") % 100 / F.lit(100.0)), 2) * 100).cast("long").alias("cs"))


@query(
    "w4_sentence_times",
    f"""WITH {SENT}, l AS (SELECT *, length(sentence) AS n, sum(length(sentence) + 1) OVER (PARTITION BY slug, seg, para) - 1 AS total,
coalesce(sum(length(sentence) + 1) OVER (PARTITION BY slug, seg, para ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sent)
SELECT slug, seg, para::INT AS para, sent::INT AS sent, sentence, round((start + (start + 30 - start) * (before / greatest(total, 1))) * 100)::BIGINT AS start_cs FROM l""",
)
def w4_sentence_times(spark, sf_dir):
    rows = paragraphs(spark, sf_dir).withColumn("end", F.col("start") + 30)
    return sentences.sentence_times(rows, ["slug", "seg", "para"])


@query(
    "w4_mapped_times",
    f"""WITH {SENT}, l AS (SELECT *, sum(length(sentence) + 1) OVER (PARTITION BY slug, seg, para) - 1 AS total, coalesce(sum(length(sentence) + 1) OVER (PARTITION BY slug, seg, para ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sent),
p AS (SELECT *, before / greatest(total, 1) AS f FROM l), t AS (SELECT *, CASE WHEN sent = 0 OR seg % 3 = 0 THEN start WHEN f <= 0.5 THEN start + 2 + (20 - 2) * f / 0.5 ELSE start + 20 + (10 - 20) * (f - 0.5) / 0.5 END AS t FROM p)
SELECT slug, seg, para::INT AS para, sent::INT AS sent, sentence, round(max(t) OVER (PARTITION BY slug, seg, para ORDER BY sent) * 100)::BIGINT AS start_cs FROM t""",
)
def w4_mapped_times(spark, sf_dir):
    """Maps that rise to the middle and fall after it, so that times must be held; every third segment has none."""
    at = lambda f, s: F.struct(F.lit(f).alias("frac"), (F.col("start") + s).alias("sec"))
    rows = paragraphs(spark, sf_dir).withColumn("tmap", F.when(F.col("seg") % 3 != 0, F.array(at(0.0, 2.0), at(0.5, 20.0), at(1.0, 10.0))))
    return sentences.sentence_times_by_map(rows, ["slug", "seg", "para"])


@query(
    "w6_bigrams",
    r"""WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS ws FROM documents), t AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS idx FROM w),
g AS (SELECT doc_id, idx, w || ' ' || lead(w) OVER (PARTITION BY doc_id ORDER BY idx) AS gram FROM t) SELECT doc_id, idx::INT AS idx, gram FROM g WHERE gram IS NOT NULL""",
)
def w6_bigrams(spark, sf_dir):
    return sentences.ngrams(table(spark, sf_dir, "documents"), ["doc_id"], 2)


@query(
    "w7_spread_words",
    rf"""WITH {SEG}, w AS (SELECT slug, seg, start, regexp_extract_all(text, '\S+') AS ws FROM seg), t AS (SELECT slug, seg, start, len(ws) AS n, unnest(ws) AS token, unnest(range(len(ws))) AS idx FROM w)
SELECT slug, seg, idx::INT AS idx, token, round((start + greatest(0.35::DOUBLE * n, 1) * idx / n) * 100)::BIGINT AS start_cs FROM t""",
)
def w7_spread_words(spark, sf_dir):
    cues = segments(spark, sf_dir).withColumn("end", F.lit(None).cast("double"))
    return sentences.spread_words(cues, ["slug", "seg"]).select("slug", "seg", "idx", "token", F.round(F.col("start") * 100).cast("long").alias("start_cs"))
