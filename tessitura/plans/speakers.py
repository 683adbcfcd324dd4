"""Queries of attribution and segments."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessitura.operators import attribution, voices

from .fixtures import EV, SEG, events, segments
from .registry import query, table


def _cs(c):
    return F.round(F.col(c) * 100).cast("long").alias(f"{c}_cs")


def _samples(spark, sf_dir):
    """A voice for each fifth of the types, a name read at two events of three."""
    return events(spark, sf_dir).select("slug", "idx", "t", F.col("kind").alias("voice"), F.when(F.col("idx") % 3 > 0, F.concat(F.lit("p"), (F.col("idx") % 2).cast("string"))).alias("name"))


SAMPLES = "sm AS (SELECT slug, idx, t, kind AS voice, CASE WHEN idx % 3 > 0 THEN 'p' || (idx % 2) END AS name FROM ev)"


@query(
    "v1_name_votes",
    f"""WITH {EV}, {SAMPLES}, n AS (SELECT slug, voice, name, count(*) AS votes FROM sm WHERE name IS NOT NULL GROUP BY ALL),
x AS (SELECT *, sum(votes) OVER (PARTITION BY slug, voice) AS readings, sum(votes) OVER (PARTITION BY slug) AS al, sum(votes) OVER (PARTITION BY slug, name) AS nm, row_number() OVER (PARTITION BY slug, voice ORDER BY votes DESC, name) AS k FROM n)
SELECT slug, voice, name, votes::BIGINT AS votes, readings::BIGINT AS readings, readings >= 8 AND votes / readings >= 0.75 AND votes / readings - nm / al >= 0.25 AS confirmed FROM x WHERE k = 1""",
)
def v1_name_votes(spark, sf_dir):
    return attribution.name_votes(_samples(spark, sf_dir))


@query(
    "v3_hints",
    """WITH h AS (SELECT user_id AS slug, event_type AS voice, CASE event_id % 4 WHEN 0 THEN 'introduction' WHEN 1 THEN 'match' WHEN 2 THEN 'role' ELSE 'title' END AS source, CASE WHEN value > 150 THEN 'n' || (event_id % 2) END AS name FROM events),
p AS (SELECT slug, voice, count(DISTINCT CASE WHEN source <> 'role' AND name IS NOT NULL THEN source END) AS s, count(DISTINCT CASE WHEN source <> 'role' THEN name END) AS n, min(CASE WHEN source <> 'role' THEN name END) AS st, min(CASE WHEN source = 'role' THEN name END) AS wk FROM h GROUP BY ALL),
q AS (SELECT *, CASE WHEN n = 1 AND s >= 2 THEN 'agree' WHEN n > 1 THEN 'disagree' WHEN n = 1 THEN 'single' WHEN wk IS NOT NULL THEN 'role' ELSE 'none' END AS status FROM p)
SELECT slug, voice, status, CASE WHEN status = 'role' THEN wk WHEN status <> 'disagree' THEN st END AS name FROM q""",
)
def v3_hints(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    source = F.element_at(F.array(*[F.lit(x) for x in ("introduction", "match", "role", "title")]), (F.col("event_id") % 4 + 1).cast("int"))
    h = e.select(F.col("user_id").alias("slug"), F.col("event_type").alias("voice"), source.alias("source"), F.when(F.col("value") > 150, F.concat(F.lit("n"), (F.col("event_id") % 2).cast("string"))).alias("name"))
    return attribution.resolve_hints(h, ["slug", "voice"])


@query(
    "v4_roles",
    f"""WITH {EV}, s AS (SELECT slug, kind AS voice, sum(value) AS s FROM ev GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY s DESC, voice) AS k, count(*) OVER (PARTITION BY slug) AS n, max(s) OVER (PARTITION BY slug) AS mx, min(s) OVER (PARTITION BY slug) AS mn FROM s)
SELECT slug, voice, round(s * 100)::BIGINT AS seconds_cs, CASE k WHEN 1 THEN 'interviewee' WHEN 2 THEN 'interviewer' ELSE 'other' END AS role, n = 2 AND mx >= 1.25 * mn AS confirmed FROM r""",
)
def v4_roles(spark, sf_dir):
    return attribution.roles_by_talk(events(spark, sf_dir).select("slug", F.col("kind").alias("voice"), F.col("value").alias("seconds"))).select("slug", "voice", _cs("seconds"), "role", "confirmed")


V5 = """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), u AS (SELECT vec_id, label, list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS v FROM e WHERE list_dot_product(v, v) > 0),
x AS (SELECT label, unnest(v) AS x, unnest(range(len(v))) AS i FROM u), s AS (SELECT label, i, sum(x) AS s, count(*) AS n FROM x GROUP BY ALL), c AS (SELECT label, list(s ORDER BY i) AS s, max(n) AS n FROM s GROUP BY label),
p AS (SELECT vec_id, u.label AS own, c.label, u.v, CASE WHEN c.label = u.label THEN list_transform(list_zip(c.s, u.v), lambda z: z[1] - z[2]) ELSE c.s END AS c FROM u, c WHERE c.label <> u.label OR c.n > 1),
d AS (SELECT vec_id, own, label, list_dot_product(v, c) / sqrt(list_dot_product(c, c)) AS s FROM p), r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS k, lead(s) OVER (PARTITION BY vec_id ORDER BY s DESC, label) AS nxt FROM d),
w AS (SELECT vec_id, own, max(s) FILTER (label = own) AS mine, max(s) FILTER (label <> own) AS other FROM d GROUP BY ALL),
t AS (SELECT own AS label, min(mine) AS lowest, any_value(o.s) AS others, min(mine - coalesce(other, 0)) AS clear FROM w JOIN (SELECT label, max(s) AS s FROM d WHERE label <> own GROUP BY label) o ON o.label = own WHERE mine IS NOT NULL GROUP BY own),
th AS (SELECT *, CASE WHEN lowest - others > 0.08 THEN round((lowest + others) / 2, 3) END AS threshold, CASE WHEN lowest - others > 0.08 THEN round(least(0.10, greatest(0.05, clear / 2)), 3) END AS gap FROM t)"""


@query("v5_voice_match", V5 + " SELECT vec_id, r.label AS best, round(s * 10000)::BIGINT AS similarity, s >= 0.5 AND s - coalesce(nxt, -1) >= 0.05 AS matched, threshold FROM r LEFT JOIN th ON r.label = th.label WHERE k = 1")
def v5_voice_match(spark, sf_dir):
    found = voices.voice_match(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return found.select("vec_id", "best", F.round(F.col("similarity") * 10000).cast("long").alias("similarity"), "matched", "threshold")


@query("v5_thresholds", V5 + " SELECT label, round(lowest * 10000)::BIGINT AS lowest, round(others * 10000)::BIGINT AS others, threshold, gap FROM th")
def v5_thresholds(spark, sf_dir):
    found = voices.voice_thresholds(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    return found.select("label", *[F.round(F.col(c) * 10000).cast("long").alias(c) for c in ("lowest", "others")], "threshold", "gap")


@query(
    "v6_fingerprints",
    f"""WITH {EV}, k AS (SELECT *, row_number() OVER (PARTITION BY slug, kind ORDER BY t, idx) AS k FROM ev)
SELECT slug, kind, sha1(string_agg(round_even(t * 100, 0)::BIGINT || '-' || round_even((t + value) * 100, 0)::BIGINT, ',' ORDER BY k)) AS fingerprint FROM k WHERE k <= 40 GROUP BY slug, kind""",
)
def v6_fingerprints(spark, sf_dir):
    """Events as turns of their kind."""
    e = events(spark, sf_dir).select("slug", F.col("kind").alias("voice"), "idx", F.col("t").alias("start"), (F.col("t") + F.col("value")).alias("end"))
    return attribution.decision_fingerprints(e).withColumnRenamed("voice", "kind")


BOUNDS = f"""WITH {EV}, {SAMPLES}, l AS (SELECT *, last_value(CASE WHEN name IS NOT NULL THEN t END IGNORE NULLS) OVER w AS lt, last_value(name IGNORE NULLS) OVER w AS ln FROM sm WINDOW w AS (PARTITION BY slug ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
f AS (SELECT slug, t, CASE WHEN t - lt <= 36000 THEN ln END AS name FROM l), g AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR name IS NOT DISTINCT FROM lag(name) OVER w THEN 0 ELSE 1 END AS nw FROM f WINDOW w AS (PARTITION BY slug ORDER BY t)),
r AS (SELECT slug, run, min(t) AS a, max(t) AS b, any_value(name) AS name FROM (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY t) AS run FROM g) GROUP BY ALL),
h AS (SELECT slug, a, b, CASE WHEN b - a < 7200 AND lag(name) OVER w = lead(name) OVER w THEN lag(name) OVER w ELSE name END AS name FROM r WINDOW w AS (PARTITION BY slug ORDER BY a)),
k AS (SELECT *, CASE WHEN row_number() OVER w = 1 OR name IS NOT DISTINCT FROM lag(name) OVER w THEN 0 ELSE 1 END AS nw FROM h WINDOW w AS (PARTITION BY slug ORDER BY a)), m AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY a) AS run FROM k)
"""


@query("v7_nametag_boundaries", BOUNDS + "SELECT slug, round(min(a) * 100)::BIGINT AS start_cs, round(max(b) * 100)::BIGINT AS end_cs, any_value(name) AS name FROM m GROUP BY slug, run")
def v7_nametag_boundaries(spark, sf_dir):
    return attribution.boundaries(_samples(spark, sf_dir).select("slug", "t", "name"), hold=36000.0, flicker=7200.0).select("slug", _cs("start"), _cs("end"), "name")


@query("v9_boundary_source", f"WITH {EV}, b AS (SELECT *, CASE kind WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS p FROM ev), m AS (SELECT slug, min(p) AS p FROM b GROUP BY slug) SELECT b.slug, idx, kind FROM b JOIN m USING (slug, p)")
def v9_boundary_source(spark, sf_dir):
    return attribution.by_priority(events(spark, sf_dir), "slug", "kind", ["purchase", "signup", "error"]).select("slug", "idx", "kind")


@query("v10_transcript_source", "WITH d AS (SELECT doc_id // 4 AS rec, doc_id, coalesce(CASE WHEN l.quality = 0 THEN 'override' END, lang) AS src FROM documents LEFT JOIN labels l USING (doc_id)), p AS (SELECT *, CASE src WHEN 'override' THEN 1 WHEN 'de' THEN 2 WHEN 'fr' THEN 3 ELSE 4 END AS p FROM d) SELECT rec, doc_id, src FROM p QUALIFY p = min(p) OVER (PARTITION BY rec)")
def v10_transcript_source(spark, sf_dir):
    lab = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 0, "override").alias("o"))
    d = table(spark, sf_dir, "documents").join(lab, "doc_id", "left").select(F.floor(F.col("doc_id") / 4).alias("rec"), "doc_id", F.coalesce("o", "lang").alias("src"))
    return attribution.by_priority(d, "rec", "src", ["override", "de", "fr"])


@query("t1_turns")
def t1_turns(spark, sf_dir):
    """Cues are events in the order of time; the speaker is whether the value is high."""
    e = events(spark, sf_dir).select("slug", "idx", F.when(F.col("value") > 40, "a").otherwise("b").alias("speaker"), F.col("t").alias("start"), (F.col("t") + F.col("value")).alias("end"), F.col("kind").alias("text"))
    return attribution.merge_turns(e, pause=3600.0, paragraph=14400.0).select("slug", "turn", "speaker", _cs("start"), _cs("end"), "cues", "text")


@query(
    "t1_turn_counts",
    f"""WITH {EV}, s AS (SELECT *, value > 40 AS sp FROM ev), g AS (SELECT *, CASE WHEN lag(sp) OVER w IS NULL OR sp = lag(sp) OVER w THEN 0 ELSE 1 END AS nw FROM s WINDOW w AS (PARTITION BY slug ORDER BY t, idx)),
r AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY t, idx) AS turn FROM g) SELECT slug, turn::BIGINT AS turn, CASE WHEN any_value(sp) THEN 'a' ELSE 'b' END AS speaker, count(*)::BIGINT AS cues, round(min(t) * 100)::BIGINT AS start_cs FROM r GROUP BY slug, turn""",
)
def t1_turn_counts(spark, sf_dir):
    return t1_turns(spark, sf_dir).select("slug", "turn", "speaker", "cues", "start_cs")


@query(
    "t2_shared_audio",
    f"""WITH {EV}, g AS (SELECT *, value > 40 AS sh FROM ev), n AS (SELECT *, CASE WHEN lag(sh) OVER w IS NULL OR sh = lag(sh) OVER w THEN 0 ELSE 1 END AS nw FROM g WINDOW w AS (PARTITION BY slug ORDER BY t, idx)), r AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY t, idx) AS run FROM n),
f AS (SELECT slug, run, min(t) AS a, any_value(sh) AS sh FROM r GROUP BY ALL) SELECT r.slug, idx, CASE WHEN f.sh THEN 'day ' || floor(f.a / 86400)::BIGINT ELSE kind END AS speaker FROM r JOIN f ON r.slug = f.slug AND r.run = f.run""",
)
def t2_shared_audio(spark, sf_dir):
    e = events(spark, sf_dir)
    turns = e.select("slug", "idx", F.col("t").alias("start"), F.concat(F.when(F.col("value") > 40, "Audio shared by ").otherwise(""), "kind").alias("speaker"))
    day = F.floor(F.col("t") / 86400)
    slots = e.select("slug", (day * 86400.0).alias("s_start"), F.concat(F.lit("day "), day.cast("string")).alias("presenter")).distinct()
    return attribution.presenter_of_runs(turns, slots).select("slug", "idx", "speaker")


@query(
    "t6_screen_shares",
    f"""WITH {EV}, n AS (SELECT *, CASE WHEN t - lag(t) OVER w > 36000 THEN 1 ELSE 0 END AS nw FROM ev WINDOW w AS (PARTITION BY slug ORDER BY t)), r AS (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY t) AS run FROM n),
k AS (SELECT slug, run, kind, count(*) AS n FROM r GROUP BY ALL), b AS (SELECT slug, run, arg_min(kind, (-n, kind)) AS name FROM k GROUP BY ALL)
SELECT slug, round(min(t) * 100)::BIGINT AS start_cs, round(max(t) * 100)::BIGINT AS end_cs, count(*)::BIGINT AS samples, any_value(name) AS name FROM r JOIN b USING (slug, run) GROUP BY slug, run HAVING max(t) - min(t) >= 7200""",
)
def t6_screen_shares(spark, sf_dir):
    found = attribution.share_runs(events(spark, sf_dir).select("slug", "t", F.col("kind").alias("name")), bridge=36000.0, least=7200.0)
    return found.select("slug", _cs("start"), _cs("end"), "samples", "name")


COARSE = SEG + """, cs AS (SELECT slug, seg, CASE WHEN seg // 3 % 2 = 0 THEN 'a' ELSE 'b' END AS speaker, start, "end" FROM seg), n AS (SELECT *, CASE WHEN lag(speaker) OVER w IS NULL OR speaker = lag(speaker) OVER w THEN 0 ELSE 1 END AS nw FROM cs WINDOW w AS (PARTITION BY slug ORDER BY start, seg)),
r AS (SELECT slug, run, min(start) AS a, max("end") AS b, any_value(speaker) AS speaker FROM (SELECT *, sum(nw) OVER (PARTITION BY slug ORDER BY start, seg) AS run FROM n) GROUP BY ALL), st AS (SELECT slug, a, coalesce(lead(a) OVER (PARTITION BY slug ORDER BY a), b) - a AS s, speaker FROM r)"""


def _coarse(spark, sf_dir):
    """Three turns at a time belong to one of two speakers."""
    return segments(spark, sf_dir).withColumn("speaker", F.when(F.floor(F.col("seg") / 3) % 2 == 0, "a").otherwise("b"))


@query("t7_long_stretches", f"WITH {COARSE} SELECT slug, (a * 100)::BIGINT AS start_cs, (s * 100)::BIGINT AS seconds_cs, speaker FROM st WHERE s >= 60 QUALIFY row_number() OVER (PARTITION BY slug ORDER BY s DESC, a) <= 40")
def t7_long_stretches(spark, sf_dir):
    return attribution.long_stretches(_coarse(spark, sf_dir), least=60.0).select("slug", _cs("start"), _cs("seconds"), "speaker")


@query("t8_presentation_index", f"WITH {COARSE}, l AS (SELECT DISTINCT slug, speaker, CASE WHEN slug % 4 = 0 THEN 7 END AS curated FROM cs), f AS (SELECT slug, speaker, min(a) AS a FROM st WHERE s >= 60 GROUP BY ALL) SELECT slug, speaker, coalesce(curated, a)::BIGINT AS start FROM l LEFT JOIN f USING (slug, speaker)")
def t8_presentation_index(spark, sf_dir):
    c = _coarse(spark, sf_dir)
    listed = c.select("slug", "speaker", F.when(F.col("slug") % 4 == 0, 7.0).alias("curated")).distinct()
    return attribution.presentation_index(listed, attribution.long_stretches(c, least=60.0)).withColumn("start", F.col("start").cast("long"))


@query(
    "t9_chapters",
    f"""WITH RECURSIVE {SEG}, p AS (SELECT slug, CASE WHEN seg // 3 % 2 = 0 THEN 'a' ELSE 'b' END AS title, min(start) AS t FROM seg GROUP BY ALL HAVING sum("end" - start) >= 60),
l AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY t, title) AS n FROM p), k(slug, n, idx, t, title) AS (SELECT DISTINCT slug, 0::BIGINT, 0, 0::DOUBLE, 'Introduction' FROM l
  UNION ALL SELECT l.slug, l.n, x.idx + 1, l.t, l.title FROM (SELECT k.slug, k.idx, min(l.n) AS n FROM k JOIN l ON l.slug = k.slug AND l.n > k.n AND l.t - k.t >= 15 GROUP BY k.slug, k.idx) x JOIN l USING (slug, n)),
c AS (SELECT *, count(*) OVER (PARTITION BY slug) AS m FROM k) SELECT slug, idx, t::BIGINT AS start, title FROM c WHERE m >= 2""",
)
def t9_chapters(spark, sf_dir):
    return attribution.chapters(_coarse(spark, sf_dir), fewest=2).withColumn("start", F.col("start").cast("long"))


@query(
    "t5_captions",
    f"""WITH {SEG}, x AS (SELECT slug, seg, start, "end", regexp_replace(text, '\\s+', ' ', 'g') AS text FROM seg), y AS (SELECT *, least("end" - start, length(text) / 12.5::DOUBLE + 0.5) AS d, string_split(trim(text), ' ') AS w FROM x),
z AS (SELECT *, greatest(ceil(length(text) / 82::DOUBLE), ceil(d / 6), 1)::BIGINT AS n FROM y), p AS (SELECT *, unnest(range(n)) AS piece FROM z),
q AS (SELECT slug, seg, piece, start + d * piece / n AS s, start + d * (piece + 1) / n AS e, array_to_string(w[floor(piece * len(w) / n::DOUBLE)::BIGINT + 1:floor((piece + 1) * len(w) / n::DOUBLE)::BIGINT], ' ') AS text FROM p),
t AS (SELECT *, greatest(e, s + 1) AS f, lead(s) OVER (PARTITION BY slug ORDER BY s, piece) AS nxt FROM q WHERE text <> '')
SELECT slug, seg, piece::INT AS piece, round(s * 100)::BIGINT AS start_cs, round(least(f, coalesce(nxt, f)) * 100)::BIGINT AS end_cs, text FROM t""",
)
def t5_captions(spark, sf_dir):
    pieces = attribution.caption_pieces(segments(spark, sf_dir).withColumn("text", F.regexp_replace("text", r"\s+", " ")), ["slug", "seg"])
    return attribution.tidy_captions(pieces, "slug").select("slug", "seg", "piece", _cs("start"), _cs("end"), "text")


T10 = (
    r"""WITH RECURSIVE t AS (SELECT doc_id AS slug, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS ws FROM documents)),
s AS ("""
    + " UNION ALL ".join(f"SELECT slug, {n} AS n, i, w IS NOT DISTINCT FROM lead(w, {n}) OVER (PARTITION BY slug ORDER BY i) AS same FROM t" for n in range(1, 9))
    + """), r AS (SELECT *, min(CASE WHEN NOT same THEN i END) OVER (PARTITION BY slug, n ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) - i AS same_for FROM s),
c AS (SELECT slug, i, n, 1 + same_for // n AS k FROM r WHERE same), q AS (SELECT * FROM c WHERE k >= CASE WHEN n <= 2 THEN 8 ELSE 4 END),
b AS (SELECT slug, i, arg_max(n, (k * n, -n)) AS n, max(k * n) AS cover FROM q GROUP BY slug, i),
g(slug, i, n, cover) AS (SELECT slug, min(i), arg_min(n, i), arg_min(cover, i) FROM b GROUP BY slug UNION ALL SELECT g.slug, min(b.i), arg_min(b.n, b.i), arg_min(b.cover, b.i) FROM g JOIN b ON b.slug = g.slug AND b.i >= g.i + g.cover GROUP BY g.slug)
SELECT slug, n::INT AS n, i::BIGINT AS first, (i + cover - 1)::BIGINT AS last, (cover // n)::INT AS repeats FROM g"""
)


@query("t10_loops", T10)
def t10_loops(spark, sf_dir):
    """Words are documents' tokens without punctuation."""
    w = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("slug"), F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+"), F.lit(0)).alias("words"))
    return attribution.loop_spans_of_lists(w)
