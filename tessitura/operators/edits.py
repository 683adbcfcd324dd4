"""Human decisions: text edits, fixes, suggestions, addresses, decisions that have gone stale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .names import ratcliff_ratio, ratio_bound
from .timejoins import interval_join


def normal_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def apply_edits(paragraphs: DataFrame, edits: DataFrame, key: str, rounds: int = 1) -> tuple[DataFrame, DataFrame]:
    """paragraphs(key, seg, para, start, text) with edits(key, edit, t, old, new) applied, and the stale edits.

    An edit goes to the paragraph that equals its old text, the nearest in time of several; of several edits of one
    paragraph the last in order counts. rounds follows edits of what an edit made.
    """
    done, open_ = paragraphs, edits
    for _ in range(rounds):
        p = done.select(F.col(key).alias("_k"), F.sha2("text", 256).alias("_h"), "seg", "para", "start", F.col("text").alias("_text"))
        pairs = open_.join(p, (F.col(key) == F.col("_k")) & (F.sha2("old", 256) == F.col("_h")) & (F.col("old") == F.col("_text")))
        near = pairs.groupBy(key, "edit").agg(F.min_by(F.struct("seg", "para", "new"), F.struct(F.abs(F.col("start") - F.col("t")), "seg", "para")).alias("b"))
        last = near.groupBy(key, F.col("b.seg").alias("seg"), F.col("b.para").alias("para")).agg(F.max_by("b.new", "edit").alias("_new"))
        done = done.join(last, [key, "seg", "para"], "left").withColumn("text", F.coalesce("_new", "text")).drop("_new")
        open_ = open_.join(near.select(key, "edit"), [key, "edit"], "left_anti")
    return done, open_


def place_suggestions(suggestions: DataFrame, paragraphs: DataFrame, key: str, prefix: int = 40, least: float = 0.92, within: float = 180.0) -> DataFrame:
    """(key, sid, seg, para, tier): where a passage stands: a paragraph equal to it (1), one that begins with so many of its
    characters (2), or one close to it in text and time (3); the nearest in time of the best tier."""
    s = suggestions.withColumn("_o", normal_text(F.col("old")))
    p = paragraphs.select(F.col(key).alias("_k"), "seg", "para", "start", normal_text(F.col("text")).alias("_p"))
    out = lambda pairs, tier: pairs.select(key, "sid", "seg", "para", F.abs(F.col("start") - F.col("t")).alias("gap"), F.lit(tier).alias("tier"))
    same = (F.col(key) == F.col("_k"))
    exact = out(s.join(p, same & (F.col("_o") == F.col("_p"))), 1)
    head = out(s.where(F.length("_o") >= prefix).join(p, same & (F.left("_o", F.lit(prefix)) == F.left("_p", F.lit(prefix)))), 2)
    rest = s.join(exact.union(head).select("sid").distinct(), "sid", "left_anti")
    slot = lambda c: F.floor(c / within)
    near = rest.withColumn("_b", F.explode(F.sequence(slot(F.col("t") - within), slot(F.col("t") + within)))).hint("merge").join(p.withColumn("_pb", slot(F.col("start"))).hint("merge"), same & (F.col("_b") == F.col("_pb")))
    near = near.where((F.abs(F.col("start") - F.col("t")) <= within) & (ratio_bound(F.col("_o"), F.col("_p")) >= least)).withColumn("_r", ratcliff_ratio("_o", "_p")).where(F.col("_r") >= least)
    found = exact.union(head).union(out(near, 3))
    return found.groupBy(key, "sid").agg(F.min(F.struct("tier", "gap", "seg", "para")).alias("b")).select(key, "sid", "b.seg", "b.para", "b.tier")


def diff_turns(edited: DataFrame, corpus: DataFrame, key: str, drift: float = 5.0) -> DataFrame:
    """edited and corpus(key, turn, speaker, start, text) by position: (key, turn, change), and a row with a null turn where
    the numbers of turns differ or a start drifts too far, which rules the recording out."""
    a = edited.select(key, "turn", F.col("speaker").alias("s1"), F.col("start").alias("t1"), F.col("text").alias("x1"), F.lit(True).alias("in1"))
    b = corpus.select(key, "turn", F.col("speaker").alias("s2"), F.col("start").alias("t2"), F.col("text").alias("x2"), F.lit(True).alias("in2"))
    j = a.join(b, [key, "turn"], "full")
    bad = j.groupBy(key).agg(F.bool_or(F.col("in1").isNull() | F.col("in2").isNull() | (F.abs(F.col("t1") - F.col("t2")) > drift)).alias("bad"))
    paras = lambda c: F.size(F.split(c, "\n\n"))
    listed = F.array_compact(F.array(F.when(~F.col("s1").eqNullSafe(F.col("s2")), "speaker"), F.when(F.col("x1") != F.col("x2"), "text"), F.when(paras("x1") != paras("x2"), "paragraphs")))
    diffs = j.join(bad.where("not bad"), key).select(key, "turn", F.explode(listed).alias("change"))
    return diffs.union(bad.where("bad").select(key, F.lit(None).cast(diffs.schema["turn"].dataType), F.lit("rejected")))


def redirects(pages: DataFrame, old: str, new: str) -> DataFrame:
    """pages(old, new) to the rows that need a redirect: addresses that changed and that no live page has now."""
    live = pages.select(F.col(new).alias("_live")).distinct()
    return pages.where(F.col(old) != F.col(new)).join(live, F.col(old) == F.col("_live"), "left_anti").select(old, new, F.lit(301).alias("code")).distinct()


def upsert_decisions(store: DataFrame, saved: DataFrame, key: str) -> DataFrame:
    """store(key, machine, value) with saved(key, machine, value): back to the machine's value deletes, a known key is
    updated, another inserted; written to a new version by the caller."""
    s = saved.select(F.col(key).alias("_k"), F.col("machine").alias("_m"), F.col("value").alias("_v"))
    j = store.join(s, F.col(key) == F.col("_k"), "full")
    merged = j.select(F.coalesce(key, "_k").alias(key), F.coalesce("_m", "machine").alias("machine"), F.coalesce("_v", "value").alias("value"))
    return merged.where("value <> machine")


def pending_suggestions(suggestions: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """suggestions(key, sid, old, count) with ready, or stale if the text is no longer there; most requested first."""
    c = current.select(F.col(key).alias("_k"), F.sha2("text", 256).alias("_h")).distinct()
    j = suggestions.join(c, (F.col(key) == F.col("_k")) & (F.sha2("old", 256) == F.col("_h")), "left")
    return j.select(*suggestions.columns, F.when(F.col("_k").isNull(), "stale").otherwise("ready").alias("state")).orderBy(F.desc("count"), "sid")


CLIP = "struct<a:double,b:double>"
# A clip's seconds, and for each tier the shortest turn, the lead, whether others may talk, and the spacing.
CLIP_SECONDS, CLEAN = 9.0, 0.15
TIERS = ((5.0, 0.4, False, 300.0), (5.0, 0.4, True, 30.0), (1.0, -0.3, True, 20.0))


def pick_clips(turns: DataFrame, key: str, most: int = 3, clip: float = CLIP_SECONDS, width: float = 30.0) -> DataFrame:
    """turns(key, voice, start, end) to (key, voice, start, end): up to so many stretches in which a voice is heard alone, from
    its longest turns on, the later of equals first.

    First clips of turns of 5 s or more, in which others talk 15 % at most, over 300 s apart; if they are too few, whoever
    talks, over 30 s apart; if there is none at all, whole turns of 1 s or more, over 20 s apart. What others say in a clip is
    an interval join; the choice is a fold over a voice's sorted turns, in the row.
    """
    t = turns.select(key, "voice", "start", "end", F.xxhash64("voice", "start", "end").alias("_id")).distinct()
    length = F.col("end") - F.col("start")
    own = t.where(length >= TIERS[0][0]).withColumn("a", F.col("start") + TIERS[0][1]).withColumn("b", F.least("end", F.col("start") + TIERS[0][1] + clip))
    others = turns.select(key, F.col("voice").alias("o_voice"), F.col("start").alias("o_start"), F.col("end").alias("o_end"))
    met = interval_join(own, others, key, width, ("a", "b"), ("o_start", "o_end")).where(~F.col("voice").eqNullSafe(F.col("o_voice")))
    talk = met.groupBy(key, "_id").agg(F.sum(F.least("b", "o_end") - F.greatest("a", "o_start")).alias("talk"))
    rows = t.join(talk.hint("merge"), [key, "_id"], "left").withColumn("_l", length)
    item = F.struct((-F.col("_l")).alias("l"), (-F.col("start")).alias("s"), F.col("start").alias("start"), F.col("end").alias("end"), F.coalesce("talk", F.lit(0.0)).alias("talk"))
    grouped = rows.groupBy(key, "voice").agg(F.array_sort(F.collect_list(item)).alias("turns"))  # one voice's turns in one recording

    def chosen(kept: Column, least: float, lead: float, any_talk: bool, spacing: float) -> Column:
        def step(k: Column, x: Column) -> Column:
            if lead > 0:
                a, b = x["start"] + lead, F.least(x["end"], x["start"] + lead + clip)
            else:
                a, b = F.greatest(x["start"] + lead, F.lit(0.0)), x["end"] - lead
            fits = (F.size(k) < most) & (-x["l"] >= least) & F.forall(k, lambda c: F.abs(c["a"] - a) > spacing)
            if not any_talk:
                fits = fits & (x["talk"] <= CLEAN * (b - a))
            return F.when(fits, F.concat(k, F.array(F.struct(a.alias("a"), b.alias("b")).cast(CLIP)))).otherwise(k)

        return F.aggregate("turns", kept, step)

    found = grouped.withColumn("k", chosen(F.array().cast(f"array<{CLIP}>"), *TIERS[0]))
    found = found.withColumn("k", F.when(F.size("k") < most, chosen(F.col("k"), *TIERS[1])).otherwise(F.col("k")))
    found = found.withColumn("k", F.when(F.size("k") == 0, chosen(F.col("k"), *TIERS[2])).otherwise(F.col("k")))
    return found.select(key, "voice", F.explode("k").alias("c")).select(key, "voice", F.col("c.a").alias("start"), F.col("c.b").alias("end"))
