"""Who speaks: votes of samples, hints, voice vectors, boundaries and sources in their order of trust."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessitura.functions.tables import written

from .names import ratcliff_ratio
from .sentences import ABBREVIATIONS, SENTENCE_END
from .timejoins import asof_last, runs

# Hint sources whose agreement decides.
STRONG = ("introduction", "match", "title")
#: Words that are searched for loops at once; a longer text is searched alone.
LOOP_WORDS = 1 << 18


def name_votes(samples: DataFrame, key: str = "slug", least: int = 8, share: float = 0.75, lift: float = 0.25) -> DataFrame:
    """samples(key, voice, name) to (key, voice, name, votes, readings, confirmed): a voice's most read name (first by name
    of equals), confirmed by enough readings, share, and lift over the name's share in the whole recording."""
    n = samples.where("name is not null").groupBy(key, "voice", "name").agg(F.count("*").alias("votes"))
    v, r = Window.partitionBy(key, "voice"), Window.partitionBy(key)
    n = n.withColumn("readings", F.sum("votes").over(v)).withColumn("_all", F.sum("votes").over(r)).withColumn("_name", F.sum("votes").over(Window.partitionBy(key, "name")))
    top = n.withColumn("_k", F.row_number().over(v.orderBy(F.desc("votes"), "name"))).where("_k = 1")
    part = F.col("votes") / F.col("readings")
    return top.select(key, "voice", "name", "votes", "readings", ((F.col("readings") >= least) & (part >= share) & (part - F.col("_name") / F.col("_all") >= lift)).alias("confirmed"))


def resolve_hints(hints: DataFrame, key: Sequence[str], strong: Sequence[str] = STRONG) -> DataFrame:
    """hints(key, source, name) to (key, status, name): strong sources agree or disagree, one of any kind, a role, none."""
    named = F.col("name").isNotNull()
    is_strong = F.col("source").isin(*strong) & named
    per = hints.groupBy(*key).agg(
        F.count_distinct(F.when(is_strong, F.col("source"))).alias("sources"),
        F.count_distinct(F.when(is_strong, F.col("name"))).alias("names"),
        F.min(F.when(is_strong, F.col("name"))).alias("strong"),
        F.min(F.when(named & ~F.col("source").isin(*strong), F.col("name"))).alias("weak"),
    )
    status = F.when((F.col("names") == 1) & (F.col("sources") >= 2), "agree").when(F.col("names") > 1, "disagree").when(F.col("names") == 1, "single").when(F.col("weak").isNotNull(), "role").otherwise("none")
    return per.select(*key, status.alias("status"), F.when(status == "role", F.col("weak")).when(status != "disagree", F.col("strong")).alias("name"))


def combine_names(first: DataFrame, second: DataFrame, keys: Sequence[str], alike: float = 0.75) -> DataFrame:
    """(keys, status, name) of two sources' (keys, name): confirmed if the names are alike, a conflict without a name if not,
    single where one source has one, none where neither does. Of confirmed names the second source's counts. Each
    distinct pair of names is scored once."""
    j = first.select(*keys, F.col("name").alias("_a")).join(second.select(*keys, F.col("name").alias("_b")).hint("merge"), list(keys), "full")
    pairs = written(j.select("_a", "_b").where("_a is not null and _b is not null").distinct(), "name_pairs")
    scored = pairs.withColumn("_r", ratcliff_ratio("_a", "_b"))
    j = j.join(scored.hint("merge"), ["_a", "_b"], "left")
    status = F.when(F.col("_r") >= alike, "confirmed").when(F.col("_r").isNotNull(), "conflict").when(F.coalesce("_a", "_b").isNotNull(), "single").otherwise("none")
    return j.select(*keys, status.alias("status"), F.when(status != "conflict", F.coalesce("_b", "_a")).alias("name"))


def decision_fingerprints(turns: DataFrame, key: str = "slug", most: int = 40) -> DataFrame:
    """turns(key, voice, idx, start, end) to (key, voice, fingerprint): a hash of a voice's first turns in centiseconds; a
    decision about the voice holds as long as it stays the same."""
    k = F.row_number().over(Window.partitionBy(key, "voice").orderBy("start", "idx"))
    turn = F.concat_ws("-", F.bround(F.col("start") * 100).cast("long").cast("string"), F.bround(F.col("end") * 100).cast("long").cast("string"))
    first = turns.withColumn("_k", k).where(F.col("_k") <= most).groupBy(key, "voice").agg(F.array_sort(F.collect_list(F.struct("_k", turn.alias("s")))).alias("t"))
    return first.select(key, "voice", F.sha1(F.array_join(F.transform("t", lambda x: x["s"]), ",")).alias("fingerprint"))


def roles_by_talk(turns: DataFrame, key: str = "slug", clear: float = 1.25) -> DataFrame:
    """turns(key, voice, seconds) to (key, voice, seconds, role, confirmed): who talks most is the interviewee, the next the
    interviewer; confirmed if there are two voices and the first talks clearly more."""
    s = turns.groupBy(key, "voice").agg(F.sum("seconds").alias("seconds"))
    w = Window.partitionBy(key)
    s = s.withColumn("_r", F.row_number().over(w.orderBy(F.desc("seconds"), "voice"))).withColumn("_n", F.count("*").over(w)).withColumn("_max", F.max("seconds").over(w)).withColumn("_min", F.min("seconds").over(w))
    role = F.when(F.col("_r") == 1, "interviewee").when(F.col("_r") == 2, "interviewer").otherwise("other")
    return s.select(key, "voice", "seconds", role.alias("role"), ((F.col("_n") == 2) & (F.col("_max") >= clear * F.col("_min"))).alias("confirmed"))


def by_priority(rows: DataFrame, key: str, source: str, order: Sequence[str]) -> DataFrame:
    """The rows of each key's best source; sources not in order come last."""
    place = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in order]), F.col(source)), F.lit(0)), F.lit(len(order) + 1))
    best = rows.groupBy(key).agg(F.min(place).alias("_best"))
    return rows.join(best, key).where(place == F.col("_best")).drop("_best")


def boundaries(samples: DataFrame, key: str = "slug", hold: float = 10.0, flicker: float = 6.0) -> DataFrame:
    """samples(key, t, name) to (key, start, end, name): a name holds over gaps without a reading up to hold seconds; a run
    shorter than flicker between two of one name is taken for that name; runs of one name are merged."""
    w = Window.partitionBy(key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("name").isNotNull(), F.struct("name", "t")), ignorenulls=True).over(w)
    filled = samples.withColumn("_l", last).withColumn("name", F.when(F.col("t") - F.col("_l.t") <= hold, F.col("_l.name"))).drop("_l")
    r = runs(filled, key, ["t"], "name").groupBy(key, "run").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.min("name").alias("name"))
    o = Window.partitionBy(key).orderBy("start")
    short = (F.col("end") - F.col("start") < flicker) & F.lag("name").over(o).isNotNull() & (F.lag("name").over(o) == F.lead("name").over(o))
    smoothed = r.withColumn("name", F.when(short, F.lag("name").over(o)).otherwise(F.col("name"))).drop("run")
    return runs(smoothed, key, ["start"], "name").groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("name").alias("name")).drop("run")


def snapped_turns(words: DataFrame, key: str = "slug", reach: float = 4.0, pause: float = 1.0, around: int = 40, share: float = 0.5) -> DataFrame:
    """words(key, idx, t, text, name, overlapped) to (key, start, name), a row a turn.

    Where the name changes (null counts as one), the turn starts at the nearest word, within reach seconds and `around` words,
    that follows the end of a sentence or a pause; the earlier of equals; else where the name changes. A turn is given to
    the name of most of its words, the first to be heard of equals, or to nobody where at least share of its words are
    overlapped speech. Neighbouring turns of one name are one.
    """
    w = Window.partitionBy(key).orderBy("t", "idx")
    ends = F.regexp_replace(F.lag("text").over(w), "[\"'”’)]+$", "").rlike("[.!?]$")
    may_start = (F.row_number().over(w) > 1) & (F.coalesce(ends, F.lit(False)) | (F.col("t") - F.lag("t").over(w) >= pause))
    change = (F.row_number().over(w) > 1) & ~F.col("name").eqNullSafe(F.lag("name").over(w))
    rows = words.select(key, "idx", "t", "name", "overlapped", F.when(may_start, F.struct("t", "idx")).alias("_s"), change.alias("_c"), F.row_number().over(w).alias("_n"))
    rows = rows.withColumn("_before", F.last("_s", ignorenulls=True).over(w.rowsBetween(-around, 0))).withColumn("_after", F.first("_s", ignorenulls=True).over(w.rowsBetween(0, around - 1)))
    off = lambda s: F.abs(F.col(f"{s}.t") - F.col("t"))
    near = F.when((off("_before") <= reach) & (F.col("_after").isNull() | (off("_before") <= off("_after"))), F.col("_before")).when(off("_after") <= reach, F.col("_after"))
    at = F.coalesce(near, F.when(off("_before") <= reach, F.col("_before")), F.struct("t", "idx"))
    cut = rows.where("_c").select(key, at.alias("_at")).select(key, F.col("_at.t").alias("t"), F.col("_at.idx").alias("idx")).distinct().withColumn("_cut", F.lit(1))
    pieces = rows.select(key, "idx", "t", "name", "overlapped", "_n").join(cut.hint("merge"), [key, "t", "idx"], "left").withColumn("_piece", F.coalesce(F.sum("_cut").over(Window.partitionBy(key).orderBy("_n")), F.lit(0)))
    each = pieces.groupBy(key, "_piece", "name").agg(F.count("*").alias("_k"), F.min("_n").alias("_first"), F.min("t").alias("start"), F.count_if("overlapped").alias("_o"))
    turn = each.groupBy(key, "_piece").agg(F.max_by(F.struct("name"), F.struct("_k", -F.col("_first"))).alias("_b"), F.min("start").alias("start"), F.sum("_k").alias("_k"), F.sum("_o").alias("_o"))
    turn = turn.withColumn("name", F.when(F.col("_o") < share * F.col("_k"), F.col("_b.name")))
    return runs(turn, key, ["_piece"], "name").groupBy(key, "run").agg(F.min("start").alias("start"), F.first("name").alias("name")).drop("run")


def presenter_of_runs(turns: DataFrame, slots: DataFrame, key: str = "slug", prefix: str = "Audio shared by ") -> DataFrame:
    """turns(key, idx, start, speaker) with the prefix off, and each run of shared audio given to the slot(key, s_start,
    presenter) in which it starts."""
    shared = F.col("speaker").startswith(prefix)
    t = turns.withColumn("shared", shared).withColumn("speaker", F.when(shared, F.substr(F.col("speaker"), F.lit(len(prefix) + 1))).otherwise(F.col("speaker")))
    t = runs(t, key, ["start", "idx"], "shared")
    first = t.groupBy(key, "run").agg(F.min("start").alias("r_start"), F.first("shared").alias("is"))
    owner = asof_last(first.where("is"), slots, key, "r_start", "s_start", ["presenter"]).select(key, "run", "presenter")
    return t.join(owner, [key, "run"], "left").withColumn("speaker", F.coalesce("presenter", "speaker")).drop("presenter", "run")


def share_runs(samples: DataFrame, key: str = "slug", bridge: float = 30.0, least: float = 20.0) -> DataFrame:
    """samples(key, t, name) of shared screens to (key, start, end, samples, name): gaps up to bridge are closed, short runs
    dropped, the most frequent name (first by name of equals) taken."""
    w = Window.partitionBy(key).orderBy("t")
    new = F.coalesce((F.col("t") - F.lag("t").over(w) > bridge).cast("int"), F.lit(0))
    r = samples.withColumn("_new", new).withColumn("run", F.sum("_new").over(w))
    n = r.groupBy(key, "run", "name").agg(F.min("t").alias("start"), F.max("t").alias("end"), F.count("*").alias("n"))
    out = n.groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n").alias("samples"), F.min_by("name", F.struct(-F.col("n"), "name")).alias("name"))
    return out.where(F.col("end") - F.col("start") >= least).drop("run")


def long_stretches(segments: DataFrame, key: str = "slug", least: float = 120.0, most: int = 40) -> DataFrame:
    """segments(key, seg, speaker, start) to the longest runs of one speaker: (key, start, seconds, speaker). A run ends where the next starts."""
    r = runs(segments, key, ["start", "seg"], "speaker").groupBy(key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min("speaker").alias("speaker"))
    w = Window.partitionBy(key).orderBy("start")
    r = r.withColumn("seconds", F.coalesce(F.lead("start").over(w), F.col("end")) - F.col("start")).where((F.col("seconds") >= least) & F.col("speaker").isNotNull())
    return r.withColumn("_k", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("seconds"), "start"))).where(F.col("_k") <= most).select(key, "start", "seconds", "speaker")


def presentation_index(listed: DataFrame, stretches: DataFrame, key: str = "slug") -> DataFrame:
    """listed(key, speaker, curated) to (key, speaker, start): the curated time, else the first long stretch."""
    first = stretches.groupBy(key, "speaker").agg(F.min("start").alias("_f"))
    return listed.join(first, [key, "speaker"], "left").select(key, "speaker", F.coalesce("curated", "_f").alias("start"))


def chapters(segments: DataFrame, key: str = "slug", least: float = 60.0, apart: float = 15.0, fewest: int = 3) -> DataFrame:
    """(key, idx, start, title): the first time of each speaker who talks long enough, kept if far enough after the last
    kept; an introduction at 0; none under so many."""
    per = segments.where("speaker is not null").groupBy(key, "speaker").agg(F.min("start").alias("t"), F.sum(F.col("end") - F.col("start")).alias("s")).where(F.col("s") >= least)
    listed = per.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col("t"), F.col("speaker").alias("title")))).alias("a"))
    intro = F.array(F.struct(F.lit(0.0).alias("t"), F.lit("Introduction").alias("title")))
    kept = F.aggregate("a", intro, lambda k, x: F.when(x["t"] - F.element_at(k, -1)["t"] >= apart, F.concat(k, F.array(F.struct(x["t"].alias("t"), x["title"].alias("title"))))).otherwise(k))
    return listed.select(key, kept.alias("k")).where(F.size("k") >= fewest).select(key, F.posexplode("k").alias("idx", "c")).select(key, "idx", F.col("c.t").alias("start"), "c.title")


def merge_turns(cues: DataFrame, key: str = "slug", pause: float = 1.3, paragraph: float = 3.0) -> DataFrame:
    """cues(key, idx, speaker, start, end, text) to turns (key, turn, speaker, start, end, cues, text): consecutive cues of one
    speaker; a long pause makes a paragraph, a shorter one a period where there is none."""
    w = Window.partitionBy(key).orderBy("start", "idx")
    r = runs(cues, key, ["start", "idx"], "speaker", "turn")
    gap = F.col("start") - F.lag("end").over(Window.partitionBy(key, "turn").orderBy("start", "idx"))
    ended = F.lag("text").over(Window.partitionBy(key, "turn").orderBy("start", "idx")).rlike("[.?!…][\"'”’)]*$")
    join = F.when(gap.isNull(), "").when(gap >= paragraph, F.when(ended, "\n\n").otherwise(".\n\n")).when((gap >= pause) & ~ended, ". ").otherwise(" ")
    r = r.withColumn("_j", join).withColumn("_o", F.row_number().over(w))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", "_j", "text"))), lambda x: F.concat(x["_j"], x["text"])), "")
    return r.groupBy(key, "turn").agg(F.first("speaker").alias("speaker"), F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("cues"), text.alias("text"))


def caption_pieces(sents: DataFrame, keys: Sequence[str], width: int = 82, longest: float = 6.0, rate: float = 12.5) -> DataFrame:
    """sents(keys, speaker, start, end, text) to (keys, piece, start, end, text): cut into equal shares of words so that none
    is over the width in characters or the seconds on average; a sentence is shown no longer than its reading time allows."""
    words = F.split(F.trim("text"), r"\s+")
    shown = F.least(F.col("end") - F.col("start"), F.length("text") / rate + 0.5)
    n = F.greatest(F.ceil(F.length("text") / width), F.ceil(shown / longest), F.lit(1)).cast("int")
    r = sents.select(*keys, "start", shown.alias("d"), words.alias("w"), n.alias("n"))
    r = r.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("piece"))
    at = lambda i: F.floor(i * F.size("w") / F.col("n")).cast("int")
    text = F.array_join(F.slice(F.col("w"), at(F.col("piece")) + 1, at(F.col("piece") + 1) - at(F.col("piece"))), " ")
    return r.select(*keys, "piece", (F.col("start") + F.col("d") * F.col("piece") / F.col("n")).alias("start"), (F.col("start") + F.col("d") * (F.col("piece") + 1) / F.col("n")).alias("end"), text.alias("text")).where("text <> ''")


def tidy_captions(pieces: DataFrame, key: str, shortest: float = 1.0) -> DataFrame:
    """Captions shown a second at least, none into the next."""
    w = Window.partitionBy(key).orderBy("start", "piece")
    end = F.greatest("end", F.col("start") + shortest)
    return pieces.withColumn("end", F.least(end, F.coalesce(F.lead("start").over(w), end)))


def _repeats(words: np.ndarray, longest: int) -> list[tuple[int, int, int, int]]:
    """(n, first, last, repeats) of the loops in numbered words, -1 for no word: where some phrase repeats often enough, the
    phrase that covers most, the shorter of equals; the search goes on after it."""
    size = len(words)
    best, phrase = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for n in range(1, min(longest, size - 1) + 1):
        same = words[n:] == words[:-n]
        stop = np.where(same, size, np.arange(size - n))
        stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], size - n)  # the first place from here on that does not repeat
        times = 1 + (stop - np.arange(size - n)) // n
        said = np.convolve(words >= 0, np.ones(n, np.int64))[n - 1 : size - 1] > 0
        better = (times >= (8 if n <= 2 else 4)) & said & (times * n > best[: size - n])
        best[: size - n][better], phrase[: size - n][better] = (times * n)[better], n
    found, at = [], -1
    for i in np.flatnonzero(best).tolist():
        if i > at:
            n, cover = int(phrase[i]), int(best[i])
            at = i + cover - 1
            found.append((n, i, at, cover // n))
    return found


def loop_spans(words: DataFrame, key: str = "slug", longest: int = 8) -> DataFrame:
    """words(key, idx, word) to (key, n, first, last, repeats): a phrase of n words that repeats at once, 8 times or more for 1
    or 2 words, 4 for 3 or more; first and last are idx of its words. Of phrases that begin at one word the one that covers
    most, the shorter of equals, and none inside another. Empty words alone make no phrase. One recording is one group."""

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx", kind="stable")
        word = pdf["word"].fillna("")
        numbers = np.where(word == "", -1, pd.factorize(word)[0])
        idx = pdf["idx"].to_numpy()
        rows = [(pdf[key].iloc[0], n, int(idx[a]), int(idx[b]), k) for n, a, b, k in _repeats(numbers, longest)]
        return pd.DataFrame(rows, columns=[key, "n", "first", "last", "repeats"])

    return words.select(key, "idx", "word").groupBy(key).applyInPandas(find, f"{key} {words.schema[key].dataType.simpleString()}, n int, first long, last long, repeats int")


def loop_spans_of_lists(texts: DataFrame, key: str = "slug", words_col: str = "words", longest: int = 8) -> DataFrame:
    """As loop_spans, of texts(key, words), each with all its words as an array in one row: idx is a word's place there, from 0.
    Nothing is shuffled: the texts of a block are searched at once, with a number of its own between any two of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(b.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            lo = 0
            while lo < b.num_rows:
                before = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, before + LOOP_WORDS, "right")))
                said = b.column(1).slice(lo, hi - lo).flatten().fill_null("").dictionary_encode()
                silent = np.append(said.dictionary.to_numpy(zero_copy_only=False) == "", False)
                code = said.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                code[silent[code]] = -1
                after = ends[lo:hi] - before
                found = np.array(_repeats(np.insert(code, after, -2 - np.arange(hi - lo)), longest), np.int64).reshape(-1, 4)
                text = np.searchsorted(after + np.arange(hi - lo), found[:, 1])
                starts = np.append(0, after)[text] + text
                values = [b.column(0).take(pa.array(lo + text)), pa.array(found[:, 0].astype(np.int32)), pa.array(found[:, 1] - starts), pa.array(found[:, 2] - starts), pa.array(found[:, 3].astype(np.int32))]
                yield pa.RecordBatch.from_arrays(values, names=[key, "n", "first", "last", "repeats"])
                lo = hi

    return texts.select(key, words_col).mapInArrow(run, f"{key} {texts.schema[key].dataType.simpleString()}, n int, first long, last long, repeats int")


def repair_ranges(spans: DataFrame, words: DataFrame, key: str = "slug", pad: float = 12.0, near: float = 2.0) -> DataFrame:
    """The stretches (key, start, end) to transcribe anew: spans of loops, from their first word's time to that of the word
    after their last, padded, and joined where they lie near each other. words(key, idx, start)."""
    w = words.select(F.col(key).alias("_k"), "idx", F.coalesce(F.lead("start").over(Window.partitionBy(key).orderBy("idx")), "start").alias("_end"), F.col("start").alias("_start"))
    a = spans.join(w.select(F.col("_k").alias(key), F.col("idx").alias("first"), "_start").hint("merge"), [key, "first"]).join(w.select(F.col("_k").alias(key), F.col("idx").alias("last"), "_end").hint("merge"), [key, "last"])
    a = a.select(key, F.greatest(F.col("_start") - pad, F.lit(0.0)).alias("start"), (F.col("_end") + pad).alias("end"))
    o = Window.partitionBy(key).orderBy("start", "end")
    before = F.max("end").over(o.rowsBetween(Window.unboundedPreceding, -1))
    part = F.sum(F.when(F.col("start") <= before + near, 0).otherwise(1)).over(o)
    return a.withColumn("_p", part).groupBy(key, "_p").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_p")


def without_loops(words: DataFrame, key: str = "slug", longest: int = 8) -> DataFrame:
    """words(key, idx, word, ...) less the loops that are there, as after a repair that left some."""
    spans = loop_spans(words, key, longest).select(F.col(key).alias("_k"), F.explode(F.sequence("first", "last")).alias("_i"))
    return words.join(spans.hint("merge"), (F.col(key) == F.col("_k")) & (F.col("idx") == F.col("_i")), "left_anti")


def time_blocks(words: DataFrame, key: str = "slug", block: float = 180.0, slack: float = 90.0, pause: float = 0.8) -> DataFrame:
    """words(key, t, idx, text) to (key, start): blocks of about so many seconds. A block starts at the first sentence start
    within the slack past its target, else at the first pause there, else at the first word past the target; the next
    target counts from there. A fold over one recording."""

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["t", "idx"])
        t = pdf["t"].to_numpy()
        text = pdf["text"].fillna("").str.strip()
        ends = (text.str.contains(SENTENCE_END) & ~text.str.lower().isin(ABBREVIATIONS)).to_numpy()
        sentences = np.flatnonzero(np.append(False, ends[:-1]))
        rests = np.flatnonzero(np.append(False, np.diff(t) >= pause))
        starts, i = [t[0]], 1
        while True:
            i = max(i, int(np.searchsorted(t, starts[-1] + block)))
            if i >= len(t):
                break
            last = int(np.searchsorted(t, starts[-1] + block + slack))
            # A sentence start before a pause, whichever comes first.
            found = [int(c[k]) for c in (sentences, rests) if (k := int(np.searchsorted(c, i))) < len(c) and c[k] < last]
            at = found[0] if found else i
            starts.append(t[at])
            i = at + 1
        return pd.DataFrame({key: pdf[key].iloc[0], "start": starts})

    return words.select(key, "t", "idx", "text").groupBy(key).applyInPandas(cut, f"{key} {words.schema[key].dataType.simpleString()}, start double")


def paragraph_words(words: DataFrame, key: str = "slug", soft: int = 300, most: int = 800, pause: float = 1.3) -> DataFrame:
    """words(key, idx, start, text) with punctuation to (key, para, start, text): a paragraph ends at a sentence end, if it is
    long and a pause follows, or very long. The count starts anew at each end: a fold over one recording."""

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["start", "idx"])
        text, start = pdf["text"].tolist(), pdf["start"].tolist()
        para, n, out = 0, 0, []
        for i, w in enumerate(text):
            out.append(para)
            n += len(w) + 1
            ends = w.rstrip("\"'”’)").endswith((".", "!", "?"))
            if i + 1 < len(text) and ends and (n >= most or (n >= soft and start[i + 1] - start[i] >= pause)):
                para, n = para + 1, 0
        pdf = pdf.assign(para=out)
        return pdf.groupby("para").agg(start=("start", "first"), text=("text", " ".join)).reset_index().assign(**{key: pdf[key].iloc[0]})[[key, "para", "start", "text"]]

    return words.select(key, "idx", "start", "text").groupBy(key).applyInPandas(fold, f"{key} {words.schema[key].dataType.simpleString()}, para long, start double, text string")
