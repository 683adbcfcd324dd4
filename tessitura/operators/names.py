"""Names: keys, canonical forms, lists, directories and similar spellings."""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tessitura.functions.strings import fold
from tessitura.functions.tables import written

from .phrases import replace_phrases

# Country endings and codes of states.
COUNTRIES = {
    "usa": "USA", "us": "USA", "u s a": "USA", "united states": "USA", "america": "USA", "uk": "United Kingdom", "u k": "United Kingdom", "united kingdom": "United Kingdom",
    "england": "United Kingdom", "scotland": "United Kingdom", "wales": "United Kingdom", "uae": "United Arab Emirates",
}
STATES = tuple("al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy dc".split())


@F.pandas_udf(DoubleType())
def ratcliff_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of a to b, in this order: it is not symmetric. Null for a null side. Equal pairs of a batch are scored once, and what the matcher learns of b is used again."""
    found: dict[tuple[str, str], float] = {}
    matcher = difflib.SequenceMatcher(None)
    for x, y in sorted({(x, y) for x, y in zip(a, b, strict=True) if x is not None and y is not None}, key=lambda pair: pair[1]):
        if matcher.b != y:
            matcher.set_seq2(y)
        matcher.set_seq1(x)
        found[x, y] = matcher.ratio()
    return pd.Series([found.get(pair) for pair in zip(a, b, strict=True)], dtype="float64")


def ratio_bound(a: Column, b: Column) -> Column:
    """At least the ratio, from lengths alone."""
    return 2 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b))


def multiset_bound(a: Column, b: Column) -> Column:
    """At least the ratio, from the letters that both have."""
    letters = F.array_distinct(F.split(a, ""))
    times = lambda c, x: F.length(c) - F.length(F.replace(c, x, F.lit("")))
    shared = F.aggregate(letters, F.lit(0), lambda s, x: s + F.when(x == "", 0).otherwise(F.least(times(a, x), times(b, x))))
    return 2 * shared / (F.length(a) + F.length(b))


#: Letters from rare to common; others come first. The order changes what a join costs, never what it finds.
RARITY = "zqxjkvbwygpfmcdulhrnsoitae"


def _rare_letters(c: Column, least: float) -> Column:
    """A word's numbered letters, as each stands for its first, second, ... time, without the most common ones: words that
    reach the ratio have so many letters in common that one of these is among them."""

    def numbered(letters: Column) -> Column:
        each = F.transform(letters, lambda x, i: F.struct((-(i + 1 - F.array_position(letters, x))).alias("time"), F.instr(F.lit(RARITY), x).alias("place"), x.alias("x")))
        return F.transform(F.array_sort(each), lambda s: F.concat(s["x"], s["time"].cast("string")))

    letters = F.element_at(F.transform(F.array(F.array_sort(F.split(c, "(?!^)"))), numbered), 1)
    n = F.length(c)
    return F.slice(letters, F.lit(1), (n - F.ceil(least / (2 - least) * n - 1e-9) + 1).cast("int"))


def _shared_pairs(n: Column, m: Column, least: float) -> Column:
    """So many pairs of neighbouring letters, at least, are matched between words of n and m letters that reach the ratio.

    k matching letters stand in blocks between which one letter or more of either word is left over, so in n + m - 2k + 1
    blocks at most, and a block of b letters has b - 1 such pairs.
    """
    return (3 * F.ceil(least * (n + m) / 2 - 1e-9) - n - m - 1).cast("int")


def _other_lengths(n: Column, least: float) -> Column:
    """The lengths that can reach the ratio with n letters."""
    low, high = least / (2 - least), (2 - least) / least
    return F.sequence(F.greatest(F.ceil(n * low - 1e-9), F.lit(1)).cast("int"), F.floor(n * high + 1e-9).cast("int"))


def _rare_pairs(c: Column, needed: Column) -> Column:
    """A word's pairs of neighbouring letters with their places, from rare to common, without the last ones: of needed
    matched pairs, one is among these."""
    n = F.length(c)
    place = lambda i: F.instr(F.lit(RARITY), F.substring(c, i, F.lit(1)))
    each = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct((place(i) + place(i + 1)).alias("common"), F.substring(c, i, F.lit(2)).alias("x"), i.alias("at")))
    return F.slice(F.array_sort(each), F.lit(1), (n - needed).cast("int"))


def _letter_bits(c: Column) -> Column:
    """Two longs with a bit for a word's first, second, third and later letter of each of 32 kinds: two words' bits differ in no more
    places than the words in letters, as letters of a kind, and those from the fourth on, may only fall together."""
    kinds = F.array_sort(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.ascii(F.substring(c, i, F.lit(1))).bitwiseAND(F.lit(31))))
    numbered = F.element_at(F.transform(F.array(kinds), lambda k: F.transform(k, lambda x, i: x * 4 + F.least((i + 1 - F.array_position(k, x)).cast("int"), F.lit(3)))), 1)
    one = F.lit(1).cast("long")
    half = lambda k, low: F.aggregate(k, F.lit(0).cast("long"), lambda s, x: F.when(x.between(low, low + 63), s.bitwiseOR(F.call_function("shiftleft", one, x - low))).otherwise(s))
    return F.element_at(F.transform(F.array(numbered), lambda k: F.array(half(k, 0), half(k, 64))), 1)


def _letters_allow(la: Column, lb: Column, least: float) -> Column:
    """Whether the letters' bits (_a0, _a1, _b0, _b1) leave a ratio of so much: the letters that do not match are bounded by it."""
    differ = F.bit_count(F.col("_a0").bitwiseXOR(F.col("_b0"))) + F.bit_count(F.col("_a1").bitwiseXOR(F.col("_b1")))
    return differ <= la + lb - 2 * F.ceil(least * (la + lb) / 2 - 1e-9)


#: Rows that a join may broadcast.
FEW = 100_000


def _side(df: DataFrame) -> DataFrame:
    """df, written, as a side of a join with generated rows: broadcast if a count says that it is small, else merged."""
    df = written(df, "side")
    return F.broadcast(df) if df.limit(FEW + 1).count() <= FEW else df.hint("merge")


def _by_letters(lw: DataFrame, rw: DataFrame, a: str, b: str, least: float, on: Sequence[str]) -> DataFrame:
    """Pairs that share a rare letter and a length that can reach the ratio."""
    lw = lw.withColumn("_x", F.explode(_rare_letters(F.col(a), least))).withColumn("_n", F.col("_la"))
    rw = rw.withColumn("_x", F.explode(_rare_letters(F.col(b), least)))  # the shorter list on the right is cheaper: it takes all lengths
    rw = rw.withColumn("_n", F.explode(_other_lengths(F.col("_lb"), least)))
    return lw.join(_side(rw), ["_x", "_n", *on]).where((ratio_bound(F.col(a), F.col(b)) >= least - 1e-9) & _letters_allow(F.col("_la"), F.col("_lb"), least)).select(a, b)


def _by_pairs(lw: DataFrame, rw: DataFrame, a: str, b: str, least: float, on: Sequence[str]) -> DataFrame:
    """Pairs that share a rare pair of neighbouring letters, at places that differ by no more than the letters left over
    before it. Both words' lengths are known on the right, so it takes just the pairs and places that can match."""
    lw = lw.withColumn("_s", F.explode(_rare_pairs(F.col(a), F.col("_needed")))).select(a, *on, "_a0", "_a1", F.col("_la").alias("_n"), F.col("_s.x").alias("_x"), F.col("_s.at").alias("_at"))
    rw = rw.withColumn("_n", F.explode(_other_lengths(F.col("_lb"), least))).withColumn("_k", F.ceil(least * (F.col("_n") + F.col("_lb")) / 2 - 1e-9).cast("int"))
    rw = rw.where(F.col("_k") <= F.least("_n", "_lb")).withColumn("_s", F.explode(_rare_pairs(F.col(b), _shared_pairs(F.col("_n"), F.col("_lb"), least))))
    first, last = F.greatest(F.col("_s.at") - (F.col("_lb") - F.col("_k")), F.lit(1)), F.least(F.col("_s.at") + (F.col("_n") - F.col("_k")), F.col("_n") - 1)
    rw = rw.where(first <= last).select(b, *on, "_b0", "_b1", "_lb", "_n", F.col("_s.x").alias("_x"), F.explode(F.sequence(first, last)).alias("_at"))
    return lw.join(_side(rw), ["_x", "_n", "_at", *on]).where(_letters_allow(F.col("_n"), F.col("_lb"), least)).select(a, b)


def similar_candidates(left: DataFrame, right: DataFrame, a: str, b: str, least: float, on: Sequence[str] = ()) -> DataFrame:
    """The distinct pairs (a, b) that bounds by lengths, places and letters leave of those that may reach the ratio, written. Letters are
    first compared by their bits, inside the joins, so that few pairs are sent on to be made distinct.

    Lossless. Where words of a length must share a pair of neighbouring letters with all that reach the ratio, the rare
    ones of their pairs, with length and place, are the join's key (positional prefix filtering). Where they need not (short
    words, low ratios), a rare letter and the length are.
    """
    lw = left.select(a, *on).distinct().withColumn("_la", F.length(a)).where("_la > 0")
    rw = right.select(b, *on).distinct().withColumn("_lb", F.length(b)).where("_lb > 0")

    def needed(n: Column) -> Column:
        return F.array_min(F.transform(F.filter(_other_lengths(n, least), lambda m: F.ceil(least * (n + m) / 2 - 1e-9) <= F.least(n, m)), lambda m: _shared_pairs(n, m, least)))

    def bits(df: DataFrame, c: str, side: str) -> DataFrame:
        return df.withColumn("_bits", _letter_bits(F.col(c))).withColumns({f"_{side}{i}": F.get("_bits", F.lit(i)) for i in range(2)}).drop("_bits")

    # Written, as each side is read for long and for short words: what the words are taken from is read once.
    lw = written(bits(lw.withColumn("_needed", needed(F.col("_la"))), a, "a"), "left")
    rw = written(bits(rw.withColumn("_needed", needed(F.col("_lb"))), b, "b"), "right")
    long_l, long_r = lw.where("_needed > 0"), rw.where("_needed > 0")
    short_l, short_r = lw.where("_needed <= 0"), rw.where("_needed <= 0")
    found = _by_pairs(long_l, long_r, a, b, least, on).union(_by_letters(short_l, rw, a, b, least, on)).union(_by_letters(long_l, short_r, a, b, least, on))
    return written(found.distinct().where(multiset_bound(F.col(a), F.col(b)) >= least - 1e-9), "pairs")


def similarity_join(left: DataFrame, right: DataFrame, a: str, b: str, least: float, on: Sequence[str] = ()) -> DataFrame:
    """Distinct pairs (a, b, ratio) with a ratio of at least so much, each scored once. Nulls and empty texts pair with none.

    What similar_candidates leaves is written before it is scored: the optimizer would move the scoring below the distinct.
    """
    return similar_candidates(left, right, a, b, least, on).withColumn("ratio", ratcliff_ratio(a, b)).where(F.col("ratio") >= least)


def person_key(c: Column) -> Column:
    """Without a (handle), letters without marks, the part before a slash, letters and spaces only."""
    c = F.split_part(F.regexp_replace(c, r"\s*\([^()]*\)", ""), F.lit("/"), F.lit(1))
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(fold(c)), "[^a-z ]", ""), " +", " "))


def title_case(c: Column) -> Column:
    """A capital after anything but a letter, as Python's title()."""
    from tessitura.functions.strings import sub

    return sub(F.lower(c), r"(?U)\p{L}+", lambda m: F.concat(F.upper(F.substring(m, 1, 1)), F.substring(m, 2, 1 << 30)))


def canonical_speaker(rows: DataFrame, aliases: DataFrame, not_speakers: DataFrame, raw: str, out: str = "speaker") -> DataFrame:
    """rows with a canonical name: an alias(alias, name) before or after the number in front and the parentheses behind
    are dropped; ALL CAPS become title case; not_speakers(label) stay as they are."""
    norm = F.trim(F.regexp_replace(F.coalesce(F.col(raw), F.lit("")), r"(?U)\s+", " "))
    r = rows.withColumn("_n", norm).withColumn("_m", F.regexp_replace("_n", r"(?U)^\d+\s+(?=[^\W\d])", ""))
    bare = F.regexp_replace("_m", r"(?:\s*\([^()]*\)\s*)+$", "")
    r = r.withColumn("_s", F.when(bare == "", F.col("_m")).otherwise(bare))
    caps = F.col("_s").rlike(r"(?U)\p{L}") & (F.col("_s") == F.upper("_s"))
    r = r.withColumn("_t", F.when(caps, title_case(F.col("_s"))).otherwise(F.col("_s")))
    for i, c in enumerate(("_m", "_s", "_t")):
        r = r.join(aliases.select(F.lower("alias").alias(f"_k{i}"), F.col("name").alias(f"_a{i}")).distinct(), F.lower(c) == F.col(f"_k{i}"), "left")
    r = r.join(not_speakers.select(F.lower("label").alias("_l"), F.lit(True).alias("_not")).distinct(), F.lower("_n") == F.col("_l"), "left")
    name = F.when(F.col("_not") | (F.col("_n") == ""), F.col("_n")).otherwise(F.coalesce("_a0", "_a1", "_a2", "_t"))
    return r.select(*rows.columns, name.alias(out))


def finalize_speakers(rows: DataFrame, duos: DataFrame, not_speakers: DataFrame, key: str) -> DataFrame:
    """rows(key, name, start, location) to one a person: duos(label, names) split, others dropped, the earliest start,
    the first location that is known."""
    kept = rows.join(not_speakers.select(F.lower("label").alias("_l")), F.lower("name") == F.col("_l"), "left_anti")
    split = kept.join(duos.select(F.lower("label").alias("_d"), "names"), F.lower("name") == F.col("_d"), "left")
    each = split.select(key, F.explode(F.coalesce("names", F.array("name"))).alias("name"), "start", "location")
    return each.groupBy(key, "name").agg(F.min("start").alias("start"), F.min_by("location", F.when(F.col("location").isNotNull(), F.struct("start", "location"))).alias("location"))


def merge_lists(a: DataFrame, b: DataFrame, key: Column | None = None) -> DataFrame:
    """Two lists of (name, country): one row a key, a's spelling first, countries filled in from b; added says it was b's alone."""
    k = F.lower(F.trim("name"))
    l, r = a.groupBy(k.alias("k")).agg(F.min("name").alias("an"), F.min("country").alias("ac")), b.groupBy(k.alias("k")).agg(F.min("name").alias("bn"), F.min("country").alias("bc"))
    return l.join(r, "k", "full").select(F.coalesce("an", "bn").alias("name"), F.coalesce("ac", "bc").alias("country"), F.col("an").isNull().alias("added"))


def norm_place(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\p{L}\p{N} ]", ""))


def resolve_country(rows: DataFrame, known: DataFrame, name: str, location: str) -> DataFrame:
    """rows with a country: by name in known(name, country), by a country ending, by a known country's name, by a state's code."""
    by_name = known.groupBy(norm_place(F.col("name")).alias("_k")).agg(F.max("country").alias("_by_name"))
    valid = known.select("country").distinct().withColumn("_v", norm_place(F.col("country"))).groupBy("_v").agg(F.min("country").alias("_valid"))
    r = rows.withColumn("_l", norm_place(F.col(location))).join(by_name, norm_place(F.col(name)) == F.col("_k"), "left")
    # A place ends in a country if one of its word suffixes is that country: an equi-join, not a comparison with all.
    words = F.split("_l", " ")
    longest = valid.agg(F.max(F.size(F.split("_v", " ")))).first()[0] or 1  # words of the longest place that is known
    tails = F.transform(F.sequence(F.lit(1), F.least(F.size(words), F.lit(max(longest, 3)))), lambda i: F.array_join(F.slice(words, -i, i), " "))
    suffix = F.create_map(*[F.lit(x) for kv in COUNTRIES.items() for x in kv])
    r = r.withColumn("_tails", tails).withColumn("_suffix", F.get(F.filter(F.transform("_tails", lambda t: F.try_element_at(suffix, t)), lambda x: x.isNotNull()), F.lit(0)))
    places = r.select("_l", "_tails").distinct()
    ended = places.select(F.col("_l").alias("_place"), F.explode("_tails").alias("_v")).hint("merge").join(valid.hint("merge"), "_v").groupBy("_place").agg(F.max_by("_valid", F.length("_v")).alias("_ended"))
    r = r.join(ended.hint("merge"), F.col("_l") == F.col("_place"), "left")
    state = F.when(F.element_at(words, -1).isin(*STATES), "USA")
    return r.select(*rows.columns, F.coalesce("_by_name", "_suffix", "_ended", state).alias("resolved"))


def without_collisions(pool: DataFrame, vocabulary: DataFrame, stronger: DataFrame | None = None) -> DataFrame:
    """pool(name) less names that the vocabulary(canonical) has, and those that a stronger pool has."""
    p = pool.join(vocabulary.select(F.lower("canonical").alias("_c")).distinct(), F.lower("name") == F.col("_c"), "left_anti")
    return p if stronger is None else p.join(stronger.select(F.lower("name").alias("_s")).distinct(), F.lower("name") == F.col("_s"), "left_anti")


def unsuppressed(rows: DataFrame, suppressions: DataFrame) -> DataFrame:
    """rows(matched, candidate) less the reviewed pairs."""
    s = suppressions.select(F.lower("matched").alias("_m"), F.col("candidate").alias("_c")).distinct()
    return rows.join(s, (F.lower("matched") == F.col("_m")) & (F.col("candidate") == F.col("_c")), "left_anti")


def first_letters(c: Column, letter: str) -> Column:
    """For each word its first letter, in a class of characters; empty for a word without one."""
    return F.regexp_extract_all(c, F.lit(rf"(?U)(?<!\S)(?=\S)(?:(?!{letter})\S)*({letter}?)"), F.lit(1))


def beginnings(pool: DataFrame) -> dict[int, list[str]]:
    """The first letters of a pool's names(n, _f) by number of words: as many as alphabets have."""
    found: dict[int, list[str]] = {}
    for r in pool.select("n", "_f").distinct().collect():
        found.setdefault(r["n"], []).append(r["_f"])
    return found


def token_windows(texts: DataFrame, keys: Sequence[str], sizes: Sequence[int], text_col: str = "text", begin: dict[int, list[str]] | None = None) -> DataFrame:
    """(keys, idx, n, words, matched): runs of n words within a sentence; with begin only those whose first letter, in lower case,
    is listed under n, and those whose first word has no letter."""
    tok = F.regexp_extract_all(text_col, F.lit(r"(?U)\S+"), F.lit(0))
    rows = texts.select(*keys, tok.alias("t"), F.transform(first_letters(F.col(text_col), r"[\p{L}\p{N}]"), F.lower).alias("c")).where(F.size("t") > 0)
    core = lambda x: F.regexp_replace(x, r"(?U)^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")

    def runs_of(n: int) -> Column:
        # get() takes single elements; slice() would copy the whole array each time. Runs are made for what may begin a name only.
        starts = F.filter(F.sequence(F.lit(0), F.greatest(F.size("t") - n, F.lit(0))), lambda i: (F.size("t") >= n) & (F.lit(True) if begin is None else F.get("c", i).isin("", *begin.get(n, []))))
        run = F.transform(starts, lambda i: F.struct((i + 1).alias("idx"), F.lit(n).alias("n"), F.array(*[F.get("t", i + k) for k in range(n)]).alias("w")))
        whole = lambda r: F.lit(True) if n == 1 else ~F.exists(F.array(*[r["w"][k] for k in range(n - 1)]), lambda x: x.rlike("[.?!…]$"))
        return F.filter(run, whole)

    made = [runs_of(n) for n in sizes]
    return rows.select(*keys, F.explode(F.concat(*made)).alias("r")).select(*keys, "r.idx", "r.n", F.array_join(F.transform("r.w", core), " ").alias("matched"))


def name_candidates(texts: DataFrame, names: DataFrame, keys: Sequence[str], least: float = 0.72, text_col: str = "text", sizes: Sequence[int] | None = None) -> DataFrame:
    """(keys, name, matched, idx, ratio): the best window for each name(name) with the same number of words and the same
    first letter, and a ratio of at least so much; the first window wins ties; exact matches are no candidates."""
    if sizes is None:
        sizes = sorted(r["n"] for r in names.select(F.size(F.split("name", " ")).alias("n")).distinct().collect())  # a row for each length of a name
    p = names.select("name", F.lower("name").alias("_p"), F.size(F.split("name", " ")).alias("n"), F.lower(F.left("name", F.lit(1))).alias("_f")).where(F.col("n").isin(*sizes))
    p = written(p, "names")
    w = token_windows(texts, keys, sizes, text_col, beginnings(p)).where("matched <> ''").withColumn("_f", F.lower(F.left("matched", F.lit(1)))).withColumn("_m", F.lower("matched"))
    # Only what is as long as some name that begins so may be, and written: it is read for the pairs and for the hits.
    lengths = p.groupBy("n", "_f").agg(F.min(F.length("_p")).alias("_least"), F.max(F.length("_p")).alias("_most"))
    w = w.join(written(lengths, "lengths"), ["n", "_f"]).where((2 * F.col("_most") >= (least - 1e-9) * (F.length("_m") + F.col("_most"))) | (F.length("_m") <= F.col("_most")))
    w = written(w.where((F.length("_m") >= F.col("_least")) | (2 * F.length("_m") >= (least - 1e-9) * (F.length("_m") + F.col("_least")))).drop("_least", "_most"), "windows")
    distinct = w.select("_m", "n", "_f").distinct()
    pairs = similarity_join(distinct, p, "_m", "_p", least, ["n", "_f"]).where("_m <> _p")
    hits = w.hint("merge").join(pairs.hint("merge"), "_m").join(p.select("name", "_p").hint("merge"), "_p")
    best = F.max_by(F.struct("matched", "idx", "ratio"), F.struct("ratio", -F.col("idx")))
    return hits.groupBy(*keys, "name").agg(best.alias("b")).select(*keys, "name", "b.matched", "b.idx", "b.ratio")


def name_variants(texts: DataFrame, names: DataFrame, key: str, least: float = 0.8, both: float = 0.85, text_col: str = "text") -> DataFrame:
    """(first, last, name, times, texts): adjacent words that are each close to a name's first and last word, but not the
    name; where both differ, both must be closer. Each distinct word is compared once, and every name word that it is close to counts."""
    words = F.regexp_extract_all(F.lower(text_col), F.lit(r"(?U)\p{L}+"), F.lit(0))
    rows = texts.select(key, words.alias("w")).where(F.size("w") >= 2)
    n = names.select("name", F.lower(F.split("name", " ")[0]).alias("fa"), F.lower(F.element_at(F.split("name", " "), -1)).alias("fb")).where("fa <> fb or name like '% %'").distinct()
    # From a plain explode the optimizer infers a filter that cuts the text into words anew, for pairs for each of them; no list is empty.
    vocabulary = rows.select(F.explode_outer(F.array_distinct("w")).alias("w")).distinct()
    # Written, as both sides of a pair read it: each word is scored once.
    close = written(similarity_join(vocabulary, n.select(F.col("fa").alias("k")).union(n.select("fb")).distinct(), "w", "k", least), "close")
    ca = close.select(F.col("w").alias("a"), F.col("k").alias("fa"), F.col("ratio").alias("ra"))
    cb = close.select(F.col("w").alias("b"), F.col("k").alias("fb"), F.col("ratio").alias("rb"))
    hit = n.join(ca.hint("merge"), "fa").join(cb.hint("merge"), "fb").where("not (a = fa and b = fb)").where((F.col("a") == F.col("fa")) | (F.col("b") == F.col("fb")) | ((F.col("ra") >= both) & (F.col("rb") >= both)))
    # Only pairs that hit are counted: the texts' pairs meet the few hits before they are grouped.
    hit = _side(hit.select("a", "b", "name").distinct())
    next_to = F.arrays_zip("w", F.slice("w", F.lit(2), F.size("w") - 1)).cast("array<struct<a:string,b:string>>")
    pairs = rows.select(key, F.explode_outer(next_to).alias("p")).select(key, "p.a", "p.b").where("b is not null")
    found = pairs.join(hit, ["a", "b"])
    return found.groupBy(F.col("a").alias("first"), F.col("b").alias("last"), "name").agg(F.count("*").alias("times"), F.count_distinct(key).alias("texts"))


def merge_spellings(counts: DataFrame, key: str, least: float = 0.85) -> DataFrame:
    """counts(key, name, n) with the spelling each is merged into: by falling count, into the first kept one that is
    close enough. A fold over one key's few distinct names."""

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n", "name"], ascending=[False, True], kind="stable")
        kept: list[str] = []
        into = []
        for name in pdf["name"]:
            hit = next((k for k in kept if difflib.SequenceMatcher(None, name.lower(), k.lower()).ratio() >= least), None)
            if hit is None:
                kept.append(name)
            into.append(hit or name)
        return pdf.assign(merged=into)

    schema = f"{key} {counts.schema[key].dataType.simpleString()}, name string, n long, merged string"
    return counts.select(key, "name", F.col("n").cast("long").alias("n")).groupBy(key).applyInPandas(merge, schema)


def absorb_short_names(names: DataFrame, rounds: int = 3) -> DataFrame:
    """names(name) with the name each is absorbed by: the same first and last word, and words that the longer one has.
    Of several the longest, then the first by name; chains are followed."""
    k = names.select("name").distinct().withColumn("w", F.split(person_key(F.col("name")), " ")).withColumn("f", F.element_at("w", 1)).withColumn("l", F.element_at("w", -1))
    a, b = k.alias("a"), k.alias("b")
    on = (F.col("a.f") == F.col("b.f")) & (F.col("a.l") == F.col("b.l")) & (F.size("a.w") < F.size("b.w")) & (F.size(F.array_except("a.w", "b.w")) == 0)
    edge = a.join(b, on).groupBy(F.col("a.name").alias("name")).agg(F.min_by(F.col("b.name"), F.struct(-F.size("b.w"), F.col("b.name"))).alias("into"))
    found = k.select("name").join(edge, "name", "left").withColumn("into", F.coalesce("into", "name"))
    for _ in range(rounds - 1):
        up = edge.select(F.col("name").alias("into"), F.col("into").alias("_up"))
        found = found.join(up, "into", "left").select("name", F.coalesce("_up", "into").alias("into"))
    return found


def name_cards(query: str, names: DataFrame, most: int = 3) -> DataFrame:
    """(name, score): whole name 3, last word a prefix of some word 2, a word only one name has 1; the top few."""
    q = " ".join(query.lower().split())
    tokens = q.split(" ")
    n = names.select("name", person_key(F.col("name")).alias("k")).withColumn("w", F.split("k", " "))
    df = n.select(F.explode(F.array_distinct("w")).alias("t")).where(F.col("t").isin(*tokens)).groupBy("t").agg(F.count("*").alias("n")).where("n = 1").select("t")  # a row for each word asked for
    unique = n.select("name", F.explode("w").alias("t")).join(F.broadcast(df), "t").select("name", F.lit(1).alias("s"))
    prefix = F.array_size(F.array_intersect("w", F.array(*[F.lit(t) for t in tokens[:-1]] or [F.lit("")]))) >= len(set(tokens[:-1]))
    exact = n.where(F.col("k") == q).select("name", F.lit(3).alias("s"))
    starts = n.where(prefix & F.exists("w", lambda t: t.startswith(tokens[-1]))).select("name", F.lit(2).alias("s"))
    return exact.union(starts).union(unique).groupBy("name").agg(F.max("s").alias("score")).orderBy(F.desc("score"), "name").limit(most)


#: Words of a meeting's own controls, which are no names.
CONTROLS = ("unmute", "mute", "share screen", "recording", "participants", "chat", "view", "leave")


def screen_name(c: Column) -> Column:
    """A person's name of what is read on a screen, or null: one to four words, the first with a capital; what is in
    parentheses and bars go, and a meeting's own controls are no names."""
    shown = F.trim(F.regexp_replace(F.regexp_replace(c, r"\([^()]*\)|[|•_]", ""), r"\s+", " "))
    ok = shown.rlike(r"(?U)^\p{Lu}[\p{L}.'’-]*(?: [\p{L}.'’-]+){0,3}$") & ~F.lower(shown).rlike(r"\b(?:" + "|".join(CONTROLS) + r")\b")
    return F.when(ok, shown)


def phrase_groups(sents: DataFrame, net: str, key: str, text_col: str = "sentence", known: DataFrame | None = None) -> DataFrame:
    """(phrase, n, recordings, example): what a net (a pattern) catches in sentences, by its lower case, less the catches that are
    known(phrase) terms; the example is the shortest sentence, the first of equals."""
    rows = sents.select(key, F.col(text_col).alias("_s"), F.explode(F.regexp_extract_all(F.lower(text_col), F.lit(net), F.lit(0))).alias("phrase"))
    if known is not None:
        rows = rows.join(known.select(F.lower("phrase").alias("phrase")).distinct().hint("merge"), "phrase", "left_anti")
    return rows.groupBy("phrase").agg(F.count("*").alias("n"), F.count_distinct(key).alias("recordings"), F.min_by("_s", F.struct(F.length("_s"), "_s")).alias("example"))


# Particles that stay with a last name, words that say a name is not a person's, and what may follow a name.
PARTICLES = ("de", "da", "di", "do", "del", "della", "van", "von", "der", "den", "la", "le", "el", "al", "bin", "ben", "st", "mc", "dos", "das", "du")
NOT_PERSONS = ("studio", "studios", "team", "collective", "lab", "labs", "works", "gallery", "museum", "foundation", "inc", "llc", "project", "projects", "media", "design", "network", "group", "club")
TAILS = ("artist", "art", "studio", "official")


def split_name(c: Column) -> Column:
    """(first, last) of a name as it is shown. A person's last name is the last word, with particles before it; a handle, one
    word, a studio and the like have no first name. Real names in brackets count where they follow a single word; quotes,
    what follows aka or a slash, and words like Artist at the end go."""
    inner = F.regexp_extract(c, r"\(([^)]*)\)", 1)
    bare = F.regexp_replace(F.regexp_replace(c, r"\s*\([^)]*\)", ""), '\\s*(?:"[^"]*"|“[^”]*”)', "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"\s+(?:aka|AKA|a\.k\.a\.?)\s.*$", ""), r"\s*/.*$", "")
    words = lambda x: F.filter(F.split(F.trim(F.translate(x, "®™", "")), r"\s+"), lambda w: w != "")
    real = (F.size(words(bare)) == 1) & (F.size(words(inner)) >= 2) & F.left(inner, F.lit(1)).rlike(r"\p{Lu}")
    toks = F.when(real, words(inner)).otherwise(words(bare))

    def split(t: Column) -> Column:
        # As many words like Artist go as stand at the end, but two words always stay.
        own = F.coalesce(F.array_max(F.transform(t, lambda w, i: F.when((i < 2) | ~F.lower(w).isin(*TAILS), i + 1))), F.size(t))
        t = F.slice(t, F.lit(1), own)
        n, size = F.array_join(t, " "), F.size(t)
        letters = F.upper(n) != F.lower(n)
        handle = (size < 2) | n.rlike("[0-9_]") | ((size >= 3) & (n == F.lower(n))) | n.rlike(rf"(?i)\b(?:{'|'.join(NOT_PERSONS)})\b") | ((n == F.upper(n)) & letters & (F.length(n) > 3))
        # The run of particles right before the last word.
        before = F.transform(t, lambda w, i: F.when((i < size - 1) & (i > 0) & F.lower(F.regexp_replace(w, r"^\.+|\.+$", "")).isin(*PARTICLES), F.lit(None)).when(i < size - 1, i + 1))
        k = F.greatest(F.coalesce(F.array_max(before), F.lit(1)), F.lit(1))
        whole = F.struct(F.lit("").alias("first"), F.when(n == "", c).otherwise(n).alias("last"))
        return F.when(handle, whole).otherwise(F.struct(F.array_join(F.slice(t, F.lit(1), k), " ").alias("first"), F.array_join(F.slice(t, k + 1, size - k), " ").alias("last")))

    return F.element_at(F.transform(F.array(toks), split), 1)


def dictionary_mentions(sents: DataFrame, names: DataFrame, keys: Sequence[str], text_col: str = "sentence", sent_firsts: int = 200_000) -> DataFrame:
    """(keys, at, name): names(name), of any length, found word for word, in any case; of those that start at one word the
    longest, and none inside another.

    Only words that begin some name go on, each with the words after it, and meet the names by that word. First words are
    sent to all executors up to sent_firsts of them, and joined by sorting beyond.
    """
    words = lambda c: F.regexp_extract_all(F.lower(c), F.lit(r"(?U)[\w']+"), F.lit(0))
    n = names.select("name", words("name").alias("w")).where(F.size("w") > 0).groupBy("w").agg(F.min("name").alias("name"))
    n = written(n.select("name", "w", F.size("w").alias("n"), F.get("w", F.lit(0)).alias("f")), "names")
    longest = n.agg(F.max("n")).first()[0] or 1
    rows = sents.select(*keys, words(text_col).alias("w")).where(F.size("w") > 0)
    # get() takes single elements; slice() would copy the whole array each time.
    ahead = F.transform(F.sequence(F.lit(1), F.size("w")), lambda i: F.struct(i.alias("at"), F.array(*[F.get("w", i + k - 1) for k in range(longest)]).alias("a")))
    each = rows.select(*keys, F.explode(ahead).alias("x")).select(*keys, "x.at", "x.a", F.get("x.a", F.lit(0)).alias("f"))
    firsts = written(n.select("f").distinct(), "first_words")
    begun = each.join(F.broadcast(firsts) if firsts.count() <= sent_firsts else firsts.hint("merge"), "f", "left_semi")
    met = begun.hint("merge").join(n.hint("merge"), "f").where(F.slice("a", F.lit(1), F.col("n")) == F.col("w"))
    hits = met.groupBy(*keys, "at").agg(F.max("n").alias("n"), F.max_by("name", "n").alias("name"))
    order = Window.partitionBy(*keys).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.max(F.col("at") + F.col("n")).over(order) > F.col("at"), F.lit(False))
    return hits.withColumn("_in", inside).where("not _in").select(*keys, "at", "name")


def fix_target_word(texts: DataFrame, key: str, target: str, stems: Sequence[str], least: float = 0.85, text_col: str = "text") -> DataFrame:
    """texts with misspellings of one word (in its -ism and -ist forms, plural kept) written right: words that begin with a
    stem and end alike are found, each distinct one is scored once against the target, and the close ones are replaced."""
    pattern = r"(?U)\b[" + target[0].upper() + target[0].lower() + r"][A-Za-z-]{7,21}(?:ism|ist)s?\b"
    heard = texts.select(F.explode(F.regexp_extract_all(text_col, F.lit(pattern), F.lit(0))).alias("w")).distinct()
    low = F.lower("w")
    plural = low.rlike("(?:ists|isms)$")
    stem = F.when(plural, F.left(low, F.length(low) - 1)).otherwise(low)
    ends = F.right(stem, F.lit(3))
    goal = F.concat(F.lit(target), ends)
    scored = heard.where(low.rlike("^(?:" + "|".join(stems) + ")")).select("w", F.replace(stem, F.lit("-"), F.lit("")).alias("s"), F.lower(goal).alias("g"), F.concat(goal, F.when(plural, "s").otherwise("")).alias("to"))
    close = scored.withColumn("r", ratcliff_ratio("s", "g")).where((F.col("r") >= least) & (F.col("w") != F.col("to"))).select("w", "to")
    to = close.select(F.col("w").alias("phrase"), F.col("to").alias("replacement"), F.lit(True).alias("whole"))
    return replace_phrases(texts, to, key, text_col)
