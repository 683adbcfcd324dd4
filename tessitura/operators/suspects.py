"""Words that may have been misheard: near the surname of a known person, or near one target word."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessitura.functions.strings import fold
from tessitura.functions.tables import written

from .names import ratcliff_ratio, similarity_join
from .sentences import sentences

# Words that show that art is spoken of, and first names that are too common to correct by.
ART_WORDS = (
    r"paint\w*", r"artist\w*", "art", r"sculpt\w*", r"exhibit\w*", "gallery", "museum", "abstract", r"expressionis\w*", r"surreal\w*", "canvas", "drawing", "work", "works", "movement", "school", "studio",
    "pollock", "rothko", "warhol", "picasso", "de kooning", "motherwell", "guston", "newman", "still", "krasner", "monet", "matisse", "dali", "duchamp", "computer", r"algorithm\w*", "video",
)
COMMON_FIRST_NAMES = ("david", "john", "michael", "kevin", "eric", "mark", "paul", "mary", "chris", "jennifer", "peter", "james", "robert", "tom", "jim", "steve", "sam")
# The target's forms, and words that may follow or hold "text" as they are.
TARGETS = ("techspressionism", "techspressionist", "techspressionists", "techspression")
AFTER_TEXT = tuple(
    """a about after again all also an and any are as at back based be because been before between but by can could
    day did do does doing done down each else even every file files first for from get gets give go goes going good got had has
    have he her here him his how i if image images in into is it its itself just like look looks made make many me message
    messages messaging more most much my new no not now of off on one only or other our out over own per prompt prompts
    question questions read really right said same say see she should show showing so some still such take tell than that
    the their them then there these they thing things this those through to too translation two under underneath up us
    version versions very want was way we well were what when where which while who why will with without work would yes you your
    edit editor edits editing description descriptions box field fields format formats generation generator input inputs
    output outputs line lines paragraph paragraphs string strings window windows""".split()
)
TEXT_WORDS = ("text", "texts", "texted", "texting", "textile", "textiles", "texture", "textures", "textured", "textural", "texturally", "textual", "textually", "textbook", "textbooks")
TEXT_STEMS = ("textbook", "texture", "textile", "textual", "texting", "texted")
#: Letters of names, as they may be written.
NAME_PAIR = r"\b([A-ZÀ-Þ][a-zà-ſ'’\-]+)[ \t]+([A-ZÀ-Þ][A-Za-zà-ſ'’\-]{3,})\b"


def notable_surnames(texts: DataFrame, known: DataFrame, own: DataFrame, key: str, text_col: str = "text", least: float = 0.78, sure: float = 0.86, longer: int = 2) -> DataFrame:
    """(first, last, right, ratio, times, texts, auto, example): capitalised pairs whose first word is a known person's first
    name and whose second is near, but not, that person's last name.

    known(first, last) are persons to correct toward; own(word) are words of names of this corpus, which are never corrected,
    nor is a possessive of a right name. auto where the spelling is close, some sentence speaks of art, and the first name is
    not a common one. The example is the shortest sentence, the first of equals.
    """
    plain = lambda c: F.lower(fold(c))
    people = written(known.select(plain("first").alias("fa"), plain("last").alias("fl"), "last").groupBy("fa", "fl").agg(F.min("last").alias("right")), "known")
    rows = sentences(texts.withColumn(text_col, F.regexp_replace(text_col, "_([^_]+)_", "$1")), [key], text_col)
    each = rows.select(key, "sentence", F.explode(F.regexp_extract_all("sentence", F.lit(NAME_PAIR), F.lit(0))).alias("x"))
    each = each.select(key, "sentence", F.regexp_extract("x", r"^(\S+)", 1).alias("first"), F.regexp_extract("x", r"(\S+)$", 1).alias("last"))
    heard = written(each.withColumn("fa", plain("first")).withColumn("fb", plain("last")), "pairs")
    firsts = people.select("fa").distinct()
    pairs = heard.select("fa", "fb").distinct().hint("merge").join(firsts.hint("merge"), "fa", "left_semi")
    right = people.select("fa", F.col("fl").alias("fb"))
    bare = F.when(F.col("fb").rlike("['’]s$"), F.substring(F.col("fb"), F.lit(1), F.length("fb") - 2)).otherwise(F.col("fb"))
    pairs = pairs.join(right.hint("merge"), ["fa", "fb"], "left_anti").withColumn("bare", bare)
    pairs = pairs.join(right.withColumnRenamed("fb", "bare").hint("merge"), ["fa", "bare"], "left_anti").join(own.select(plain("word").alias("fb")).distinct().hint("merge"), "fb", "left_anti").select("fa", "fb")
    pairs = written(pairs, "open_pairs")
    close = similarity_join(pairs, people, "fb", "fl", least, ["fa"])
    met = pairs.join(close.hint("merge"), "fb").join(people.hint("merge"), ["fa", "fl"])
    best = met.groupBy("fa", "fb").agg(F.max(F.struct("ratio", "fl", "right")).alias("b")).where(F.abs(F.length("fb") - F.length("b.fl")) <= longer)
    hits = heard.hint("merge").join(best.hint("merge"), ["fa", "fb"])
    art = F.col("sentence").rlike(r"(?iU)\b(?:" + "|".join(ART_WORDS) + r")\b")
    found = hits.groupBy("first", "last", "fa", F.col("b.right").alias("right"), F.col("b.ratio").alias("ratio")).agg(
        F.count("*").alias("times"), F.count_distinct(key).alias("texts"), F.bool_or(art).alias("art"), F.min_by("sentence", F.struct(F.length("sentence"), "sentence")).alias("example")
    )
    auto = (F.col("ratio") >= sure) & F.col("art") & ~F.col("fa").isin(*COMMON_FIRST_NAMES)
    return found.select("first", "last", "right", "ratio", "times", "texts", auto.alias("auto"), "example")


def target_suspects(texts: DataFrame, key: str, text_col: str = "text", accepted: DataFrame | None = None, targets: Sequence[str] = TARGETS, least: float = 0.62) -> DataFrame:
    """(key, phrase, score, tier, times): "text" with a word after it that is not ordinary there, or a longer word that begins
    so, each scored once against the target's forms. likely from least on, and for a single word; else weak. accepted(phrase) were
    looked at and are right."""
    word = r"(?i)\b(?:texts?|tex)[-\s]?[A-Za-z][A-Za-z'’]*"
    heard = texts.select(key, F.explode(F.regexp_extract_all(text_col, F.lit(word), F.lit(0))).alias("x"))
    lead = F.regexp_extract("x", r"(?i)^(texts|text|tex)", 1)
    parted = F.col("x").rlike(r"[-\s]")
    # Without a gap the lead and the rest are one word; with one, the rest is a word of its own.
    rest = F.when(parted, F.regexp_extract("x", r"[-\s](.*)$", 1)).otherwise(F.substring(F.col("x"), F.length(lead) + 1, F.length("x")))
    low, one = F.lower(rest), F.lower(F.regexp_replace("x", r"[-\s]", ""))
    known = one.isin(*TEXT_WORDS) | low.isin(*TEXT_WORDS) | low.isin(*AFTER_TEXT) | ~parted & F.lower("x").rlike("|".join(TEXT_STEMS))
    rows = heard.where(~known).select(key, F.replace("x", F.lit("’"), F.lit("'")).alias("phrase"))
    if accepted is not None:
        rows = rows.join(accepted.select(F.lower("phrase").alias("_ok")).distinct().hint("merge"), F.lower("phrase") == F.col("_ok"), "left_anti")
    counts = written(rows.groupBy(key, "phrase").agg(F.count("*").alias("times")), "phrases")
    distinct = written(counts.select("phrase").distinct().withColumn("target", F.explode(F.array(*[F.lit(t) for t in targets]))).withColumn("p", F.regexp_replace(F.lower("phrase"), "[^a-z]", "")), "distinct_phrases")
    scores = distinct.withColumn("r", ratcliff_ratio("p", "target")).groupBy("phrase").agg(F.max("r").alias("score"))
    tier = F.when((F.col("score") >= least) | ~F.col("phrase").rlike("[ -]"), "likely").otherwise("weak")
    return counts.join(scores.hint("merge"), "phrase").select(key, "phrase", "score", tier.alias("tier"), "times")
