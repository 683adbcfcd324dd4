"""Language ID by rank-order profiles of character n-grams.

A profile is a language's most frequent 1- to 3-grams in order. A document's own most frequent n-grams are compared to
each profile by the sum of the places by which their ranks differ; the language out of place the least wins. Counting
n-grams is array work inside Arrow batches; summing them by language and ranking them is Spark's.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc32_id, letting_go, texts

TOP = 400
#: Code points whose n-grams are counted at a time, so that one long text takes bounded memory.
BLOCK = 1 << 20
#: Distinct n-grams that a training task holds for a language before it passes their counts on.
HELD = 1 << 18
MAX_LANGUAGES = 2000
UNKNOWN = "und"
#: A language's floor is this part of this quantile of its own rows' scores.
LOW_QUANTILE, MARGIN = 0.01, 0.75
SPACE = 32


@functools.cache
def _letters() -> np.ndarray:
    """By code point: whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _sum_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(keys, return_inverse=True)
    return keys, np.bincount(at, counts, len(keys)).astype(np.int64)


def ngrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a whole text, as three code points of 21 bits each, and their counts; none without a letter.

    Upper case is lowered; each run of other characters than letters is one space, as are both ends; n-grams with a
    space between letters, and the space itself, don't count.
    """
    codes = np.frombuffer(text.decode("utf-8").lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.where(letter, codes, SPACE)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    codes = np.concatenate(([SPACE], codes[keep], [SPACE])).astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for lo in range(0, len(codes), BLOCK):
        c = codes[max(0, lo - 2) : lo + BLOCK]
        new = lo - max(0, lo - 2)  # what comes before has been counted
        space = c == SPACE
        one = c[new:][~space[new:]]
        at = max(0, new - 1)
        two = ((c[:-1] << 21) | c[1:])[at:][~(space[:-1] & space[1:])[at:]]
        three = ((c[:-2] << 42) | (c[1:-1] << 21) | c[2:])[~space[1:-1]]
        keys = np.sort(np.concatenate((one, two, three)))
        first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        found.append((keys[first], np.diff(np.append(first, len(keys)))))
    return found[0] if len(found) == 1 else _sum_by_key(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))


def ranks(counts: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the top most frequent, and their ranks from 0; equal counts share their mean rank. A tie at the end
    goes to the smaller n-grams."""
    order = np.argsort(-counts, kind="stable")[:top]
    sorted_counts = counts[order]
    first = np.flatnonzero(np.concatenate(([True], sorted_counts[1:] != sorted_counts[:-1])))
    size = np.diff(np.append(first, len(order)))
    return order, np.repeat(first + (size - 1) / 2, size)


def train_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """(lang, gram, place): each language's top n-grams over all rows with a language, from place 0; ties go to the
    smaller n-gram. Null texts count as empty."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[str, int] = {}

        def merged(lang: str) -> None:
            parts = held[lang]
            held[lang] = [_sum_by_key(np.concatenate([k for k, _ in parts]), np.concatenate([n for _, n in parts]))]
            sizes[lang] = len(held[lang][0][0])

        def out(lang: str) -> pa.RecordBatch:
            merged(lang)
            keys, n = held.pop(lang)[0]
            sizes.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                found = ngrams(text)
                held.setdefault(lang, []).append(found)
                sizes[lang] = sizes.get(lang, 0) + len(found[0])
                if sizes[lang] > 2 * HELD:
                    merged(lang)
                    if sizes[lang] > HELD:
                        yield out(lang)
            if sum(sizes.values()) > 4 * HELD:  # many languages
                for lang in list(held):
                    yield out(lang)
        for lang in list(held):
            yield out(lang)

    labelled = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    totals = labelled.mapInArrow(letting_go(count), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ranked = totals.withColumn("place", place).where(F.col("place") <= top)  # a filter that Spark turns into a limit for each language before the shuffle
    return ranked.select("lang", "gram", (F.col("place") - 1).alias("place"))


class Profiles:
    """The profiles as arrays: for each known n-gram its place in each language, top where it has none."""

    def __init__(self, rows: list, top: int = TOP):
        self.top = top
        self.langs = sorted({r["lang"] for r in rows})
        self.grams = np.unique(np.array([r["gram"] for r in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.langs)), top, np.float64)  # the last: unknown
        at = {x: i for i, x in enumerate(self.langs)}
        for i, r in zip(np.searchsorted(self.grams, [r["gram"] for r in rows]), rows, strict=True):
            self.places[i, at[r["lang"]]] = r["place"]

    def predict(self, text: bytes) -> tuple[str, float]:
        """The language out of place the least, and 1 less its mean distance as a part of the largest possible."""
        grams, counts = ngrams(text)
        if not len(grams) or not self.langs:
            return UNKNOWN, 0.0
        order, rank = ranks(counts, self.top)
        grams = grams[order]
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == grams, at, len(self.grams))
        places = self.places[at]
        away = np.where(places < self.top, np.minimum(np.abs(places - rank[:, None]), self.top), self.top).sum(0)
        best = int(np.argmin(away))  # of equals the first by name
        return self.langs[best], float(1 - away[best] / (self.top * len(grams)))


def collect_profiles(profiles: DataFrame, top: int = TOP) -> Profiles:
    """To the driver: top rows a language at most, and MAX_LANGUAGES languages."""
    rows = profiles.limit(MAX_LANGUAGES * top + 1).collect()
    if len(rows) > MAX_LANGUAGES * top:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Profiles(rows, top)


def predict_languages(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: id_col, lang_pred, score.

    A null text, and one without a letter, is und with score 0, as is any text where nothing was learned. Null ids and
    repeated rows are carried through. Other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # MAX_LANGUAGES * top rows at most

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [shared.value.predict(t) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(letting_go(predict), f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", id_col)


def is_held_out(id_col: str = "doc_id"):
    """Rows that nothing is learned from; a null id is not held out, nor learned from."""
    return F.coalesce(crc32_id(F.col(id_col)) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> Profiles:
    """Profiles from all rows that have a language and are not held out."""
    return collect_profiles(train_profiles(docs.where(crc32_id(F.col(id_col)) % 4 != 2), lang_col, text_col, top), top)


def identify(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """Learn and predict: id_col, lang_pred, score; see predict_languages."""
    return predict_languages(docs, fit(docs, id_col, lang_col, text_col, top), id_col, text_col)


def score_floors(docs: DataFrame, profiles: Profiles, lang_col: str = "lang", text_col: str = "text") -> dict[str, float]:
    """For each language, a low quantile, less a margin, of the scores of all rows that have it as their language and are
    found to be in it: texts in it score above, other languages and letters at random below."""
    scored = predict_languages(docs.where(F.col(lang_col).isNotNull()), profiles, lang_col, text_col)
    right = scored.where(F.col("lang_pred") == F.col(lang_col).cast("string"))
    rows = right.groupBy("lang_pred").agg(F.percentile_approx("score", F.lit(LOW_QUANTILE), F.lit(10_000)).alias("q")).limit(MAX_LANGUAGES).collect()
    return {r.lang_pred: MARGIN * r.q for r in rows}


def keep_known_languages(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", min_score: float = 0.05) -> DataFrame:
    """docs without the rows whose language stays unknown or scores under its floor (see score_floors), or under
    min_score; all columns are kept.

    The floors come from the rows that profiles are learned from. Each row is judged where it is: no join, no shuffle.
    """
    profiles = fit(docs, id_col, lang_col, text_col)
    floors = score_floors(docs.where(crc32_id(F.col(id_col)) % 4 != 2), profiles, lang_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((profiles, floors))
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, least = shared.value
        for b in batches:
            found = (known.predict(t) for t in texts(b.column(at)))
            yield b.filter(pa.array([lang != UNKNOWN and score >= max(min_score, least.get(lang, 0.0)) for lang, score in found], pa.bool_()))

    return docs.mapInArrow(letting_go(keep), docs.schema)
