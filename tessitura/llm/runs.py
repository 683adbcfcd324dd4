"""Periodic runs of words, by the branching-tandem test over an enhanced suffix array.

A run is a longest stretch of words that repeats with a period. Its last square (two periods side by side) is branching:
the words after its two halves differ, or the text ends. So the halves' suffixes lie in different children of one
interval of the LCP array, whose depth is the period. For each interval it is enough to take the suffixes of all
children but the largest and to look, by the inverse suffix array, whether the suffix a depth before or after lies in
the same interval: each suffix is looked at for log n intervals at most. A branching square is rotated to the left while it
stays a square, which gives the whole run; squares of a multiple of a run's period, at the same end, are merged into it.

Suffix arrays are made for some texts at a time by prefix doubling: a text's number is part of its words' first ranks, so
texts never compare to each other, and only suffixes that are not told apart yet are sorted again. LCP values come
from the ranks of each doubling. Intervals are kept on a stack as they open and close; no tree is made.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts

#: A run has at least so many words and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words whose suffixes are sorted at a time; a longer text is sorted alone.
BLOCK_WORDS = 1 << 17


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes in order, each one's place, and the LCP of each with the one before it.

    words are numbers; ends has, for each word, where its text ends. Suffixes of different texts share nothing.
    """
    n = len(words)
    first = ends * (int(words.max(initial=0)) + 1) + words
    order = np.argsort(first, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def ranked(places: np.ndarray, suffixes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Give suffixes, at places, their group's first place; return which are in groups of two or more."""
        group = np.maximum.accumulate(np.where(starts, places, -1))
        rank[suffixes] = group
        alone = starts & np.append(starts[1:], True)
        return ~alone

    sorted_first = first[order]
    starts = np.append(True, sorted_first[1:] != sorted_first[:-1])
    places = np.arange(n)
    open_ = ranked(places, order, starts)
    levels = [rank.copy()]
    step = 1
    while open_.any():
        places = places[open_]
        suffixes = order[places]
        after = suffixes + step
        inside = after < ends[suffixes]
        key = rank[suffixes] * (n + 1) + np.where(inside, rank[np.where(inside, after, n)] + 1, 0)
        by = np.argsort(key, kind="stable")
        suffixes, key = suffixes[by], key[by]
        order[places] = suffixes
        open_ = ranked(places, suffixes, np.append(True, key[1:] != key[:-1]))
        step *= 2
        if open_.any():
            levels.append(rank.copy())
    place = rank[:n]
    lcp = np.zeros(n, np.int64)
    pairs = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    left, right = order[pairs - 1], order[pairs]
    found = np.zeros(len(pairs), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][left + found] == levels[k][right + found]
        found[same] += 1 << k
    lcp[pairs] = found
    return order, place, lcp


def small_children(lcp: np.ndarray, fewest: Callable[[int], int]) -> Iterator[tuple[int, int, int, int, int]]:
    """For each interval of the LCP array, each child but the largest: (depth, the interval's first and last place, the
    child's first place and the one after its last). Intervals with too few suffixes for their depth are passed over."""
    places = np.flatnonzero(lcp > 0)
    stack: list[tuple[int, int, list[int]]] = []  # depth, first place, where its children after the first begin

    def close(depth: int, first: int, cuts: list[int], last: int) -> Iterator[tuple[int, int, int, int, int]]:
        if last - first + 1 >= fewest(depth):
            bounds = [first, *cuts, last + 1]
            largest = max(range(len(bounds) - 1), key=lambda k: bounds[k + 1] - bounds[k])
            for k in range(len(bounds) - 1):
                if k != largest:
                    yield depth, first, last, bounds[k], bounds[k + 1]

    previous = -2
    for at, depth in zip(places.tolist(), lcp[places].tolist(), strict=True):
        if at != previous + 1:  # an LCP of zero lies between
            while stack:
                yield from close(*stack.pop(), previous)
        first = at - 1
        while stack and stack[-1][0] > depth:
            d, first, cuts = stack.pop()
            if at - first >= fewest(d):
                yield from close(d, first, cuts, at - 1)
        if stack and stack[-1][0] == depth:
            stack[-1][2].append(at)
        else:
            stack.append((depth, first, [at]))
        previous = at
    while stack:
        yield from close(*stack.pop(), previous)


def branching_squares(words: np.ndarray, ends: np.ndarray, fewest: Callable[[int], int]) -> list[tuple[int, int]]:
    """(start, half) of the branching squares, by their end and half, that a run with enough periods can end with."""
    order, place, lcp = suffix_array(words, ends)
    found = np.array(list(small_children(lcp, fewest)), np.int64).reshape(-1, 5)
    if not len(found):
        return []
    size = found[:, 4] - found[:, 3]
    row = np.repeat(np.arange(len(found)), size)
    within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    depth, first, last, child, child_end = (found[row, k] for k in range(5))
    suffix = order[child + within]
    squares = set()
    for sign in (1, -1):
        other = suffix + sign * depth
        inside = (other >= 0) & (other < len(words))
        at = place[np.where(inside, other, 0)]
        hit = inside & (at >= first) & (at <= last) & ~((at >= child) & (at < child_end))
        squares.update(zip(np.minimum(suffix, other)[hit].tolist(), depth[hit].tolist(), strict=True))
    return sorted(squares, key=lambda s: (s[0] + 2 * s[1], s[1]))


def rotated(words: np.ndarray, start: int, half: int, least: int) -> int:
    """How far to the left a square at start can be rotated, not beyond least; looked at in growing blocks."""
    at, block = start, 16
    while at > least:
        k = min(block, at - least)
        differ = np.flatnonzero(words[at - k : at] != words[at - k + half : at + half])
        if len(differ):
            return start - (at - k + int(differ[-1]) + 1)
        at -= k
        block *= 2
    return start - at


def runs_of_block(words: np.ndarray, lengths: Sequence[int], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[list[tuple[int, int, int]]]:
    """For each text of a block, laid end to end, its runs (start, length, period) by start and period."""
    text_ends = np.fromiter(accumulate(lengths), np.int64, len(lengths))
    found: list[list[tuple[int, int, int]]] = [[] for _ in lengths]
    if not len(words):
        return found
    of_text = np.repeat(np.arange(len(lengths)), lengths)
    shortest = lambda period: max(min_words, min_periods * period)
    # A run of period q with L words holds its root floor(L / q) times, all in the interval whose depth is q.
    squares = branching_squares(words, text_ends[of_text], lambda depth: shortest(depth) // depth)
    last_end, runs = -1, []
    for start, half in squares:
        end = start + 2 * half
        if end != last_end:
            last_end, runs = end, []
        if any(half % period == 0 and 2 * half <= length for length, period in runs):
            continue  # not the smallest period: the run is known
        text = int(of_text[start])
        base = int(text_ends[text]) - lengths[text]
        length = 2 * half + rotated(words, start, half, base)
        if length >= shortest(half):
            runs.append((length, half))
            found[text].append((end - length - base, length, half))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in found]


def numbered(words: Sequence[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def collapsed(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return list(words)
    gone = bytearray(len(words))
    for start, length, period in runs:
        gone[start + period : start + length] = b"\1" * (length - period)
    return [w for w, g in zip(words, gone, strict=True) if not g]


def find_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS, words_of: Callable[[object, list[bytes]], list[bytes]] | None = None, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """One row for each row of docs: id_col, n_words, runs (array of start, length, period by start and period) and collapsed,
    the words outside the repeats joined by one space.

    A run is at least min_words long and holds its smallest period at least min_periods times, 2 or more. words_of(id,
    words) may give other words for a text. A null text has no words. Null ids and repeated rows are carried through; other columns are not looked at; no rows give no rows.
    Memory goes with block_words or the longest text: some 200 bytes a word.
    """
    if min_periods < 2:
        raise ValueError("min_periods must be 2 or more: what comes once is no run")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for b in batches:
            found: list[list[tuple[int, int, int]]] = []
            kept: list[bytes] = []
            sizes: list[int] = []

            def flush(part: list[list[bytes]], found=found, kept=kept, sizes=sizes) -> None:
                numbers = numbered([w for words in part for w in words])
                for words, runs in zip(part, runs_of_block(numbers, [len(w) for w in part], min_words, min_periods), strict=True):
                    sizes.append(len(words))
                    found.append(runs)
                    kept.append(b" ".join(collapsed(words, runs)))

            part, size = [], 0
            for i, text in zip(b.column(0), texts(b.column(1)), strict=True):
                words = text.split()
                if words_of is not None:
                    words = words_of(i.as_py(), words)
                if part and size + len(words) > block_words:
                    flush(part)
                    part, size = [], 0
                part.append(words)
                size += len(words)
            flush(part)
            structs = [[{"start": s, "length": n, "period": p} for s, n, p in runs] for runs in found]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(structs, run_type), pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def strongest(runs: Column) -> Column:
    """Of runs by start and period, the one with the greatest length / period, exactly; of ties the first. Null without runs."""
    better = lambda best, r: r["length"] * best["period"] > best["length"] * r["period"]
    return F.aggregate(F.slice(runs, 2, F.size(runs)), F.get(runs, 0), lambda best, r: F.when(better(best, r), r).otherwise(best))
