import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessitura.llm import queries
from tessitura.llm.runs import find_runs, numbered, runs_of_block, small_children, suffix_array


def plain_runs(words, min_words=6, min_periods=4):
    """Every period and every stretch that keeps it, by comparing words."""
    n, found = len(words), []
    for q in range(1, n // min_periods + 1):
        i = 0
        while i + q < n:
            if words[i] == words[i + q]:
                j = i
                while j + q < n and words[j] == words[j + q]:
                    j += 1
                length = j - i + q
                smaller = any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q))
                if length >= max(min_words, min_periods * q) and not smaller:
                    found.append((i, length, q))
                i = j
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_rows(docs):
    for doc_id, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = None
        for r in runs:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        lines, kept = "".join(f"{s},{length},{q}\n" for s, length, q in runs), " ".join(w for i, w in enumerate(words) if i not in gone)
        yield (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(kept))


pieces = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9)), max_size=5)
texts_of = st.lists(pieces.map(lambda ps: [x for root, k in ps for x in root * k][:90]), min_size=1, max_size=4)


@settings(max_examples=300, deadline=None)
@given(texts_of, st.sampled_from([(6, 4), (1, 2), (9, 3), (5, 5)]))
def test_runs(docs, least):
    words = np.array([x for d in docs for x in d], np.int64)
    assert runs_of_block(words, [len(d) for d in docs], *least) == [plain_runs(d, *least) for d in docs]


@settings(max_examples=100, deadline=None)
@given(texts_of)
def test_suffix_array(docs):
    words = np.array([x for d in docs for x in d], np.int64)
    ends = np.array([e for k in range(len(docs)) for e in [sum(map(len, docs[: k + 1]))] * len(docs[k])], np.int64)
    if not len(words):
        return
    order, place, lcp = suffix_array(words, ends)
    suffix = [(int(ends[i]), words[i : ends[i]].tolist()) for i in range(len(words))]
    assert order.tolist() == sorted(range(len(words)), key=lambda i: suffix[i])
    assert place[order].tolist() == list(range(len(words)))

    def common(i, j):
        (a, x), (b, y) = suffix[i], suffix[j]
        n = 0
        while a == b and n < min(len(x), len(y)) and x[n] == y[n]:
            n += 1
        return n

    assert lcp.tolist() == [0, *(common(order[k - 1], order[k]) for k in range(1, len(words)))]
    for depth, first, last, child, end in small_children(lcp, lambda d: 1):
        assert min(lcp[first + 1 : last + 1]) == depth and first <= child < end <= last + 1
        assert lcp[first] < depth and (last + 1 == len(lcp) or lcp[last + 1] < depth) or first == 0


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, sf_dir).collect())
    short = [d for d in docs if len((d[1] or "").split()) < 1500]  # comparing all words takes the square of the words
    ids = {d for d, _ in short}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert [g for g in got if g[0] in ids] == sorted(plain_rows(short))
    assert sum(g[1] > 0 for g in got) > 10


def test_edges(spark):
    again = "go away now " * 5
    rows = [(1, None, "x"), (2, "", "x"), (3, "a " * 6, "x"), (4, "a " * 5, "x"), (5, f"so {again}then", "x"), (5, f"so {again}then", "x"), (None, "b c " * 4, "x"), (6, "z " * 400_000, "x"), (7, "  \n\t ", "x"), (8, "one two three", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = {}
    for r in find_runs(docs, block_words=64).collect():
        got.setdefault(r.doc_id, []).append((r.n_words, [tuple(x) for x in r.runs], r.collapsed))
    assert got[1] == got[2] == got[7] == [(0, [], "")]
    assert got[3] == [(6, [(0, 6, 1)], "a")] and got[4] == [(5, [], "a a a a a")]
    assert got[5] == [(17, [(1, 15, 3)], "so go away now then")] * 2
    assert got[None] == [(8, [(0, 8, 2)], "b c")] and got[6] == [(400_000, [(0, 400_000, 1)], "z")]
    assert got[8] == [(3, [], "one two three")]
    assert find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        find_runs(docs, min_periods=1)


def test_numbers():
    assert numbered([b"a", b"b", b"a", b""]).tolist() == [0, 1, 0, 2]
