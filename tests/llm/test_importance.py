import hashlib
import math
import re
import zlib
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from tessitura.llm import queries
from tessitura.llm.importance import feature_hashes, resample, words_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def grams(words, longest):
    return [b" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, buckets=10_000, longest=1, least=20, drawn=10, seed=2024):
    made = [(d, plain_words(t), grams(plain_words(t), longest)) for d, t in docs]
    s, t = (Counter(zlib.crc32(f) % buckets for f in fs) for fs in ([f for *_, fs in made for f in fs], [f for x in target for f in grams(plain_words(x), longest)]))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for d, words, fs in made:
        weight = sum(gain[zlib.crc32(f) % buckets] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words)))
    order = sorted((i for i, r in enumerate(rows) if r[4] >= least), key=lambda i: (-rows[i][3], -1 if rows[i][0] is None else rows[i][0]))
    rank = {i: k for k, i in enumerate(order[: drawn * len(order) // 100], 1)}
    return [(*r[:4], rank.get(i)) for i, r in enumerate(rows)]


key = lambda r: [(x is None, x) for x in r]


@given(st.lists(st.sampled_from(["A", "b", "é", "Ä", "9", "'", " ", "\x00", "_", "漢", "\n", "[", "{", "\x7f", "z"])).map("".join), st.integers(1, 4))
def test_features(text, longest):
    words = words_of(text.encode())
    assert words == plain_words(text)
    assert feature_hashes(words, longest) == [zlib.crc32(f) for f in grams(words, longest)]


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = [tuple(r) for r in queries.QUERIES["op12_importance"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(plain(docs, target), key=key) or sorted(got, key=key) == sorted(plain(docs, target), key=key)


def test_pairs_and_edges(spark):
    rows = [(i, f"plain words about thing {i % 5} and more of it", "x") for i in range(40)]
    rows += [(100, None, "n"), (101, "", "n"), (102, "-- !", "n"), (None, "exam question about a proof", "q"), (103, "word " * 200_000 + "end", "l"), (104, "exam question", "q"), (104, "exam question", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    target = spark.createDataFrame([("Exam question: a PROOF",), (None,)], "text string")
    options = {"buckets": 64, "longest": 3, "least_words": 5, "drawn": 50}
    got = [tuple(r) for r in resample(docs, target, **options).collect()]
    want = plain([r[:2] for r in rows], ["Exam question: a PROOF", None], 64, 3, 5, 50)
    assert sorted(got, key=key) == sorted(want, key=key)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, 22))
    # Ties: equal rows have equal scores, and get ranks of their own.
    same = spark.createDataFrame([(7, "a b c d e")] * 10, "doc_id long, text string")
    assert sorted(r.rank for r in resample(same, target, least_words=1, drawn=30).collect() if r.rank) == [1, 2, 3]
    nothing = resample(docs.limit(0), target)
    assert nothing.columns == ["doc_id", "n_features", "weight", "score", "rank"] and nothing.count() == 0
    assert resample(docs, target.limit(0)).count() == len(rows)
