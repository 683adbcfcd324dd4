import hashlib

from tessitura.llm import queries
from tessitura.llm.exact_dedup import drop_exact_copies, exact_dedup, refine

from ..oracle import compare

SCHEMA = "doc_id long, text string, kept string, n int"


def test_edges(spark):
    rows = [(1, "Ab É", "x", 1), (2, "aB É", "y", None), (3, "ab é", None, 3), (4, None, "z", 4), (5, "", "z", 5), (6, "one", "a", 1), (6, "one", "b", 2), (None, "solo", "a", 1), (None, "ab É", "a", 1), (9, "q" * 300_000, "l", 1), (8, "Q" * 300_000, "l", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = exact_dedup(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    found = sorted(((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in got.collect()))
    assert found == [(-1, -1, 1, True), (-1, 2, 3, False), (1, 2, 3, False), (2, 2, 3, True), (3, 3, 1, True), (4, 5, 2, False), (5, 5, 2, True), (6, 6, 2, False), (6, 6, 2, True), (8, 9, 2, False), (9, 9, 2, True)]
    sha = {r.doc_id: r.text_sha256 for r in got.collect()}
    assert sha[3] == hashlib.sha256("ab é".encode()).hexdigest() and sha[4] == hashlib.sha256(b"").hexdigest()
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, (r.text or "")[:3]) for r in kept.collect()) == [(-1, "sol"), (2, "aB "), (3, "ab "), (5, ""), (6, "one"), (9, "qqq")]


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exact_dedup(docs).count() == 0 and drop_exact_copies(docs).count() == 0


def test_sql(spark, sf_dir):
    compare(spark, queries.QUERIES["op5_exact_dedup"], queries.ORACLES["op5_exact_dedup"], sf_dir)


def test_levels_leave_ever_less(spark):
    """Each level drops rows that the one before it could not."""
    rows = spark.createDataFrame([(i, i) for i in range(10)] + [(50, i) for i in range(10)] + [(60, 7)] * 3, "len int, prefix long")
    by_length, by_prefix = refine(rows)
    assert rows.count() == 23 and by_length.count() == 13 and by_prefix.count() == 3


def test_same_prefix_and_clashing_names(spark):
    """Texts that length and prefix can't tell apart, and columns that are named as the operator's own."""
    rows = [(i, "x" * 100 + str(i), 1, "a") for i in range(5)] + [(9, "X" * 100 + "3", 2, "b"), (9, "x" * 100 + "3", 3, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, len int, _key string")
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 4, 9]
    assert sum(r.kept for r in exact_dedup(docs).collect()) == 5
