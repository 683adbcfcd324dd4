import re
import uuid

import pyarrow as pa
import pytest

from tessitura.functions.tables import shared_dir
from tessitura.operators import text_index
from tessitura.operators.search import parse_query
from tessitura.operators.text_index import TextIndex, stored_index


def plain(texts, query):
    found = {}
    for k, t in texts.items():
        words = re.findall(r"[\w']+", (t or "").lower())
        counts = [sum(words[i : i + len(p)] == p for i in range(len(words))) for p in parse_query(query)]
        if counts and min(counts) > 0:
            found[k] = sum(counts)
    return found


QUERIES = ["cat", '"the cat"', 'the "cat sat"', "dog cat", '"cat cat"', "unheard", "the", ""]


def check(index, texts):
    for q in QUERIES:
        assert {r.doc_id: r.hits for r in index.find_all(q).collect()} == plain(texts, q), q


def frame(spark, texts):
    return spark.createDataFrame(list(texts.items()), "doc_id long, text string")


def test_adds_deletes_and_merges(spark):
    path = f"{shared_dir(spark)}/idx-{uuid.uuid4().hex}"
    index = TextIndex(spark, path, parts=4, slices=2)
    assert index.find_all("cat").count() == 0 and index.bm25("cat").count() == 0
    texts = {1: "The cat sat. The cat sat!", 2: "a dog and a cat cat cat", 3: None, 4: "", 5: "the dog"}
    assert index.add("a", frame(spark, texts))
    assert not index.add("a", frame(spark, {9: "cat"}))  # sent again
    check(index, texts)
    more = {2: "the dog left", 6: "cat cat", 7: "The cat sat on the mat's edge"}
    assert index.add("b", frame(spark, more))  # 2 is replaced
    texts |= more
    check(index, texts)
    assert index.delete("c", spark.createDataFrame([(1,), (99,)], "doc_id long")) and not index.delete("c", spark.createDataFrame([(7,)], "doc_id long"))
    del texts[1]
    check(index, texts)
    before = {r.doc_id: round(r.score, 9) for r in index.bm25("the cat").collect()}
    index.merge()
    assert len(index.markers()) == 1
    check(index, texts)
    assert {r.doc_id: round(r.score, 9) for r in index.bm25("the cat").collect()} == before
    assert index.add("d", frame(spark, {1: "cat"}))  # it may come again
    texts[1] = "cat"
    check(index, texts)
    with pytest.raises(ValueError):
        index.add("e", frame(spark, {1: "x"}).union(frame(spark, {1: "y"})))
    check(index, texts)  # what broke off doesn't count


def test_a_lookup_reads_its_partitions(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    index = stored_index(spark, shared_dir(spark), docs, "doc_id")
    plan = index.find_all("this")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part", plan)
    files = index.postings(["this"]).inputFiles()
    assert len(index.markers()) == 1 and len({f.split("part=")[1].split("/")[0] for f in files}) >= 1
    assert stored_index(spark, shared_dir(spark), docs, "doc_id").path == index.path


def test_query_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    index = stored_index(spark, shared_dir(spark), docs, "doc_id")
    for q in ('this and "of the"', "eau", '"in the"'):
        assert {r.doc_id: r.hits for r in index.find_all(q).collect()} == plain(texts, q)


def test_blocks_are_made_where_texts_are_read(spark, monkeypatch):
    words = {k: [f"w{(k * 7 + i * i) % 5}" for i in range(k % 9)] for k in range(40)}
    batch = pa.RecordBatch.from_arrays([pa.array(words), pa.array(words.values(), pa.list_(pa.string()))], names=["key", "w"])
    monkeypatch.setattr(text_index, "BLOCK_WORDS", 10)
    found, listed, blocks = {}, {}, 0
    for block in text_index._blocks(iter([batch, batch.slice(0, 0)])):
        for r in block.to_pylist():
            at = iter(r["places"])
            if r["term"] is None:
                blocks += 1
                listed |= dict(zip(r["keys"], r["lens"], strict=True))
                continue
            for k, n, c in zip(r["keys"], r["lens"], r["counts"], strict=True):
                assert n == len(words[k]) and (k, r["term"]) not in found
                found[k, r["term"]] = [next(at) for _ in range(c)]
            assert not list(at)
    assert listed == {k: len(w) for k, w in words.items()} and blocks > 10
    assert found == {(k, t): [i for i, x in enumerate(w) if x == t] for k, w in words.items() for t in w}
    path = f"{shared_dir(spark)}/idx-{uuid.uuid4().hex}"
    index = TextIndex(spark, path)
    assert index.add("a", spark.createDataFrame([(k, "the cat sat") for k in range(400)], "doc_id long, text string").coalesce(1))
    assert spark.read.parquet(f"{path}/postings").where("term = 'cat'").count() == 1  # a row for a block, not for each text
    assert index.find_all('"the cat"').count() == 400


def test_relevance_of_odd_texts_against_sql(spark, sf_dir, tmp_path):
    """Texts without a word, and letters that Java's and SQL's classes and lower case take in different ways."""
    from tessitura import plans

    from ..oracle import TABLES, compare

    for t in TABLES:
        if t != "documents":
            (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    odd = [None, "", "... !!!", "eau m² ½ ²", "thing a‿b", "eau ⓐ", "thing‌s eau", "THİNG eau", "Ⅷ thing", "٣ eau ⁀"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs.union(spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(odd)], docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("q6_relevance", "q1_find_all"):
        compare(spark, plans.QUERIES[name], plans.ORACLES[name], str(tmp_path))


def test_texts_without_a_word_change_no_score(spark):
    index = TextIndex(spark, f"{shared_dir(spark)}/idx-{uuid.uuid4().hex}", parts=4, slices=2)
    scores = lambda: {r.doc_id: round(r.score, 9) for r in index.bm25("the cat").collect()}
    assert index.add("a", frame(spark, {1: "the cat sat", 2: "a cat and the cat", 3: "two dogs"}))
    want = scores()
    assert index.add("b", frame(spark, {4: None, 5: "...", 6: ""})) and index.markers()[-1]["docs"] == 0
    assert scores() == want
    assert index.add("c", frame(spark, {3: "two dogs", 7: "?"}))  # 3 is replaced: scores are taken with deletes
    assert scores() == want
    index.merge()
    assert scores() == want
    assert index.add("d", frame(spark, {5: "cat", 1: ""}))
    check(index, {2: "a cat and the cat", 3: "two dogs", 5: "cat"})
