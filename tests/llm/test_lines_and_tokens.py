from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

from tessitura.llm import queries
from tessitura.llm.common import shared_dir
from tessitura.llm.line_dedup import drop_repeated_lines
from tessitura.llm.token_counts import TokenRollup, count_tokens

from ..oracle import compare

DOCS = "doc_id long, text string, source string, lang string, first string"


def test_line_sql(spark, sf_dir):
    compare(spark, queries.QUERIES["op3_line_dedup"], queries.ORACLES["op3_line_dedup"], sf_dir)


def test_line_edges(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\n\nc\nd\ny"), (3, "a\nb\nc"), (4, "a\nb"), (5, None), (6, ""), (7, "q\nq\nq\nq\nq"), (None, "m\nn\no"), (9, "m\nn\no"), (9, "m\nn\no"), (10, "\n".join(f"l{i}" for i in range(30_000))), (11, "\n".join(f"l{i}" for i in range(30_000)))]
    docs = spark.createDataFrame([(*r, "s", "e", "f") for r in rows], DOCS)
    got = defaultdict(list)
    for r in drop_repeated_lines(docs).collect():
        got[r.doc_id].append((r.n_lines, r.n_removed, r.text))
    assert got[1] == [(4, 0, "a\nb\nc\nd")]
    assert got[2] == [(7, 5, "x\ny")]
    assert got[3] == [(3, 3, "")] and got[4] == [(2, 0, "a\nb")] and got[5] == [(0, 0, None)] and got[6] == [(1, 0, "")]
    assert got[7] == [(5, 4, "q")]
    assert got[None] == [(3, 0, "m\nn\no")] and got[9] == [(3, 3, "")] * 2
    assert got[10][0][1] == 0 and got[11] == [(30_000, 30_000, "")]
    assert drop_repeated_lines(docs.limit(0)).count() == 0


def test_many_ranges(spark):
    once = [f"n{i}" for i in range(40_000)]
    for i in range(0, 40_000, 10):
        once[i : i + 3] = ["a", "b", "c"]
    docs = spark.createDataFrame([(1, "a\nb\nc", "s", "e", "f"), (2, "\n".join(once), "s", "e", "f")], DOCS)
    got = {r.doc_id: r for r in drop_repeated_lines(docs).collect()}
    assert got[2].n_removed == 12_000 and got[2].text == "\n".join(x for x in once if len(x) > 1)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in rollup.totals().collect()}


def test_rollup(spark):
    docs = lambda rows: spark.createDataFrame([(*r, "f") for r in rows], DOCS)
    count = lambda rows: count_tokens(docs(rows), {"w": None})
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/rollup-test")
    assert totals(rollup) == {}
    assert rollup.apply("1", count([(1, "a b c", "s", "en"), (2, "a", "s", "de"), (3, None, None, None), (None, "x y", "t", "en"), (4, "a b", "s", "en"), (4, "a b", "s", "en")]))
    first = {("s", "en", "w"): (3, 7), ("s", "de", "w"): (1, 1), (None, None, "w"): (1, 0), ("t", "en", "w"): (1, 2)}
    assert totals(rollup) == first
    assert not rollup.apply("1", count([(1, "a b c", "s", "en")])) and totals(rollup) == first
    gone = spark.createDataFrame([(2,), (99,), (None,), (1,)], "doc_id long")
    assert rollup.apply("2", count([(1, "a", "t", "en")]), gone)
    assert totals(rollup) == {("t", "en", "w"): (1, 1), (None, None, "w"): (1, 0), ("s", "en", "w"): (2, 4)}
    # A batch that broke off before its marker is written over.
    spark.createDataFrame([(7, "s", "en", "w", 1, 100)], "doc_id long, source string, lang string, tokenizer string, docs long, n_tokens long").write.parquet(f"{rollup.path}/ledger/3")
    assert totals(rollup)[("s", "en", "w")] == (2, 4)
    assert rollup.apply("3", count([(4, "", "s", "en")])) and totals(rollup)[("s", "en", "w")] == (1, 0)
    assert rollup.apply("4", count([]))


def test_query_against_brute_force(spark, sf_dir):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    labels = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    want = defaultdict(lambda: [0, 0])
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        mark = labels.get(r.doc_id)
        if mark and mark.quality == 0:
            continue
        text = r.text
        if mark and mark.toxic == 1:
            import re

            text = re.sub(r"[ \t\n\x0b\f\r]+", " ", text)
        for name, n in (("byte_bpe_50k", len(t.encode(text, add_special_tokens=False).ids)), ("words", len(text.encode().split()))):
            want[r.source, r.lang, name][0] += 1
            want[r.source, r.lang, name][1] += n
    got = queries.QUERIES["op1_token_counts"](spark, sf_dir).collect()
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in got} == want
