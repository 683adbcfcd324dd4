import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessitura.llm import queries
from tessitura.llm.packing import CapacityTree, best_fit, encoder, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def check(tokenizer, docs, rows, window=1024):
    ids = {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0] for i, t in docs.items()}
    pieces, used = defaultdict(list), defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
        used[r.sequence_id].append((r.offset, r.length))
    for group, total in [(pieces, {i: len(x) for i, x in ids.items()}), (used, None)]:
        for k, spans in group.items():
            at = 0
            for start, n in sorted(spans):
                assert start == at
                at += n
            assert at == total[k] if total else at <= window
    assert set(pieces) == set(ids)
    return used


def test_query(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    used = check(tokenizer, docs, queries.QUERIES["op2_packing"](spark, sf_dir).collect())
    total = sum(n for spans in used.values() for _, n in spans)
    assert total / (1024 * len(used)) > 0.98


def test_edges(spark, tokenizer):
    docs = {1: None, 2: "", 3: "a" * 50_000, 4: "x <|endoftext|> y", 5: "é" * 1023, 6: "word " * 1023}
    rows = [(i, t, "s", 0) for i, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string, start string, grp int")
    check(tokenizer, docs, pack(df, PATH, group_pieces=3).collect())
    twice = pack(df.union(df).union(spark.createDataFrame([(None, "n", "", 1)], df.schema)), PATH, keep_ids=True).collect()
    assert sum(r.doc_id is None for r in twice) == 1 and sum(r.doc_id == 2 for r in twice) == 2
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in twice)
    assert pack(df.limit(0), PATH).count() == 0


def test_encoder(spark, sf_dir, tokenizer):
    encode = encoder(PATH)
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        assert list(encode(r.text)) == tokenizer.encode(r.text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit(lengths):
    lengths.sort(reverse=True)
    windows, offsets = best_fit(lengths, 64)
    room: list[int] = []
    for n, w, o in zip(lengths, windows, offsets, strict=True):
        fits = [r for r in room if r >= n]
        if not fits:
            assert w == len(room) and o == 0
            room.append(64)
        else:
            assert room[w] == min(fits)
        assert o == 64 - room[w]
        room[w] -= n


def test_tree():
    tree = CapacityTree(10)
    assert tree.tightest(0) == -1
    for c in (3, 7, 7, 10):
        tree.add(c, 1)
    assert [tree.tightest(n) for n in range(11)] == [3, 3, 3, 3, 7, 7, 7, 7, 10, 10, 10]
    tree.add(10, -1)
    assert tree.tightest(8) == -1
