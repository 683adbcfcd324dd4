import hashlib
from array import array

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessitura.llm import queries
from tessitura.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
SOME = ["a", "the", "th", "ing", " ", "  ", "▁", "\n", "\t", "é", "漢", "😀", "\x00", "<s>", "</s>", "<unk>", "<0x0A>", "1", "23", "...", "ﬁ", " ", "�", "​", "\r", "é", "0" * 40]


@pytest.fixture(scope="module")
def model():
    return sp.model(PATH)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(SOME), st.characters(exclude_categories=["Cs"])), max_size=20).map("".join))
def test_against_library(text):
    model = sp.model(PATH)
    theirs = model.library.encode(text, add_bos=True, add_eos=True)
    assert model.encode(text).tolist() == theirs
    assert model.decode(theirs) == model.library.decode(theirs)
    assert all(agrees for *_, agrees in sp._checked(model, [text]))


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([0, 1, 2, 3, 131, 133, 172, 198, 229, 233, 259, 260, 29871]), st.integers(0, 31999)), max_size=8))
def test_decode_any_ids(ids):
    model = sp.model(PATH)
    assert model.decode(ids) == model.library.decode(ids)


def test_agenda(model):
    """The best score first, then the leftmost; out-of-date pairs are passed over."""
    m = sp.PieceModel(PATH)
    m.rank = {"ab": 1 << 32, "bc": 0, "aa": 2 << 32, "aaaa": 3 << 32}
    for joined in (m._joined_short, m._joined_long):
        assert joined("abc") == ["a", "bc"] and joined("abab") == ["ab", "ab"]
        assert joined("aaaaa") == ["aaaa", "a"] and joined("aaa") == ["aa", "a"]
        assert joined("") == [] and joined("x") == ["x"]
    text = "themselves" * 40
    assert model.joined(text) == model._joined_short(text) == model._joined_long(text)


def test_whole_cut_gives_the_same(model):
    """A vocabulary with inner marks takes a text as one cut; here both ways must agree."""
    m = sp.PieceModel(PATH)
    m.cuts = None
    for text in ("The quick  brown\nfox, again; and  again.", "   ", "naïve café " * 50):
        whole = array("I", [m.bos, *m.ids_of(sp.MARK + text.replace(" ", sp.MARK)), m.eos])
        assert m.encode(text) == whole == model.encode(text)


def test_memory_is_bounded(model, monkeypatch):
    monkeypatch.setattr(sp, "REMEMBERED", 10)
    m = sp.PieceModel(PATH)
    for gap in (" ", "  "):
        text = gap.join(f"word{i}, other{i % 3}" for i in range(200)) + gap + "x" * 500
        assert m.encode(text).tolist() == m.library.encode(text, add_bos=True, add_eos=True)
    for known in (m.packed, m.words):
        assert len(known) <= 10 and len(known.older) <= 10 and max(map(len, known)) <= sp.LONGEST


def test_query(spark, sf_dir):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PATH)
    got = {r.doc_id: r for r in queries.QUERIES["op13_sentence_pieces"](spark, sf_dir).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        r = got[i]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(array("I", ids).tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest() and r.agrees


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "a" * 300_000, "x"), (4, " two  spaces ", "x"), (4, " two  spaces ", "x"), (None, "n\n", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sp.encode_pieces(docs, PATH, keep_ids=True).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.ids, r.decoded, r.agrees))
    assert by[1] == by[2] == [([1, 2], "", True)] and by[3][0][1:] == ("a" * 300_000, True)
    assert [x[1:] for x in by[4]] == [(" two  spaces ", True)] * 2 and by[None][0][1] == "n\n"
    assert sp.encode_pieces(docs.limit(0), PATH).count() == 0


def test_the_library_wins(spark, monkeypatch):
    """Where both differ, the library's ids go out and agrees is false."""
    m = sp.PieceModel(PATH)
    monkeypatch.setattr(m, "encode", lambda text: array("I", [1, 5, 2]))
    (ids, back, agrees), *_ = sp._checked(m, ["hello there"])
    assert not agrees and ids.tolist() == m.library.encode("hello there", add_bos=True, add_eos=True) and back == "hello there"
