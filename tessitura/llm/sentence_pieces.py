"""SentencePiece encoding and decoding with a merge-type vocabulary.

A text's symbols are its characters. An agenda holds the adjacent pairs whose joined text is a piece, ordered by the
piece's score, then by place from the left; the best pair is joined and its new neighbours enter, until none is left.
What is no piece then goes out as the bytes of its UTF-8.

Space (written as the mark U+2581) opens the pieces that hold one, so no join reaches over a mark that follows another
character, nor over an ASCII character that no piece holds: a text is cut there, and a worker remembers the ids of the short
cuts that it has met. With a vocabulary that has inner marks a text is one cut. For long cuts the agenda is a
heap, so that n characters take n log n steps.

The texts of each Arrow batch are also encoded and decoded by the sentencepiece library. Where it disagrees, its
results are returned, and the column agrees says so.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import itertools
import operator
import re
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts

MARK = "▁"
#: Cuts that a worker remembers (up to twice as many), and the longest of them in characters.
REMEMBERED, LONGEST = 1 << 19, 48
#: Characters up to which the agenda is a plain list.
SHORT = 32
#: Texts, and about so many bytes of them, that go to the library at a time.
CHECKED, CHECKED_BYTES = 256, 1 << 20

#: Of a key in the agenda, the part that is a place, and a key that no pair has.
PLACE, NEVER = (1 << 32) - 1, 1 << 62

# An invalid byte is one replacement character each, as in the library.
codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class _Packed(dict):
    """Packed ids by text, made when first asked for. Those of short texts are remembered until twice so many others have come."""

    def __init__(self, made: Callable[[str], bytes]):
        self.made, self.older = made, {}

    def __missing__(self, text: str) -> bytes:
        found = self.older.get(text)
        if found is None:
            found = self.made(text)
        if len(text) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


class PieceModel:
    """The vocabulary of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.library = sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unknown = sp.bos_id(), sp.eos_id(), sp.unk_id()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        scores = {x: k << 32 for k, x in enumerate(sorted({sp.get_score(i) for i in plain}, reverse=True))}
        self.rank = {piece: scores[sp.get_score(i)] for piece, i in self.ids.items()}
        self.byte_ids = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.decoded = np.full(n, b"", object)
        for piece, i in self.ids.items():
            self.decoded[i] = piece.replace(MARK, " ").encode()
        for value, i in self.byte_ids.items():
            self.decoded[i] = bytes([value])
        self.decoded[self.unknown] = " ⁇ ".encode()
        self.silent = np.array([sp.is_control(i) for i in range(n)])
        #: Ids whose leading space is not the mark that encoding put first.
        self.no_mark = {*self.byte_ids.values(), self.unknown}
        self.pairs = {pair for piece in self.ids for pair in map(operator.add, piece, piece[1:])}
        letters = {c for piece in self.ids for c in piece}
        plain_ascii = {chr(c) for c in range(128)} - {" "}
        apart = plain_ascii - letters
        # Signs that no piece has after a letter or digit: a text is cut there, too.
        signs = {c for c in plain_ascii - apart if not c.isalnum()} - {y for x, y in self.pairs if x.isalnum()}
        a, e = ("".join(map(re.escape, sorted(chars))) for chars in (apart, signs))
        inner = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        rest = f"(?:[^{MARK}{a}{e}]+" + rf"|(?<![^\W_])[{e}]+" * bool(e) + ")*"
        kinds = [f"{MARK}+{rest}", f"[{e}]{rest}" * bool(e), f"[^{MARK}{a}{e}]{rest}", f"[{a}]+" * bool(a)]
        self.cuts = None if inner else re.compile("|".join(filter(None, kinds))).findall
        self.packed = _Packed(self._pack)
        self.words = _Packed(self._pack_word)

    def joined(self, symbols: str) -> list[str]:
        """The pieces that the agenda leaves of some characters: of the pairs whose text is a piece the one with the best
        rank by score, the leftmost of equals, is joined first."""
        return self._joined_short(symbols) if len(symbols) <= SHORT else self._joined_long(symbols)

    def _joined_short(self, symbols: str) -> list[str]:
        """The agenda as a list of each pair's rank, which is searched anew each time: for few pairs less work than a heap."""
        rank, piece = self.rank.get, list(symbols)
        due = list(map(rank, map(operator.add, symbols, symbols[1:]), itertools.repeat(NEVER)))
        while due:
            best = min(due)
            if best == NEVER:
                break
            left = due.index(best)
            both = piece[left] + piece.pop(left + 1)
            piece[left] = both
            del due[left]
            if left < len(due):
                due[left] = rank(both + piece[left + 1], NEVER)
            if left:
                due[left - 1] = rank(piece[left - 1] + both, NEVER)
        return piece

    def _joined_long(self, symbols: str) -> list[str]:
        """The agenda as a heap. A key is a pair's rank and its left place in one number; due has the present key of the
        pair that starts at each place, so that a key which is no longer due is passed over."""
        rank, n = self.rank.get, len(symbols)
        piece, before, after = list(symbols), list(range(-1, n - 1)), list(range(1, n + 1))
        due = [rank(both, NEVER) + i for i, both in enumerate(map(operator.add, symbols, symbols[1:]))]
        due.append(NEVER)
        agenda = [key for key in due if key < NEVER]
        heapq.heapify(agenda)
        while agenda:
            key = heapq.heappop(agenda)
            left = key & PLACE
            if due[left] != key:
                continue
            right = after[left]
            piece[left] = both = piece[left] + piece[right]
            piece[right] = ""
            due[left] = due[right] = NEVER
            after[left] = following = after[right]
            if following < n:
                before[following] = left
                due[left] = key = rank(both + piece[following], NEVER) + left
                if key < NEVER:
                    heapq.heappush(agenda, key)
            preceding = before[left]
            if preceding >= 0:
                due[preceding] = key = rank(piece[preceding] + both, NEVER) + preceding
                if key < NEVER:
                    heapq.heappush(agenda, key)
        return list(filter(None, piece))

    def ids_of(self, cut: str) -> array:
        """The ids of a cut; bytes, or where the vocabulary has none the unknown id, for what is no piece."""
        pieces = self.joined(cut)
        try:
            return array("I", map(self.ids.__getitem__, pieces))
        except KeyError:
            pass
        found = array("I")
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                found.append(i)
            elif self.byte_ids:
                found.extend([self.byte_ids[b] for b in p.encode()])
            elif not found or found[-1] != self.unknown:  # a run of unknown characters is one id
                found.append(self.unknown)
        return found

    def _pack(self, cut: str) -> bytes:
        if self.pairs.issuperset(map(operator.add, cut, cut[1:])):
            return self.ids_of(cut).tobytes()
        # Nothing is joined over two neighbours that no piece holds.
        starts = [0, *[i for i, pair in enumerate(map(operator.add, cut, cut[1:]), 1) if pair not in self.pairs], len(cut)]
        return b"".join([self.packed[cut[x:y]] for x, y in itertools.pairwise(starts)])

    def _pack_word(self, word: str) -> bytes:
        """What stands between two single spaces, with a mark before it."""
        cuts = self.cuts(MARK + word)
        if len(cuts) == 1:
            return self._pack(cuts[0])
        return self.words[cuts[0][1:]] + b"".join(map(self.packed.__getitem__, cuts[1:]))

    def encode(self, text: str) -> array:
        """The ids of a text between the begin and end ids, as unsigned 32-bit integers."""
        ids = array("I", [self.bos])
        if self.cuts is None:
            ids.extend(self.ids_of(MARK + text.replace(" ", MARK)) if text else [])
        elif "  " in text or text[:1] in ("", " ", MARK) or text[-1] == " " or MARK in text:
            ids.frombytes(b"".join(map(self.packed.__getitem__, self.cuts(MARK + text.replace(" ", MARK)))) if text else b"")
        else:
            ids.frombytes(b"".join(map(self.words.__getitem__, text.split(" "))))
        ids.append(self.eos)
        return ids

    def decode(self, ids: Sequence[int]) -> str:
        """The text of some ids: begin and end ids are silent, and the mark that encoding put first goes."""
        at = np.asarray(ids, np.int64)
        silent = self.silent[at]
        ends = np.flatnonzero(silent[1:-1]) + 1
        # A silent id ends a run of bytes, too.
        bounds = [0, *ends.tolist(), len(at)]
        found = "".join([b"".join(self.decoded[at[x:y]].tolist()).decode("utf-8", "each_byte") for x, y in itertools.pairwise(bounds)])
        if found.startswith(" ") and at[np.argmin(silent)] not in self.no_mark:
            return found[1:]
        return found


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """A model file's vocabulary, read once in each worker. Needs a merge-type model that leaves texts as they are
    but for a mark put first, as the check against the library shows."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _checked(own: PieceModel, found: list[str]) -> Iterator[tuple[array, str, bool]]:
    """For each text its ids, what they decode to, and whether the library says the same."""
    for text, theirs in zip(found, own.library.encode(found, out_type="numpy", add_bos=True, add_eos=True, num_threads=1), strict=True):
        ids = own.encode(text)
        back, theirs_back = own.decode(ids), own.library.decode(theirs.tolist())
        agrees = np.array_equal(np.asarray(ids), theirs) and back == theirs_back
        yield (ids, back, True) if agrees else (array("I", theirs.tolist()), theirs_back, False)


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row for each row of docs: id_col, n_tokens, ids_sha256, decoded_sha256, agrees, and with keep_ids the ids and
    the decoded text.

    Digests are of the ids as little-endian unsigned 32-bit integers and of the decoded text in UTF-8, in lowercase hex.
    A null text counts as empty: the begin and end ids alone. Null ids and repeated rows are carried through; other
    columns are not looked at; no rows give no rows. A worker holds one text's symbols and agenda, some hundred bytes
    for each character of its longest cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for b in batches:
            rows: list[tuple] = []

            def flush(part: list[str], rows: list[tuple] = rows) -> None:
                for ids, back, agrees in _checked(own, part):
                    digest = hashlib.sha256(np.asarray(ids).astype("<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()
                    rows.append((len(ids), *digest, agrees, *((ids.tolist(), back) if keep_ids else ())))

            part, size = [], 0
            for text in texts(b.column(1)):
                part.append(text.decode("utf-8", "each_byte"))
                size += len(text)
                if len(part) == CHECKED or size > CHECKED_BYTES:
                    flush(part)
                    part, size = [], 0
            if part:
                flush(part)
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=names)

    names, types = ["id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"], [pa.int64(), pa.string(), pa.string(), pa.bool_()]
    if keep_ids:
        names, types = [*names, "ids", "decoded"], [*types, pa.list_(pa.int64()), pa.string()]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"
    return rows.mapInArrow(run, schema + ", ids array<long>, decoded string" * keep_ids).withColumnRenamed("id", id_col)
