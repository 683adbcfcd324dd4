"""Best-fit decreasing packing of token sequences into fixed windows.

Documents are tokenized in Arrow batches, cut into full windows and one rest, and only the pieces' spans move on. Pieces
are dealt to groups of a bounded number by a hash of where they were made, so that no document or source is ever one
group; in a group a segment tree over the remaining capacities finds the tightest open window for each piece.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, texts

WINDOW = 1024
#: Pieces in a packing group: memory of a few MB, and padding that a larger group would hardly lower.
GROUP_PIECES = 16384
PIECES = "{id}, start long, length long, ids_crc32 long, doc_tokens long"

_encoders: dict[str, object] = {}


@functools.cache
def _whole_file(path: str):
    """The tokenizer file in its own library, read where a text first needs it."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encoder(path: str):
    """A function from text to ids, as the tokenizer file has them; made once in each worker.

    With a rank file of the same name beside a byte-level BPE file, the same merges run in tiktoken, about three times
    as fast; texts that hold one of the file's special tokens, which it takes whole, still go through the file itself.
    """
    if path not in _encoders:
        ranks_path = path.removesuffix(".json") + ".tiktoken"
        try:
            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        except FileNotFoundError:
            _encoders[path] = lambda text: _whole_file(path).encode(text, add_special_tokens=False).ids
            return _encoders[path]
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            special = [x["content"] for x in json.load(f)["added_tokens"]]
        ranked = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        _encoders[path] = lambda text: _whole_file(path).encode(text, add_special_tokens=False).ids if any(s in text for s in special) else ranked.encode_ordinary(text)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, keep_ids: bool = False) -> DataFrame:
    """Cut each document (ids, then end_id) into full windows and a rest: (id, start, length, ids_crc32, doc_tokens,
    task, place), and with keep_ids the ids as an array. task and place say where a piece was made."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, place = encoder(tokenizer_path), TaskContext.get().partitionId(), 0
        for b in batches:
            src, columns, kept = [], [array("q") for _ in range(4)], []
            for row, text in enumerate(texts(b.column(1))):
                ids = array("I", encode(text.decode("utf-8")))
                ids.append(end_id)
                view = memoryview(ids)
                for start in range(0, len(ids), window):
                    piece = view[start : start + window]
                    src.append(row)
                    for c, v in zip(columns, (start, len(piece), zlib.crc32(piece), len(ids)), strict=True):
                        c.append(v)
                    if keep_ids:
                        kept.append(piece.tolist())
            n = len(src)
            arrays = [b.column(0).take(pa.array(src, pa.int64())), *(pa.array(np.frombuffer(c, np.int64)) if n else pa.array([], pa.int64()) for c in columns)]
            arrays += [pa.array(np.full(n, task, np.int64)), pa.array(np.arange(place, place + n))]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "task", "place"]
            if keep_ids:
                arrays.append(pa.array(kept, pa.list_(pa.int32())))
                names.append("ids")
            place += n
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = PIECES.format(id=f"id {rows.schema['id'].dataType.simpleString()}") + ", task long, place long" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(cut, schema)


class CapacityTree:
    """A segment tree over remaining capacities 0..size: how many open windows have each."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, capacity: int, change: int) -> None:
        at = self.base + capacity
        while at:
            self.count[at] += change
            at >>= 1

    def tightest(self, need: int) -> int:
        """The least capacity of need or more that an open window has; -1 if there is none."""
        count, at = self.count, self.base + need
        if count[at]:
            return need
        while at > 1:
            if not at & 1 and count[at + 1]:  # everything under the right sibling is larger
                at += 1
                while at < self.base:
                    at = 2 * at if count[2 * at] else 2 * at + 1
                return at - self.base
            at >>= 1
        return -1


def best_fit(lengths: list[int], window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Windows and offsets for lengths in descending order, each of 1 to window."""
    tree, open_at = CapacityTree(window), [[] for _ in range(window + 1)]
    windows, offsets, made = [], [], 0
    for n in lengths:
        room = tree.tightest(n)
        if room < 0:
            w, room, made = made, window, made + 1
        else:
            w = open_at[room].pop()
            tree.add(room, -1)
        windows.append(w)
        offsets.append(window - room)
        if left := room - n:
            open_at[left].append(w)
            tree.add(left, 1)
    return windows, offsets


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, end_id: int = 0, group_pieces: int = GROUP_PIECES, keep_ids: bool = False) -> DataFrame:
    """One row for each piece: id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with keep_ids the
    ids themselves.

    A sequence holds at most window ids, without gaps. A null or empty text is the single end_id. Null ids are carried
    through; repeated rows are packed as often as they come. Other columns are not looked at. No rows give no rows.
    sequence_id is the packing group times 2^32, plus a number in it.
    """
    cut = materialize(pieces(docs, tokenizer_path, id_col, text_col, window, end_id, keep_ids), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    spans = cut.drop("ids").withColumn("grp", F.pmod(F.xxhash64("task", "place"), F.lit(groups)))
    schema = f"{PIECES.format(id=f'id {cut.schema['id'].dataType.simpleString()}')}, task long, place long, sequence_id long, offset long"

    def pack_group(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "task", "place"], ascending=[False, True, True], kind="stable")
        w, o = best_fit(pdf["length"].tolist(), window)
        pdf["sequence_id"] = np.array(w, np.int64) + (pdf["grp"].to_numpy(np.int64) << 32)
        pdf["offset"] = np.array(o, np.int64)
        return pdf[[*[c for c in pdf.columns if c not in ("grp", "sequence_id", "offset")], "sequence_id", "offset"]]

    # A null long would turn to a float in pandas; as text it doesn't, whatever its size.
    id_type = cut.schema["id"].dataType.simpleString()
    spans = spans.withColumn("id", F.col("id").cast("string"))
    packed = spans.groupBy("grp").applyInPandas(pack_group, schema.replace(f"id {id_type}", "id string", 1)).withColumn("id", F.col("id").cast(id_type))
    if keep_ids:
        packed = packed.join(cut.select("task", "place", "ids").hint("merge"), ["task", "place"])
    return packed.withColumnRenamed("id", id_col).drop("task", "place")
