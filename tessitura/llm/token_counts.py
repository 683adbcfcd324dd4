"""Token counts as rollups that signed deltas maintain.

A batch of changes replaces what is known of the documents it names. What a document had before goes into the ledger
with a minus sign, what it has now with a plus sign, so that totals by source, language and tokenizer are sums over all
ledger rows, and a batch adds its own sums to them without a look at the rest. A batch writes its ledger rows and its
sums under its own name and is committed by a marker written last: one that broke off is written over when tried again,
and one that is committed is left alone when sent again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, texts
from .packing import encoder

KEYS = ["source", "lang", "tokenizer"]


def count_tokens(docs: DataFrame, tokenizers: dict[str, str | None], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, n_tokens): a row for each row of docs and tokenizer version.

    tokenizers gives a file for each version's name, or None to count words between ASCII white space. Null texts have
    no tokens.
    """
    names = list(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [(lambda t, e=encoder(path): len(e(t.decode("utf-8")))) if path else (lambda t: len(t.split())) for path in tokenizers.values()]
        for b in batches:
            found = np.array([[c(t) for c in count] for t in texts(b.column(3))], np.int64).reshape(b.num_rows, len(names))
            for i, name in enumerate(names):
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([name] * b.num_rows, pa.string()), pa.array(np.ascontiguousarray(found[:, i]))], names=["doc_id", "source", "lang", "tokenizer", "n_tokens"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, source string, lang string, tokenizer string, n_tokens long")


class TokenRollup:
    """Totals in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.id_type = "long"

    def _read(self, kind: str, batches: Sequence[str], schema: str) -> DataFrame:
        """The committed batches' rows, without listing others' files."""
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{kind}/{b}" for b in batches])

    def batches(self) -> list[str]:
        """Names of the committed batches, a row each."""
        try:
            return sorted(r["batch"] for r in self.spark.read.schema("batch string").parquet(f"{self.path}/commits/*").collect())
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e):
                return []
            raise

    def _ledger(self) -> DataFrame:
        return self._read("ledger", self.batches(), f"doc_id {self.id_type}, source string, lang string, tokenizer string, docs long, n_tokens long")

    def apply(self, batch: str, counts: DataFrame, deleted: DataFrame | None = None) -> bool:
        """Commit a batch: counts (as count_tokens gives them) replaces its documents' rows of its tokenizers, deleted
        (doc_id) removes documents, unless counts has them too. False if the batch had been committed before.

        Rows that repeat a document add up. Null ids are one document. A deleted id that is not known changes nothing.
        """
        if batch in self.batches():
            return False
        self.id_type = counts.schema["doc_id"].dataType.simpleString()
        new = materialize(counts.groupBy("doc_id", *KEYS).agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("n_tokens")), "counts")
        state = self._ledger().groupBy("doc_id", *KEYS).agg(F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens")).where("docs <> 0 or n_tokens <> 0")
        touched = new.select(F.col("doc_id").alias("t_id"), F.col("tokenizer").alias("t_tokenizer")).distinct()
        old = state.join(touched.hint("merge"), state["doc_id"].eqNullSafe(touched["t_id"]) & (state["tokenizer"] == touched["t_tokenizer"]), "left_semi")
        if deleted is not None:
            gone = deleted.select(F.col("doc_id").alias("g_id")).distinct()
            rest = state.join(touched.hint("merge"), state["doc_id"].eqNullSafe(touched["t_id"]) & (state["tokenizer"] == touched["t_tokenizer"]), "left_anti")
            old = old.union(rest.join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("g_id")), "left_semi"))
        minus = old.select("doc_id", *KEYS, (-F.col("docs")).alias("docs"), (-F.col("n_tokens")).alias("n_tokens"))
        new.select(*minus.columns).union(minus).write.mode("overwrite").parquet(f"{self.path}/ledger/{batch}")
        delta = self._read("ledger", [batch], f"doc_id {self.id_type}, source string, lang string, tokenizer string, docs long, n_tokens long")
        delta.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("n_tokens").alias("n_tokens")).write.mode("overwrite").parquet(f"{self.path}/sums/{batch}")
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/{batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over the committed batches; combinations without documents are left out."""
        sums = self._read("sums", self.batches(), "source string, lang string, tokenizer string, docs long, n_tokens long")
        return sums.groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
