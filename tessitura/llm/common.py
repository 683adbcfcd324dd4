"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A word is a longest run without ASCII white space; bytes.split() cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset, one made here, on a local
    master only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="spark-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back.

    This cuts the lineage without relying on any one executor, and gives the optimizer true sizes for the joins above it.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty. lower() does the same, faster, on texts that are all ASCII."""
    text = F.coalesce(col, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(column: pa.Array) -> Iterator[bytes]:
    """The texts of an Arrow column as UTF-8, one at a time; null counts as empty."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""


def crc32_id(col: Column) -> Column:
    """crc32 of an id written as decimal text."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8"))


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is run inside hands at most so many rows at a time to Python and back, or fewer where the session says so: an
    executor holds a batch several times over (rows, Arrow, the worker), and texts and sets are long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def letting_go(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], *forget: Callable[[], None]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run over a task's batches; at its end forget's functions are called and free memory goes back to the system.

    Workers are used again: what a task leaves there adds up with the next stage's needs.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for f in forget:  # by name: what is passed by value would be a copy of a worker's table
                f()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library's, where it has one
            if trim is not None:
                trim(0)

    return whole
