"""Small shared pieces: null-safe columns, stored intermediate tables, counts."""

from __future__ import annotations

import ctypes
import os
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from winback.session import scratch_path
from winback.sources.io import Files

SPACE = " \t\n\x0b\f\r"           # the bytes 0x20 and 0x09-0x0D
SPACE_CLASS = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame, col: str = "text") -> Column:
    """The text column as a string, null as empty."""
    return F.coalesce(docs[col].cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as an array (empty: no word)."""
    t = F.btrim(text, F.lit(SPACE))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared ``spark.checkpoint.dir`` and
    read it back: later stages restart from files when an executor is lost."""
    spark = df.sparkSession
    path = os.path.join(scratch_path(spark, "llm"), f"{name}_{uuid.uuid4().hex[:12]}")
    with freeing(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def release(*tables: DataFrame | None) -> None:
    """Delete ``stored`` tables after their last reader has run."""
    for t in tables:
        if t is not None:
            Files(t.sparkSession, t.stored_path).delete()


def shuffle_blocks(spark: SparkSession, rows: int, rows_per_block: int) -> int:
    """Number of hash blocks so that one block holds about ``rows_per_block``
    rows, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_block))


_BATCH, _FREE = ("spark.sql.execution.arrow.maxRecordsPerBatch",
                 "spark.sql.classic.shuffleDependency.fileCleanup.enabled")


def bounded_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Let this session hand Python at most ``rows`` rows at a time: documents are
    long, and a worker holds a batch whole."""
    if not 0 < int(spark.conf.get(_BATCH)) <= rows:
        spark.conf.set(_BATCH, str(rows))


def trim() -> None:
    """Give a worker's freed memory back to the machine: workers are used again, and what
    the allocators keep of a large group counts for the executor until the worker ends."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not glibc
        pass


@contextmanager
def freeing(spark: SparkSession):
    """Actions inside give their shuffle files back when they end; for jobs whose
    result is collected or stored and whose plan is not run again."""
    before = spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
