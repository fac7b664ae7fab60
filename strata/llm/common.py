"""What the operators of this folder share: reading a table, and null-safe text."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, whatever else the frame has; a null text is empty."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), or_empty(text).alias("text"))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Rows that go to Python at once, for jobs that run within; whole texts and sets make
    wide rows, and a batch of them is held on both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def or_empty(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def parts(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: what Python objects are made of at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Workers outlive their tasks; memory that this task has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
