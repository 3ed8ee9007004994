"""Shared plumbing of the training-data operators: inputs, staged tables, ordered partitions."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import drop_staged, new_path, scope, stage

__all__ = ["buffer_of", "bucket_placer", "by_size", "drop_staged", "fold", "give_back", "meet", "new_path", "partitions", "read_documents", "scope", "slices", "small_batches", "stage", "text_column"]


#: Rows of a batch that Spark hands to Python: the operators slice batches by bytes, so larger ones only cost memory.
BATCH_ROWS = 2_000


def small_batches(spark: SparkSession) -> None:
    """Bound what a task holds of whole texts on both sides, unless the session asks for less."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def read_documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The ``documents`` table, narrowed to ``columns`` when given."""
    small_batches(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select(*columns) if columns else docs


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The named column as strings, null as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    return column.fill_null("") if column.null_count else column


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker outlives its tasks, and each would add to what the ones before left."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim is not None:
        trim(0)


def by_size(batches: Iterator[pa.RecordBatch], limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """``slices`` of a task's input.  What earlier work of the process freed is given back before and after."""
    give_back()
    yield from slices(batches, limit, name)
    give_back()


def slices(batches: Iterator[pa.RecordBatch], limit: int, name: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = buffer_of(text_column(batch, name))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def buffer_of(column: pa.Array):
    """(bytes as uint8, row offsets as int64) of a string column; offsets start at 0."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    if buffers[1] is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def fold(column: str = "doc_id", modulus: int = 5):
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def bucket_placer(ids: DataFrame, n: int, key: str = "doc_id"):
    """A function that adds an int column ``bucket`` in 0..n-1, ascending with ``key``; nulls go to the last.

    The bounds are quantiles of the key in ``ids``: n numbers at most reach the driver.
    """
    cuts = ids.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = np.unique(np.array(cuts or [], dtype=np.float64).astype(np.int64))

    @F.pandas_udf("int")
    def place(values: pd.Series) -> pd.Series:
        missing = values.isna()
        where = np.searchsorted(bounds, values.fillna(0).to_numpy().astype(np.int64), side="right")
        return pd.Series(np.where(missing, n - 1, where).astype(np.int32))

    return lambda rows: rows.withColumn("bucket", place(F.col(key).cast("long")))


def meet(rows: DataFrame, picked: DataFrame, most: int) -> DataFrame:
    """``rows`` that ``picked`` (doc_id and more columns) names, with those columns.

    The ids go to the rows, whose texts stay where they are read; if more than ``most`` were picked, both are shuffled."""
    picked = stage(picked, "picked")
    return rows.join(F.broadcast(picked) if picked.count() <= most else picked, "doc_id")
