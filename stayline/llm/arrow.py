"""Arrow batches in pieces of bounded size."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

#: Bytes of text handled at once; one longer text makes a piece of its own.
PIECE = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Send at most about 16 MB of rows to a worker at a time, however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def release() -> None:
    """Give free memory back to the system: workers live on, and theirs would lie below what later stages need."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def pieces(batches: Iterator[pa.RecordBatch], column: str, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The batches again, cut so that ``column`` holds about ``size`` bytes in each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = batch.column(column)
        ends = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(lengths), 0).to_numpy(zero_copy_only=False))
        at, done = 0, 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, to - at)
            at, done = to, int(ends[to - 1])
    batch = lengths = ends = None
    release()
