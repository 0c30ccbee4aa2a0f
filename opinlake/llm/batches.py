"""Arrow batches of bounded size inside tasks, and small steps the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Bytes of text that a task works on at a time. A longer single text is a slice of its own.
SLICE_BYTES = 4_000_000


def by_size(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have at most `limit` bytes together, one row at least."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def hand_back() -> None:
    """Give free memory back to the system. A worker process outlives its tasks, and what allocators
    keep for it counts against its executor while others need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not in every C library
    if trim is not None:
        trim(0)


def map_slices(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str | StructType,
    column: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """`mapInArrow` over slices of bounded text size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in by_size(batch, column, limit):
                made = work(piece)
                if made is not None:
                    yield made
        hand_back()

    return df.mapInArrow(run, schema)


def as_bytes(docs: DataFrame, *keep: str) -> DataFrame:
    """The named columns and the text as UTF-8 bytes, NULL as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    return docs.select(*keep, text)
