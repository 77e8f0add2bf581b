"""Arrow record batches in and out of ``mapInArrow`` tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Text bytes worked on at once inside a task; a longer single text is worked on alone.
CHUNK_BYTES = 1 << 20
#: Rows of an Arrow batch; Spark's default of 10,000 would be tens of megabytes of text on both sides of the pipe.
BATCH_ROWS = 400
#: Bytes of an Arrow batch (one row at least): 400 long texts or token chunks would be hundreds of megabytes of direct
#: memory in the JVM, which the heap's limit doesn't count.
BATCH_BYTES = 4 << 20


def map_texts(df: DataFrame, task, schema) -> DataFrame:
    """``mapInArrow`` over rows with texts, in small batches.

    Batches have one size in a session: it is lowered to ``BATCH_ROWS`` and
    ``BATCH_BYTES`` here and stays so (results don't depend on it).
    """
    conf = df.sparkSession.conf
    rows, size = (f"spark.sql.execution.arrow.{k}" for k in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if not 0 < int(conf.get(rows)) <= BATCH_ROWS:
        conf.set(rows, str(BATCH_ROWS))
    now = conf.get(size).rstrip("bB")
    if not (now.isdigit() and int(now) <= BATCH_BYTES):
        conf.set(size, str(BATCH_BYTES))
    return df.mapInArrow(task, schema)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows (null rows are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``limit`` bytes (one row at least)."""
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        _, offsets = text_buffer(batch.column(text))
        at = 0
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
            end = min(n, max(end, at + 1))
            yield batch.slice(at, end - at)
            at = end


def binary_column(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A binary column whose rows are consecutive runs of ``values``."""
    sizes = np.concatenate([[0], np.cumsum(counts)]) * values.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(counts),
        [None, pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def as_arrays(col: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column of packed ``dtype`` values, and the n + 1 offsets of its rows."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if len(col) == 0:
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    wide = pa.types.is_large_binary(col.type)
    offsets = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    size = np.dtype(dtype).itemsize
    return np.frombuffer(raw.tobytes(), dtype), (offsets - offsets[0]) // size
