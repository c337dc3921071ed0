"""Arrow helpers shared by the text operators: whole texts as one byte buffer."""

from __future__ import annotations

import ctypes
import gc
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: Texts are handled in blocks of about this many bytes, which bounds a task's numpy memory.
BLOCK_BYTES = 1 << 21
#: Setting, Spark's default and ours: most bytes of an Arrow batch.
_BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, lengthened until no column of the input has that name (case-insensitively)."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def byte_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and the n + 1 offsets of its values; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    raw = np.frombuffer(data, np.uint8, offs[-1] - offs[0], offs[0]) if offs[-1] > offs[0] else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def blocks(batch: pa.RecordBatch, column: int, most: int = BLOCK_BYTES, rows: int = 4096):
    """Slices of ``batch`` whose values in that column hold about ``most`` bytes, and at most ``rows`` rows; a longer value is a slice of its own."""
    n = batch.num_rows
    values = batch.column(column)
    if pa.types.is_string(values.type) or pa.types.is_binary(values.type):  # what Spark sends
        size = np.frombuffer(values.buffers()[1], np.int32, n + 1, values.offset * 4).astype(np.int64) if n else np.zeros(1, np.int64)
    else:
        size = np.arange(n + 1) * (max(values.nbytes // n, 1) if n else 1)
    start = 0
    while start < n:
        stop = int(np.searchsorted(size, size[start] + most, side="right")) - 1
        stop = min(n, start + rows, max(stop, start + 1))
        yield batch.slice(start, stop - start)
        start = stop


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of modest size, after which a worker gives its spare memory back.

    Spark's default of 64 MB a batch, held on both sides of the pipe by every task, is lowered for the
    session; a size that the session has set otherwise stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH[0]) == _BATCH[1]:
        conf.set(_BATCH[0], _BATCH[2])

    def released(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
        if trim:
            trim(0)

    return df.mapInArrow(released, schema)


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True in ``mask``."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[0::2], edge[1::2]


def cover(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Mask of the positions below ``n`` that lie in any of the half-open intervals."""
    step = np.bincount(starts, minlength=n + 1)[: n + 1].astype(np.int64)
    step -= np.bincount(ends, minlength=n + 1)[: n + 1]
    return np.cumsum(step)[:n] > 0
