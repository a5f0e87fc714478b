"""Groups of rows inside a task: rows arrive dealt and sorted by their group columns, and every group
is handed over whole. Callers keep groups bounded (blocks of a bucket, shards of an index)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """One table per run of rows equal in the integer columns ``by`` (sorted, not null)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([np.asarray(batch.column(c)) for c in by], 1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if last is not None and (keys[a] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = keys[a]
    if held:
        yield pa.Table.from_batches(held)


def fixed(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """A binary column whose values have one length, as a matrix of ``dtype`` with a row each."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks)
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data.reshape(len(col), -1).view(dtype)


def packed(matrix: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    body = np.ascontiguousarray(matrix)
    width = body.shape[1] * body.itemsize
    offsets = (np.arange(len(body) + 1, dtype=np.int64) * width).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(body), [None, pa.py_buffer(offsets), pa.py_buffer(body.tobytes())]).cast(pa.binary())
