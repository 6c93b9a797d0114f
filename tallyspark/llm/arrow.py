"""Helpers for operators that work on Arrow batches inside tasks."""

import numpy as np
import pyarrow as pa


def utf8_of(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """UTF-8 bytes of a string (or binary) column end to end, and the n + 1 offsets; NULL is ''."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.cast(pa.large_binary())
    flat = flat.fill_null(b"") if flat.null_count else flat
    _, offsets, data = flat.buffers()
    places = np.frombuffer(offsets, np.int64)[flat.offset:flat.offset + len(flat) + 1]
    if not len(flat) or data is None:
        return b"", np.zeros(len(flat) + 1, np.int64)
    return data.to_pybytes()[places[0]:places[-1]], places - places[0]


def slices_of(batch: pa.RecordBatch, text: str, limit: int = 4 << 20):
    """Row ranges of a batch whose texts hold about ``limit`` bytes (a longer row stands alone)."""
    lengths = np.diff(utf8_of(batch.column(text))[1])
    start, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if held and held + length > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += length
    if start < len(lengths):
        yield batch.slice(start)
