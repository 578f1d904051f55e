"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20     # text bytes handled at a time; one longer text makes a slice of its own


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Byte offsets (n + 1) of a string array's rows in its data buffer."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    raw = np.frombuffer(texts.buffers()[1], dtype=kind) if texts.buffers()[1] else np.zeros(1, kind)
    return raw[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The whole data buffer behind a string array."""
    data = texts.buffers()[2]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES):
    """Cut a batch into runs of rows with about ``most`` bytes of text each."""
    if batch.num_rows == 0:
        return
    ends = text_offsets(batch.column(batch.schema.get_field_index(column)))
    at, rows = 0, batch.num_rows
    while at < rows:
        to = int(np.searchsorted(ends, ends[at] + most, side="right")) - 1
        to = min(max(to, at + 1), rows)
        yield batch.slice(at, to - at)
        at = to


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """A text column as Python strings, null as the empty string."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]
