"""Arrow helpers used inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def utf8_slices(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The UTF-8 bytes of each value (views, no copies); None for null."""
    values = column.cast(pa.large_binary())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2], dtype=np.uint8) if values.buffers()[2] else np.empty(0, np.uint8)
    valid = values.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(values)):
        yield data[offsets[i]:offsets[i + 1]] if valid[i] else None


def tidy(task):
    """Wrap a batch function so that a worker gives freed memory back to the
    system when its task ends; workers live on and would keep the peak of every
    task they ever ran."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run
