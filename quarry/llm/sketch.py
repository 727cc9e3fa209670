"""A count sketch of token hashes with a fixed number of buckets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.arrow import tidy

SKETCH_BITS = 23
SLOT_BITS = 12  # buckets of one row: 2 ** SLOT_BITS


def sketch_bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


class Counter:
    """Counts of one task."""

    SCHEMA = "slot int, counts binary, bytes int"
    ARROW = pa.schema([("slot", pa.int32()), ("counts", pa.binary()), ("bytes", pa.int32())])

    def __init__(self):
        self.counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        self.waiting, self.size = [], 0

    def add(self, hashes: np.ndarray) -> None:
        self.waiting.append(sketch_bucket(hashes))
        self.size += len(hashes)
        if self.size > 1_000_000:
            self._count()

    def _count(self) -> None:
        if self.waiting:
            seen, times = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.counts[seen] += times.astype(np.uint32)
        self.waiting, self.size = [], 0

    def columns(self) -> tuple[list[int], list[bytes], list[int]]:
        """Used slots, their counts in the narrowest type, and its width."""
        self._count()
        slots = self.counts.reshape(-1, 1 << SLOT_BITS)
        used = [int(i) for i in np.flatnonzero(slots.any(axis=1))]
        kinds = [np.min_scalar_type(int(slots[i].max())) for i in used]
        return used, [slots[i].astype(k).tobytes() for i, k in zip(used, kinds)], [k.itemsize for k in kinds]

    def rows(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(self.columns(), self.ARROW)],
                                          schema=self.ARROW)


def rarity(rows: DataFrame) -> np.ndarray:
    """How often each bucket occurs over all rows (slot, counts, bytes); summed
    on the executors slot by slot, so the driver gets a fixed number of bytes."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for r in batch.to_pylist():
                part = np.frombuffer(r["counts"], dtype=f"<u{r['bytes']}").astype(np.int64)
                sums[r["slot"]] = sums[r["slot"]] + part if r["slot"] in sums else part
        yield pa.RecordBatch.from_pydict(
            {"slot": list(sums), "counts": [np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes() for v in sums.values()]},
            schema=pa.schema([("slot", pa.int32()), ("counts", pa.binary())]))

    found = rows.select("slot", "counts", "bytes").repartition("slot").mapInArrow(tidy(add), "slot int, counts binary").collect()
    out = np.zeros((1 << (SKETCH_BITS - SLOT_BITS), 1 << SLOT_BITS), dtype=np.uint32)
    for r in found:
        out[r["slot"]] = np.frombuffer(r["counts"], dtype="<u4")
    return out.reshape(-1)


def rarity_classes(rows: DataFrame) -> np.ndarray:
    """Class (0 to 63) of each bucket: half steps of log2 of its count, one byte
    per bucket to broadcast."""
    return np.minimum(63, 2 * np.log2(rarity(rows).astype(np.float32) + 1)).astype(np.uint8)
