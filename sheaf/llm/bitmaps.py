"""Sets of 128-bit keys as bitmaps of fixed size: no key of the set is missed, some others are taken for one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 27


def _places(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    x = hi.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + lo.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(32)) % np.uint64(BITS)


def bitmap(keys: DataFrame) -> np.ndarray:
    """BITS bits, those at the places of the keys (hi, lo) set; a row for each 64 bits reaches the driver at most."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["at", "bits"])

    out = np.zeros(BITS // 64, np.uint64)
    found = keys.select("hi", "lo").mapInArrow(place, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def is_set(bits: np.ndarray, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """Which keys the set may hold."""
    at = _places(hi, lo)
    return (bits[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
