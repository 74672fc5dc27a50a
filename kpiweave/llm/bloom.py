"""A Bloom filter over 64-bit keys, built by Spark, asked in numpy. It only thins out rows
before an exact join, so a wrong yes costs time and never changes a result."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiweave.llm.tokens import mix

LEAST, MOST = 20, 27  # log2 of the bits: 16 MB at most, whatever the number of keys
PROBES = 3


def build(keys: DataFrame, column: str) -> np.ndarray:
    """64-bit words of the filter. Set bits are joined per word on the executors."""
    count = keys.count()
    size = min(max(int(count * 12).bit_length(), LEAST), MOST)

    def places(batches):
        for batch in batches:
            where = _places(batch.column(0).to_numpy(zero_copy_only=False), size).ravel()
            order = np.unique(where)
            bit = np.left_shift(np.int64(1), (order & 63).astype(np.int64))
            yield pa.record_batch([order >> 6, bit], names=["w", "bit"])

    named = keys.select(F.col(column).cast("bigint").alias("k")).where("k IS NOT NULL")
    words = named.mapInArrow(places, "w bigint, bit bigint").groupBy("w").agg(F.bit_or("bit").alias("b"))
    rows = words.toArrow()  # at most 2**MOST / 64 rows
    bits = np.zeros(1 << (size - 6), np.int64)
    bits[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return bits


def _places(keys: np.ndarray, size: int) -> np.ndarray:
    h = mix(keys.astype(np.int64).view(np.uint64))
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)[:, None]
    return ((low + steps * high) & np.uint64((1 << size) - 1)).astype(np.int64)


def has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    where = _places(keys, (len(bits) << 6).bit_length() - 1)
    set_ = (bits[where >> 6] >> (where & 63)) & 1
    return set_.all(axis=0)
