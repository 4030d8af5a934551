"""Bitmaps of a fixed size that let a scan drop most rows a later exact join would drop.

A bitmap never loses a row: it only passes some that the join after it removes. Its size is fixed whatever
the input's size, so it may be sent to every task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**24 bits are 2 MB.
BITS = 24


def build(df: DataFrame, key: Column, bits: int = BITS) -> np.ndarray:
    """Words of a bitmap with bit (key mod 2**bits) set for every non-null 64-bit key of df."""
    at = F.pmod(key, F.lit(1 << bits))
    words = (
        df.where(key.isNotNull()).select(F.shiftright(at, 6).cast("int").alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int")).alias("v"))
        .groupBy("w").agg(F.bit_or("v").alias("v"))
    ).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["w"].to_numpy()] = words["v"].to_numpy().view(np.uint64)
    return out


def hits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned 64-bit keys may be in the bitmap."""
    at = keys & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def marker(bitmap: np.ndarray, key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: the rows with a column hot, whether the bitmap may have their key."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("hot", pa.array(hits(bitmap, batch[key].to_numpy().view(np.uint64))))

    return marked
