"""A bitmap of fixed size that tells most keys that are not there, before rows are shuffled by key.

It is a filter and never decides a result: a key whose bit is not set is absent, others are looked up by a
join. The driver receives at most BITS / 2**15 rows of 4 KB and passes on BITS / 8 bytes, whatever the number
of keys; with many more keys than bits the filter lets everything through.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.text_arrays import U

#: Bits of a bitmap (8 MB).
BITS = 1 << 26
_ROW = 1 << 15  # bits in a row of Spark's bitmap functions


def presence_bitmap(keys: DataFrame, key: Column) -> Broadcast:
    """The bitmap of a long column, for :func:`maybe_present` in Python workers."""
    bit = key.bitwiseAND(F.lit(BITS - 1))
    rows = (
        keys.select(bit.alias("bit"))
        .groupBy(F.floor(F.col("bit") / _ROW).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % _ROW).alias("bits"))
    )
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    width = _ROW // 8
    for part, bits in rows.toLocalIterator():
        bitmap[part * width : part * width + len(bits)] = np.frombuffer(bytes(bits), dtype=np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bitmap)


def maybe_present(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Of unsigned 64-bit keys, those whose bit is set."""
    bit = keys & U(BITS - 1)
    return (bitmap[bit >> U(3)] >> (bit & U(7)).astype(np.uint8)) & np.uint8(1) > 0
