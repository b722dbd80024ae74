"""Sets of hashes as tables of bits of a fixed size, built by Spark."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronscope.llm.common import fmix64, shuffles_freed


def places(keys: np.ndarray, size: int) -> np.ndarray:
    return (fmix64(keys) % np.uint64(size)).astype(np.int64)


def holds_bits(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the table (as bytes) may hold each key; a key that was put in is always held."""
    at = places(keys, 8 * len(bitmap))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & np.uint8(1) != 0


def bits_of(keys: DataFrame, size: int) -> bytes:
    """A table of ``size`` bits, a multiple of 65,536, with those of the column ``key`` set.

    Tasks draw blocks of 65,536 bits; the driver gets at most ``size`` bits, whatever the number of keys.
    """

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.unique(places(b.column(0).to_numpy().view(np.uint64), size))
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 16), pa.array(bits & 0xFFFF)], ["block", "bit"])

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for b in batches:
            block, bit = b.column(0).to_numpy(), b.column(1).to_numpy()
            for number in np.unique(block).tolist():
                known.setdefault(number, np.zeros(1 << 16, bool))[bit[block == number]] = True
        for number, marks in known.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([np.packbits(marks, bitorder="little").tobytes()])],
                ["block", "marks"],
            )

    out = bytearray(size // 8)
    with shuffles_freed(keys.sparkSession):
        bits = keys.select("key").mapInArrow(numbered, "block long, bit long")
        rows = bits.repartition(F.col("block")).mapInArrow(drawn, "block long, marks binary")
        found = rows.limit(size >> 16).collect()
    for row in found:
        out[row.block << 13 : (row.block + 1) << 13] = row.marks
    return bytes(out)
