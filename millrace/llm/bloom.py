"""A Bloom filter of a column, with a bound on its size whatever the number of its values."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import mix

#: Bits of the filter: 16 for each value, within these powers of two.
LEAST_BITS, MOST_BITS = 20, 28
_PROBES = 4


def _place(value: np.ndarray, i: int, bits: int) -> np.ndarray:
    return mix(value + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(64 - bits)


@dataclass(frozen=True)
class Bloom:
    words: np.ndarray
    bits: int

    def find(self, values: np.ndarray) -> np.ndarray:
        """Positions of the values that may be in the column; none that is gets lost."""
        at = np.arange(len(values))
        for i in range(_PROBES):
            place = _place(values[at], i, self.bits)
            at = at[(self.words[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0]
        return at


def build_bloom(values: DataFrame, n: int) -> Bloom:
    """The filter of the first column, signed 64-bit hashes; ``n`` is about their number.

    Tasks send words of the filter that have bits, merged by a partial aggregate: the driver
    gets at most ``2 ** (MOST_BITS - 6)`` of them. A fuller filter lets more values pass and
    loses none.
    """
    bits = min(max(math.ceil(math.log2(16 * max(n, 1))), LEAST_BITS), MOST_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(_PROBES):
                place = _place(value, i, bits)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((place >> np.uint64(6)).astype(np.int64)),
                        pa.array((np.uint64(1) << (place & np.uint64(63))).view(np.int64)),
                    ],
                    ["word", "bits"],
                )

    found = (
        values.mapInArrow(run, "word long, bits long")
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .toArrow()
    )
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return Bloom(words, bits)
