"""Filters of the keys of a batch, which cut a dimension down before it is joined."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule, key_hash

#: Bits of a filter: 16 for each row of the batch, within these powers of two (2 MB at most).
LEAST_BITS, MOST_BITS = 16, 24
#: Places of a key in the filter.
_PROBES = 2


@dataclass(frozen=True)
class KeyColumns:
    """Columns of a fact that are looked up in a dimension, and that dimension's names."""

    columns: tuple[str, ...]
    dim_columns: tuple[str, ...]
    rule: KeyRule = KeyRule()


@dataclass(frozen=True)
class KeyFilter:
    """A Bloom filter: words of 64 bits, ``bits`` the power of two of their number."""

    words: Sequence[int]
    bits: int

    def may_hold(self, keys: list[Column]) -> Column:
        """False only for keys that no row of the batch has; no join, no shuffle."""
        words = F.from_json(F.lit(json.dumps(list(self.words))), "array<bigint>")
        found = F.lit(True)
        for place in _places(keys, self.bits):
            word = F.get(words, F.shiftrightunsigned(place, 6).cast("int"))
            found = found & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found


def _places(keys: list[Column], bits: int) -> list[Column]:
    """Bit positions of a key, from disjoint parts of its hash."""
    h = key_hash(keys)
    return [
        F.shiftrightunsigned(h, 32 * i).bitwiseAND(F.lit((1 << bits) - 1)).cast("bigint") for i in range(_PROBES)
    ]


def filter_bits(rows: int) -> int:
    return min(max(math.ceil(math.log2(16 * max(rows, 1))), LEAST_BITS), MOST_BITS)


def key_filters(batch: DataFrame, lookups: Mapping[str, KeyColumns], rows: int) -> dict[str, KeyFilter]:
    """A filter per lookup, from one scan of the key columns of a written batch of ``rows`` rows.

    Tasks send at most the words of the filters, by a hash aggregate of numbers; the keys
    themselves are neither made distinct nor moved. A batch with more keys than a filter has room for
    lets more of the dimension pass, and loses nothing.
    """
    bits = filter_bits(rows)
    # Each place of a key is an entry: the filter it is for, and the position in it.
    entries = F.array(
        *[
            F.struct(F.lit(i).alias("filter"), place.alias("place"))
            for i, lookup in enumerate(lookups.values())
            for place in _places(
                lookup.rule.columns(batch, list(lookup.columns), list(lookup.dim_columns)), bits
            )
        ]
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    found = (
        batch.select(F.inline(entries))
        .groupBy("filter", F.shiftrightunsigned("place", 6).alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()
    )
    words = [[0] * (1 << (bits - 6)) for _ in lookups]
    for row in found:
        words[row["filter"]][row["word"]] = row["bits"]
    return {name: KeyFilter(w, bits) for name, w in zip(lookups, words)}


def prune_dimension(dim: DataFrame, keys: KeyFilter, lookup: KeyColumns) -> DataFrame:
    """The rows of ``dim`` whose key may occur in the batch: all that do, and a few others."""
    return dim.filter(keys.may_hold(lookup.rule.columns(dim, list(lookup.dim_columns))))
