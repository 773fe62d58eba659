"""Natural-key comparison: NULL sentinels and optional case folding."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class KeyRule:
    """How key columns are compared.

    ``null_sentinels`` maps a column to the value a NULL is compared as; the real
    sentinel value then equals NULL. Columns without one follow SQL: NULL matches nothing.
    """

    null_sentinels: Mapping[str, object] = field(default_factory=dict)
    fold_case: bool = False

    def comparable(self, c: Column, data_type: DataType, name: str) -> Column:
        if self.fold_case and isinstance(data_type, StringType):
            c = F.lower(c)
        if name in self.null_sentinels:
            c = F.coalesce(c, F.lit(self.null_sentinels[name]).cast(data_type))
        return c

    def columns(self, df: DataFrame, names: list[str], sentinel_names: list[str] | None = None) -> list[Column]:
        """Comparable forms of ``names``, with sentinels looked up under ``sentinel_names``."""
        lookup = sentinel_names or names
        return [
            self.comparable(F.col(f"`{n}`"), df.schema[n].dataType, s) for n, s in zip(names, lookup)
        ]


def key_hash(columns: list[Column]) -> Column:
    """One 64-bit routing value per key; equal keys have equal values."""
    return F.xxhash64(*columns)
