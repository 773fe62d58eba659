"""Column contracts of feeds, staging tables and final tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    required: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class TableSpec:
    """A table: its columns, its generated id, and the column its files are divided by.

    Rows of a table with a ``batch_col`` are only ever added, a batch at a time; the column
    names the batch.
    """

    name: str
    fields: tuple[Field, ...]
    id_col: str | None = None
    created_col: str | None = None
    partition_col: str | None = None
    batch_col: str | None = None

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{f.name}` {f.type}" for f in self.fields))


def text(name: str, max_length: int, required: bool = False) -> Field:
    return Field(name, "string", required, max_length)
