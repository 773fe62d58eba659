"""Generated keys."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import Scratch

_INDEX_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def row_number_parts(sequence: Column) -> tuple[Column, Column]:
    """Partition and position within it of a ``monotonically_increasing_id`` value."""
    return (
        F.shiftrightunsigned(sequence, _INDEX_BITS).cast("bigint"),
        sequence.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)),
    )


def assign_ids(
    df: DataFrame, order: list[Column], id_col: str, start: int, scratch: Scratch
) -> DataFrame:
    """Number the rows ``start``, ``start + 1``, ... in the given order.

    The rows are sorted by range over all tasks and written once, so that numbers never
    change afterwards; only one count per partition reaches the driver.
    """
    ranged = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_sequence", F.monotonically_increasing_id())
    )
    written, _ = scratch.write(ranged)
    partition, position = row_number_parts(F.col("_sequence"))
    counts = {
        row["_partition"]: row["rows"]
        for row in written.groupBy(partition.alias("_partition")).agg(F.count("*").alias("rows")).collect()
    }
    sizes = [counts.get(i, 0) for i in range(max(counts, default=0))]
    before = json.dumps(list(accumulate(sizes, initial=start)))
    offset = F.get(F.from_json(F.lit(before), "array<bigint>"), partition.cast("int"))
    return written.select((offset + position).alias(id_col), *[f"`{c}`" for c in df.columns])


def unordered_ids(sequence: Column, partitions: int, start: int) -> Column:
    """Distinct numbers from ``start`` for stored sequence values; gaps, but no shuffle."""
    partition, position = row_number_parts(sequence)
    return F.lit(start) + position * F.lit(partitions) + partition
