"""Idempotent upsert of a batch into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule
from millrace.operators.ids import assign_ids
from millrace.session import Scratch

_KEPT, _UPDATED, _NEW = 0, 1, 2
_STATE = "_merge_state"


class AmbiguousSourceError(ValueError):
    """Different source rows claim the same key."""


@dataclass(frozen=True)
class Merge:
    """What an upsert does: the match key, the overwritten columns, the generated ones."""

    keys: tuple[str, ...]
    update_cols: tuple[str, ...]
    id_col: str
    created_col: str
    rule: KeyRule = KeyRule()

    @property
    def source_cols(self) -> list[str]:
        return [*self.keys, *self.update_cols]

    @property
    def key_names(self) -> list[str]:
        return [f"_key{i}" for i in range(len(self.keys))]

    def as_is(self) -> dict[str, str]:
        """Key columns that are compared as they are, with the name of their comparable form."""
        return {
            k: n
            for k, n in zip(self.keys, self.key_names)
            if k not in self.rule.null_sentinels and not self.rule.fold_case
        }

    def keyed(self, source: DataFrame) -> DataFrame:
        """The comparable keys, and the columns that do not follow from them."""
        keys = self.rule.columns(source, list(self.keys))
        return source.select(
            *[k.alias(n) for k, n in zip(keys, self.key_names)],
            *[F.col(f"`{c}`") for c in self.source_cols if c not in self.as_is()],
        )


@dataclass(frozen=True)
class Changes:
    """A written merge: the rows the target had, with new values, and the rows to add.

    ``changed`` are the keys and values of updated and new rows. ``parts`` are the partitions of the target that get other content, ``part`` computes the
    partition of a row.
    """

    rows: DataFrame
    inserted: DataFrame
    changed: DataFrame
    updated_rows: int
    inserted_rows: int
    parts: list[str]
    part: Column


def _compared(keyed: DataFrame, merge: Merge) -> list[Column]:
    """The values by which rows of one key are told apart."""
    return [
        merge.rule.comparable(F.col(f"`{c}`"), keyed.schema[c].dataType, "")
        for c in keyed.columns
        if c not in merge.key_names
    ]


def key_fingerprints(source: DataFrame, merge: Merge) -> DataFrame:
    """Per key the number of its rows, and whether their values differ.

    The least and the greatest of two 64-bit hashes are numbers, so that this is a hash
    aggregate before and after the shuffle: nothing is sorted, the copies of a frequent key
    are counted where they are, and no values travel. Hashes of equal rows are equal; those of
    two different rows are so with a chance of 2^-128.
    """
    keyed = merge.keyed(source)
    values = _compared(keyed, merge)
    # The hash function leaves missing values out: which ones are missing is hashed as well.
    missing = F.array(F.lit(False), *[v.isNull() for v in values])
    hashes = [F.xxhash64(F.lit(seed), missing, *values) for seed in (1, 2)]
    differ = reduce(lambda a, b: a | b, [F.min(h) != F.max(h) for h in hashes])
    return keyed.groupBy(*merge.key_names).agg(F.count("*").alias("_rows"), differ.alias("_differ"))


def ambiguous_keys(source: DataFrame, merge: Merge) -> DataFrame:
    """Keys with different source rows, found by hashes and then compared value by value."""
    suspects = key_fingerprints(source, merge).filter("_differ").select(
        *[F.col(n).alias(f"_suspect{n}") for n in merge.key_names]
    )
    keyed = merge.keyed(source)
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_suspect{n}")) for n in merge.key_names])
    row = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(_compared(keyed, merge))])
    bounds = keyed.join(suspects, same, "left_semi").groupBy(*merge.key_names).agg(
        F.min(row).alias("_least"), F.max(row).alias("_greatest"), F.min(F.struct(*keyed.columns)).alias("_row")
    )
    as_is = merge.as_is()
    return bounds.filter(~F.col("_least").eqNullSafe(F.col("_greatest"))).select(
        *[(F.col(as_is[k]) if k in as_is else F.col(f"_row.`{k}`")).alias(k) for k in merge.keys]
    )


def check_batch(source: DataFrame, merge: Merge) -> int:
    """The number of rows that repeat another; different rows of one key are an error.

    Reads the batch once, without the order or the values of its rows.
    """
    found = key_fingerprints(source, merge).agg(
        F.count_if("_differ").alias("suspects"), (F.sum("_rows") - F.count("*")).alias("copies")
    ).first()
    if found["suspects"]:
        ambiguous = ambiguous_keys(source, merge)
        count = ambiguous.count()
        if count:
            sample = ambiguous.limit(20).collect()
            raise AmbiguousSourceError(
                f"{count} keys have different source rows, such as " + "; ".join(str(tuple(row)) for row in sample)
            )
    return found["copies"] or 0


def one_row_per_key(source: DataFrame, merge: Merge, copies: int) -> DataFrame:
    """The comparable keys and the values of a checked batch, without its ``copies``.

    Copies are dropped by a hash aggregate before the shuffle. If letters of any case are equal,
    the least spelling of a key stands for all.
    """
    keyed = merge.keyed(source)
    if not copies:
        return keyed
    if not merge.rule.fold_case:
        return keyed.distinct()
    values = [c for c in keyed.columns if c not in merge.key_names]
    least = F.min(F.struct(*[F.col(f"`{c}`") for c in values])).alias("_row")
    return keyed.groupBy(*merge.key_names).agg(least).select(*merge.key_names, "_row.*")


def merge_rows(target: DataFrame, batch: DataFrame, merge: Merge) -> DataFrame:
    """Every row of the target and of the batch after the merge, in one join.

    ``_STATE`` tells kept, updated and new rows apart; new ones have no id yet. Whole rows of the
    target meet the batch, so neither is read or moved a second time.
    """
    as_is = merge.as_is()
    values = {c: F.col(as_is.get(c, f"_new_{c}")) for c in merge.source_cols}
    incoming = batch.select(
        *merge.key_names,
        *[F.col(f"`{c}`").alias(f"_new_{c}") for c in batch.columns if c not in merge.key_names],
        F.lit(True).alias("_in_batch"),
    )
    keys = merge.rule.columns(target, list(merge.keys))
    same_key = reduce(lambda a, b: a & b, [k == F.col(n) for k, n in zip(keys, merge.key_names)])
    is_new = F.col(f"`{merge.id_col}`").isNull()
    same_values = reduce(
        lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(values[c]) for c in merge.update_cols], F.lit(True)
    )
    state = (
        F.when(is_new, F.lit(_NEW)).when(F.col("_in_batch") & ~same_values, F.lit(_UPDATED)).otherwise(F.lit(_KEPT))
    )
    joined = target.join(incoming, same_key, "full_outer").withColumn(_STATE, state)

    def after(c: str) -> Column:
        old = F.col(f"`{c}`")
        if c in merge.update_cols:
            return F.when(F.col(_STATE) == _KEPT, old).otherwise(values[c]).alias(c)
        if c in merge.keys:
            return F.when(F.col(_STATE) == _NEW, values[c]).otherwise(old).alias(c)
        return old

    return joined.select(*[after(c) for c in target.columns], _STATE)


def plan_changes(
    target: DataFrame,
    source: DataFrame,
    merge: Merge,
    created_at: datetime,
    scratch: Scratch,
    next_id: int | None = None,
    part: Column | None = None,
) -> Changes:
    """Merge a batch with the partitions of the target it may touch; number the new rows.

    The batch is checked by a narrow aggregate, then batch and target are shuffled once by the
    key and the merged rows are written to the scratch folder. From there come the new rows,
    numbered in key order, and the partitions with a change. ``part`` computes a row's
    partition from the columns of the source; ``target`` has to hold all partitions of the batch.
    """
    batch = one_row_per_key(source, merge, check_batch(source, merge))
    part = F.lit("") if part is None else part
    changed = F.col(_STATE) != _KEPT
    merged, found = scratch.write(
        merge_rows(target, batch, merge),
        {
            "new": F.count_if(F.col(_STATE) == _NEW),
            "updated": F.count_if(F.col(_STATE) == _UPDATED),
            "parts": F.collect_set(F.when(changed, part)),
        },
    )
    if next_id is None:
        next_id = (merged.agg(F.max(f"`{merge.id_col}`")).first()[0] or 0) + 1
    new = merged.filter(F.col(_STATE) == _NEW).select(*merge.source_cols)
    if found["new"]:
        order = [k.asc_nulls_first() for k in merge.rule.columns(new, list(merge.keys))]
        new = assign_ids(new, order, merge.id_col, next_id, scratch)
    else:
        new = new.withColumn(merge.id_col, F.lit(None).cast("bigint"))
    inserted = new.select(
        F.col(merge.id_col),
        *merge.source_cols,
        F.lit(created_at).cast("timestamp").alias(merge.created_col),
    )
    rows = merged.filter(F.col(_STATE) != _NEW).drop(_STATE)
    differing = merged.filter(changed).select(*merge.source_cols)
    return Changes(rows, inserted, differing, found["updated"], found["new"], sorted(found["parts"]), part)


def merged_rows(changes: Changes) -> DataFrame:
    """All rows after the merge: ids and creation times stay, no row is removed."""
    return changes.rows.unionByName(changes.inserted, allowMissingColumns=True)


def apply_changes(changes: Changes) -> DataFrame:
    """The new content of the partitions that change."""
    touched = changes.rows.filter(changes.part.isin(changes.parts))
    return touched.unionByName(changes.inserted, allowMissingColumns=True)


def upsert(
    target: DataFrame,
    source: DataFrame,
    merge: Merge,
    created_at: datetime,
    scratch: Scratch,
    next_id: int | None = None,
) -> DataFrame:
    return merged_rows(plan_changes(target, source, merge, created_at, scratch, next_id))
