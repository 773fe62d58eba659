"""Surrogate keys looked up from natural keys."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule, key_hash

# A key is hot if it alone would fill more than this part of an even shuffle partition. Fewer
# than partitions / HOT_PART keys can be, which bounds what resolve_keys broadcasts for them.
HOT_PART = 0.25
# The sketch follows so many keys for each that may be hot, up to what it allows.
_TRACKED = 8
_MOST_TRACKED = 1_000_000


def hot_share(spark: SparkSession) -> float:
    """The share of all rows from which on a key is hot."""
    return HOT_PART / int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_key_metric(fact: DataFrame, columns: list[str], rule: KeyRule, sentinels: list[str]) -> Column:
    """Aggregate of the most frequent key hashes; small enough to ride along with a write."""
    keys = rule.columns(fact, columns, sentinels)
    wanted = min(math.ceil(1 / hot_share(fact.sparkSession)), _MOST_TRACKED // _TRACKED)
    return F.call_function("approx_top_k", key_hash(keys), F.lit(wanted), F.lit(wanted * _TRACKED))


def hot_hashes(top: Sequence, rows: int, share: float) -> list[int]:
    """Hashes of the keys worth a path of their own; wrong guesses cost time, not rows."""
    return [entry["item"] for entry in top if entry["count"] > rows * share]


def _equal(left: list[Column], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [x == F.col(y) for x, y in zip(left, right, strict=True)])


def resolve_keys(
    fact: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    id_col: str,
    how: str = "left",
    rule: KeyRule = KeyRule(),
    hot: Sequence[int] = (),
    spread_by: Column | None = None,
) -> DataFrame:
    """Add ``dim``'s ``id_col`` to ``fact`` by equality of the ``(fact, dim)`` column pairs.

    ``how`` is ``left`` (unresolved rows keep a NULL id) or ``inner`` (they are dropped).
    Sentinels of ``rule`` are named by the columns of ``dim``, whose keys are unique.

    The join has no broadcast hint: Spark compares both sides' sizes with its threshold,
    before and while it runs. Rows whose key hash is in ``hot`` take their id from a
    broadcast of just those few dimension rows. In the shuffle join they are routed by
    ``spread_by``, a number that differs between rows, and so fill all partitions evenly;
    all other rows are routed by their key. Should such a number happen to be the route of
    the row's own key, the join finds the same id once more.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how}")
    fact_names, dim_names = [f for f, _ in on], [d for _, d in on]
    # Compared as expressions: copies of the keys would be shuffled along with each row.
    keys = rule.columns(fact, fact_names, dim_names)
    dim_keys = [f"_dim_key{i}" for i in range(len(on))]
    lookup = dim.select(
        *[c.alias(n) for c, n in zip(rule.columns(dim, dim_names), dim_keys)], F.col(id_col)
    )
    columns = [F.col(f"`{c}`") for c in fact.columns]
    if not hot:
        return fact.join(lookup, _equal(keys, dim_keys), how).select(*columns, id_col)

    if spread_by is None:
        raise ValueError("hot keys need spread_by, a number that differs between rows")
    route, dim_route = key_hash(keys), key_hash([F.col(k) for k in dim_keys])
    few = lookup.filter(dim_route.isin(list(hot))).select(
        *[F.col(k).alias(f"_hot{k}") for k in dim_keys], F.col(id_col).alias("_hot_id")
    )
    probe = fact.withColumn("_is_hot", route.isin(list(hot))).withColumn(
        "_route", F.when(F.col("_is_hot"), spread_by).otherwise(route)
    )
    hot_match = F.col("_is_hot") & _equal(keys, [f"_hot{k}" for k in dim_keys])
    joined = probe.join(F.broadcast(few), hot_match, "left").join(
        lookup.withColumn("_dim_route", dim_route),
        _equal(keys, dim_keys) & (F.col("_route") == F.col("_dim_route")),
        "left",
    )
    resolved = joined.select(*columns, F.coalesce("_hot_id", id_col).alias(id_col))
    return resolved if how == "left" else resolved.filter(F.col(id_col).isNotNull())


def fk_violations(fact: DataFrame, dim: DataFrame, fk_col: str, id_col: str) -> DataFrame:
    """Foreign keys absent from ``dim``, with the number of rows that use each.

    Rows are counted per key before the shuffle, so that a frequent key stays one row.
    """
    used = fact.filter(F.col(fk_col).isNotNull()).groupBy(fk_col).agg(F.count("*").alias("row_count"))
    known = dim.select(F.col(id_col).alias("_known_id"))
    return used.join(known, F.col(fk_col) == F.col("_known_id"), "left_anti")
