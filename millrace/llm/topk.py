"""Exact top-k by integer inner product: three phases with a uniform threshold.

Components become ``floor(scale * x)``, so every score is a whole number. The dimensions are cut
into ``slices``; a slice of a query scores all points, and the scores of a slice make a list.
The score of a point is the sum of its entries in all lists. Points and queries are dealt in
blocks by their id, and a pair of blocks is a task's group, so the lists lie spread over tasks.

1. Each group gathers the best ``k`` entries of each of its lists. The entries' points are
   completed, and the ``k``-th best score that any group found for a query is its cutoff: at
   least ``k`` points reach it, so no point below it is wanted.
2. The cutoffs go to the groups along with the queries (a join by id, since queries grow with
   the data). With m lists, whose least entries are l1 to lm, a point whose every entry is below
   ``li + (cutoff - sum l) / m`` stays below the cutoff. Each group collects the other entries:
   those that reach this uniform share in some list. For an entry that was not collected the share
   bounds it from above, and points whose bounds sum to less than the cutoff are dropped.
3. The remaining points get the entries they lack, and so their exact score. Each group returns
   those that reach the cutoff, ``k`` at most per query; the best of all groups are the result.

Sums of whole numbers below 2^53 are exact in doubles; a group with larger ones counts in
unbounded integers. Scores beyond 64 bits count as the nearest number of 64 bits.

Defined results: vectors that are null, empty, of another length than most (the smaller of two
equally frequent lengths), or hold null or non-finite components take no part; zero vectors do;
rows with one id and one vector count once; a row never finds its own id; a null id takes no
part; ties go to the smaller id; a query has fewer than ``k`` rows if there are fewer points;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_EXACT = 2.0**53
_LIMITS = np.iinfo(np.int64)
#: Queries that are scored at a time within a group.
_STEP = 128
_CUTOFFS = pa.schema([("query_id", pa.int64()), ("score", pa.int64())])
_RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def slice_bounds(dimensions: int, slices: int) -> list[tuple[int, int]]:
    """``slices`` runs of dimensions of nearly equal length, fewer if there are not so many."""
    edges = np.linspace(0, dimensions, min(slices, dimensions) + 1).round().astype(int)
    return list(zip(edges[:-1].tolist(), edges[1:].tolist()))


def _kth(scores: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th greatest of each row, its least if there are fewer."""
    if scores.shape[1] <= k:
        return scores.min(axis=1, initial=np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def local_lists(q: np.ndarray, v: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """The entries of all lists: slice, query, point."""
    return np.stack([q[:, a:b] @ v[:, a:b].T for a, b in bounds])


def gather(lists: np.ndarray, other: np.ndarray, k: int) -> np.ndarray:
    """Phase 1: the points among the best ``k`` of any list, by query and point."""
    found = np.zeros(other.shape, bool)
    for entries in lists:
        entries = np.where(other, entries, -np.inf)
        found |= entries >= _kth(entries, k)[:, None]
    return found & other


def collect(lists: np.ndarray, other: np.ndarray, cutoff: np.ndarray) -> np.ndarray:
    """Phase 2: the points that the collected entries do not rule out.

    ``cutoff`` has the cutoff of each query, minus infinity where none is known.
    """
    least = np.where(other, lists, np.inf).min(axis=2)
    least[np.isinf(least)] = 0
    # Rounded down: the shares of all lists then sum to the cutoff at most.
    share = least + np.floor((cutoff - least.sum(axis=0)) / len(lists))
    sent = lists >= share[:, :, None]
    # Entries are whole numbers: one that was not sent is at least 1 below its share.
    known = cutoff > -np.inf
    above = np.where(known, share - 1, 0)[:, :, None]
    most = np.where(sent, lists, above).sum(axis=0)
    possible = sent.any(axis=0) & (most >= cutoff[:, None])
    return (possible | ~known[:, None]) & other


def _whole(values: np.ndarray, scale: float) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(values * scale), posinf=np.finfo(float).max, neginf=-np.finfo(float).max)


def _large_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Scores in unbounded integers, brought into 64 bits."""
    as_int = np.vectorize(int, otypes=[object])
    exact = as_int(q) @ as_int(v).T
    return np.array([[min(max(x, _LIMITS.min), _LIMITS.max) for x in row] for row in exact.tolist()], np.int64)


def _once(values: np.ndarray, ids: np.ndarray, also: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows without repetitions of an id together with its vector, by id."""
    order = np.lexsort((*values.T[::-1], ids))
    values, ids, also = values[order], ids[order], also[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (values[1:] != values[:-1]).any(axis=1)
    return values[new], ids[new], also[new]


Part = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def _group(table: pa.Table, dimensions: int, scale: float, bounds: list[tuple[int, int]], pick: Part, k: int):
    """Query ids, point ids and exact scores of the ``k`` best points that ``pick`` leaves."""
    asks = table["asks"].to_numpy()
    flat = table["v"].combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    values = _whole(flat.flatten().to_numpy().reshape(-1, dimensions), scale)
    ids = table["id"].to_numpy()
    cutoff = np.array([-np.inf if x is None else float(x) for x in table["cutoff"].to_pylist()])
    v, v_ids, _ = _once(values[~asks], ids[~asks], cutoff[~asks])
    q, q_ids, q_cut = _once(values[asks], ids[asks], cutoff[asks])
    found = [(np.zeros(0, np.int64),) * 3]
    exact = bool(len(q) and len(v)) and np.abs(q).max() * np.abs(v).max() * dimensions < _EXACT
    for start in range(0, len(q) if len(v) else 0, _STEP):
        some, some_ids = q[start : start + _STEP], q_ids[start : start + _STEP]
        other = some_ids[:, None] != v_ids[None, :]
        if exact:
            lists = local_lists(some, v, bounds)
            kept = pick(lists, other, q_cut[start : start + _STEP])
            row, point = np.nonzero(kept)
            # The kept points get the entries of all lists.
            score = lists[:, row, point].sum(axis=0).astype(np.int64)
        else:
            row, point = np.nonzero(other)
            score = _large_scores(some, v)[row, point]
        if exact:
            reached = score >= q_cut[start : start + _STEP][row]
            row, point, score = row[reached], point[reached], score[reached]
        # ``~`` reverses the order of whole numbers without an overflow.
        order = np.lexsort((v_ids[point], ~score, row))
        row, point, score = row[order], point[order], score[order]
        first = np.searchsorted(row, np.arange(len(some)))
        best = np.arange(len(row)) - first[row] < k
        found.append((some_ids[row[best]], v_ids[point[best]], score[best]))
    return tuple(np.concatenate(part) for part in zip(*found))


def top_k(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 64.0,
    slices: int = 2,
    block: int = 8192,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest scores of each query row, exactly.

    Fewer slices give tighter shares: of 10,256 vectors of 64 dimensions, 15 % are collected
    with two slices and 55 % with four.
    """
    spark = df.sparkSession
    vector = F.col("v")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    vectors = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        is_query.alias("is_query"),
    ).filter(F.col("id").isNotNull() & vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)))
    shape = (
        vectors.groupBy(F.size("v").alias("dimensions"))
        .agg(F.count("*").alias("n"), F.count_if("is_query").alias("q"))
        .orderBy(F.desc("n"), "dimensions")
        .first()
    )
    if shape is None or not shape["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dimensions = shape["dimensions"]
    bounds = slice_bounds(dimensions, slices)
    point_blocks, query_blocks = -(-shape["n"] // block), -(-shape["q"] // block)
    vectors = vectors.filter(F.size("v") == dimensions)

    def copies(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))

    def dealt(blocks: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(blocks))

    points = vectors.select(
        dealt(point_blocks).alias("p"),
        copies(query_blocks).alias("q"),
        F.lit(False).alias("asks"),
        "id",
        "v",
        F.lit(None).cast("long").alias("cutoff"),
    )

    def groups(queries: DataFrame) -> DataFrame:
        asked = queries.select(
            copies(point_blocks).alias("p"),
            dealt(query_blocks).alias("q"),
            F.lit(True).alias("asks"),
            "id",
            "v",
            "cutoff",
        )
        return points.unionByName(asked)

    def lists(key: tuple, table: pa.Table) -> pa.Table:
        def pick(entries: np.ndarray, other: np.ndarray, _: np.ndarray) -> np.ndarray:
            return gather(entries, other, k)

        ids, _, scores = _group(table, dimensions, scale, bounds, pick, k)
        return pa.table([pa.array(ids), pa.array(scores)], schema=_CUTOFFS)

    def resolve(key: tuple, table: pa.Table) -> pa.Table:
        found = _group(table, dimensions, scale, bounds, collect, k)
        return pa.table([pa.array(part) for part in found], schema=_RESULT)

    queries = vectors.filter("is_query").select("id", "v")
    gathered = (
        groups(queries.withColumn("cutoff", F.lit(None).cast("long")))
        .groupBy("p", "q")
        .applyInArrow(lists, "query_id long, score long")
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"))
    cutoffs = (
        gathered.withColumn("place", F.row_number().over(by_score))
        .filter(F.col("place") <= k)
        .filter(F.col("place") == k)
        .select(F.col("query_id").alias("asked"), F.col("score").alias("cutoff"))
    )
    resolved = (
        groups(queries.join(cutoffs, F.col("id") == F.col("asked"), "left"))
        .groupBy("p", "q")
        .applyInArrow(resolve, "query_id long, vec_id long, score long")
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        resolved.withColumn("rank", place)
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
