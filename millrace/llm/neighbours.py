"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Points are parted by length: a range ends at half the length it begins with, and the first
begins with the longest vector. The vectors of a range are scaled by its greatest length into
the unit ball and get one more component that lifts them onto the sphere, where the least
Euclidean distance is the largest inner product; so a few long vectors do not draw the others
together. Queries visit the buckets of every range. Each of ``tables``
tables hashes a point with ``hashes`` functions ``floor((a x + b) / width)``, a Gaussian and
b uniform. A query visits its own bucket and perturbed ones, in the order of their estimated
chance to hold a near point: the perturbations are a fixed sequence over the ranks of the
query's distances to the bucket walls, sorted by expected cost. All points in a visited
bucket of any table are candidates, and candidates are ranked by their exact inner product.

Points are dealt in blocks by their id, queries in blocks too, and each pair of blocks is a
task's group: no bucket, however full, meets in one task, and a task holds two blocks. Within
a group the members of the visited buckets are gathered and only they are scored. A query
whose buckets hold fewer than ``k`` of the group's points, or so many (one in ``DENSE``) that
products with all points cost less than gathering, is scored against all points of the group.
Every task keeps the best of its group for each query.

Defined results: vectors that are null, empty, zero, of another length than most (the smaller
of two equally frequent lengths), or hold null or non-finite components take no part; rows
with one id and one vector count once; a row never finds its own id; a null id takes no part;
ties go to the smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TABLES, HASHES, WIDTH, PROBES = 5, 8, 2.0, 400
#: A query that visits one in so many points of a group or more is scored against all of them.
DENSE = 8
#: The last range of lengths takes all that are shorter.
_RANGES = 60
_RESULT = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])


def probe_sequence(hashes: int, probes: int) -> list[tuple[int, ...]]:
    """Sets of ranks among the ``2 * hashes`` sorted wall distances, cheapest first.

    The expected squared distance of rank i stands for its cost; a set may not hold both
    walls of one function, which are the ranks i and 2 * hashes - 1 - i.
    """
    m = hashes
    low = [(i + 1) * (i + 2) / (4 * (m + 1) * (m + 2)) for i in range(m)]
    cost = low + [1 - (m - i) / (m + 1) + (m - i) * (m - i + 1) / (4 * (m + 1) * (m + 2)) for i in range(m)]
    found: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))]
    while heap and len(found) < probes:
        value, ranks = heapq.heappop(heap)
        if not any(2 * m - 1 - r in ranks for r in ranks):
            found.append(ranks)
        last = ranks[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (value + cost[last + 1], (*ranks, last + 1)))
            heapq.heappush(heap, (value - cost[last] + cost[last + 1], (*ranks[:-1], last + 1)))
    return found


class Hasher:
    """The hash functions of all tables; equal arguments give equal functions everywhere."""

    def __init__(self, dimensions: int, tables: int, hashes: int, width: float, probes: int, seed: int):
        random = np.random.default_rng(seed)
        self.lines = random.standard_normal((tables, dimensions + 1, hashes))
        self.shifts = random.uniform(0, width, (tables, hashes))
        self.factors = random.integers(1, 1 << 62, (tables, hashes)) | 1
        self.width = width
        sequence = probe_sequence(hashes, probes)
        self.sets = np.zeros((len(sequence), 2 * hashes), np.int64)
        for i, ranks in enumerate(sequence):
            self.sets[i, list(ranks)] = 1

    def _places(self, points: np.ndarray, table: int) -> np.ndarray:
        return (points @ self.lines[table] + self.shifts[table]) / self.width

    def buckets(self, points: np.ndarray, table: int) -> np.ndarray:
        cells = np.floor(self._places(points, table)).astype(np.int64)
        return (cells * self.factors[table]).sum(axis=1)

    def probes(self, points: np.ndarray, table: int) -> np.ndarray:
        """The buckets to visit, a row per query, in the order of estimated success."""
        places = self._places(points, table)
        cells = np.floor(places)
        within = places - cells
        walls = np.concatenate([within, 1 - within], axis=1)
        steps = np.concatenate([-self.factors[table], self.factors[table]])
        ranked = steps[np.argsort(walls, axis=1, kind="stable")]
        own = (cells.astype(np.int64) * self.factors[table]).sum(axis=1)
        return own[:, None] + ranked @ self.sets.T


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vector.isNotNull()
        & (F.size(vector) > 0)
        & ~F.coalesce(bad, F.lit(True))
        & F.exists(vector, lambda x: x != 0)
    )


def nearest(
    df: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = TABLES,
    hashes: int = HASHES,
    width: float = WIDTH,
    probes: int = PROBES,
    block: int = 8192,
    seed: int = 7,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best candidates of each query row."""
    spark = df.sparkSession
    vectors = df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
        is_query.alias("is_query"),
    ).filter(F.col("id").isNotNull() & _usable(F.col("v")))
    squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    shape = (
        vectors.groupBy(F.size("v").alias("dimensions"))
        .agg(F.count("*").alias("n"), F.max(squared).alias("longest"), F.count_if("is_query").alias("q"))
        .orderBy(F.desc("n"), "dimensions")
        .first()
    )
    columns = "query_id long, vec_id long, score double"
    if shape is None or not shape["q"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dimensions, longest = shape["dimensions"], float(shape["longest"]) ** 0.5
    point_blocks = -(-shape["n"] // block)
    query_blocks = -(-shape["q"] // block)
    vectors = vectors.filter(F.size("v") == dimensions)
    points = vectors.select(
        F.pmod(F.xxhash64("id"), F.lit(point_blocks)).alias("p"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))).alias("q"),
        F.lit(False).alias("asks"),
        "id",
        "v",
    )
    queries = vectors.filter("is_query").select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(point_blocks - 1).cast("long"))).alias("p"),
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).alias("q"),
        F.lit(True).alias("asks"),
        "id",
        "v",
    )

    def best(key: tuple, table: pa.Table) -> pa.Table:
        asks = table["asks"].to_numpy()
        ids = table["id"].to_numpy()
        flat = table["v"].combine_chunks()
        flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
        values = flat.flatten().to_numpy().reshape(-1, dimensions)
        hasher = Hasher(dimensions, tables, hashes, width, probes, seed)
        v, v_ids = _once(values[~asks], ids[~asks])
        q, q_ids = _once(values[asks], ids[asks])
        if not len(v) or not len(q):
            return _RESULT.empty_table()
        members = _members(v, longest, hasher, tables)
        found = []
        for start in range(0, len(q), 256):
            found.append(_rank(q[start : start + 256], q_ids[start : start + 256], v, v_ids, hasher, members, k))
        return pa.concat_tables(found)

    merged = (
        points.unionByName(queries)
        .groupBy("p", "q")
        .applyInArrow(best, columns)
        .distinct()
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (
        merged.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


def _once(values: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows without repetitions of an id together with its vector, by id."""
    order = np.lexsort((*values.T[::-1], ids))
    values, ids = values[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (values[1:] != values[:-1]).any(axis=1)
    return values[new], ids[new]


#: For each table and range: its buckets, where each one's points begin, and the points.
Members = list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]]


def _members(v: np.ndarray, longest: float, hasher: Hasher, tables: int) -> Members:
    scaled = v / longest
    length = np.sqrt((scaled * scaled).sum(axis=1))
    halvings = np.floor(-np.log2(np.maximum(length, 2.0**-_RANGES)))
    halvings = np.clip(halvings, 0, _RANGES)
    scaled *= np.exp2(halvings)[:, None]
    lift = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1, keepdims=True)))
    lifted = np.concatenate([scaled, lift], axis=1)
    ranges = [np.flatnonzero(halvings == h) for h in np.unique(halvings)]
    out: Members = []
    for table in range(tables):
        buckets = hasher.buckets(lifted, table)
        out.append([])
        for points in ranges:
            points = points[np.argsort(buckets[points], kind="stable")]
            known, first = np.unique(buckets[points], return_index=True)
            out[-1].append((known, np.append(first, len(points)), points))
    return out


def _visited(lifted: np.ndarray, n: int, hasher: Hasher, members: Members) -> np.ndarray:
    """Whether a query, by row, visits a bucket with the point, by column."""
    candidate = np.zeros((len(lifted), n), bool)
    for table, ranges in enumerate(members):
        wanted = hasher.probes(lifted, table)
        for known, first, points in ranges:
            at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            row, probe = np.nonzero(known[at] == wanted)
            bucket = at[row, probe]
            counts = first[bucket + 1] - first[bucket]
            begin = np.cumsum(counts) - counts
            place = np.repeat(first[bucket] - begin, counts) + np.arange(counts.sum())
            candidate[np.repeat(row, counts), points[place]] = True
    return candidate


def _rank(
    q: np.ndarray,
    q_ids: np.ndarray,
    v: np.ndarray,
    v_ids: np.ndarray,
    hasher: Hasher,
    members: Members,
    k: int,
) -> pa.Table:
    norm = np.sqrt((q * q).sum(axis=1, keepdims=True))
    lifted = np.concatenate([q / norm, np.zeros((len(q), 1))], axis=1)
    other = q_ids[:, None] != v_ids[None, :]
    candidate = _visited(lifted, len(v), hasher, members) & other
    n = candidate.sum(axis=1)
    whole = (n < k) | (n * DENSE >= len(v))
    candidate[whole] = other[whole]
    scores = np.full(candidate.shape, -np.inf)
    scores[whole] = np.where(other[whole], q[whole] @ v.T, -np.inf)
    for i in np.flatnonzero(~whole):
        points = np.flatnonzero(candidate[i])
        scores[i, points] = v[points] @ q[i]
    if len(v) > k:
        worst = np.partition(scores, len(v) - k, axis=1)[:, len(v) - k]
    else:
        worst = np.full(len(q), -np.inf)
    # A product of matrices may round otherwise than a sum in order: the final scores are
    # summed in order, and rows within rounding of the last place stay until then.
    near = candidate & (scores >= (worst - 1e-9 * (1 + np.abs(worst)))[:, None])
    a, b = np.nonzero(near)
    exact = np.cumsum(q[a] * v[b], axis=1)[:, -1] if len(a) else np.zeros(0)
    order = np.lexsort((v_ids[b], -exact, a))
    a, b, exact = a[order], b[order], exact[order]
    begin = np.searchsorted(a, np.arange(len(q)))
    kept = np.arange(len(a)) - begin[a] < k
    return pa.table(
        [pa.array(q_ids[a[kept]]), pa.array(v_ids[b[kept]]), pa.array(exact[kept])], schema=_RESULT
    )
