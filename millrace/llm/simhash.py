"""SimHash near-duplicates: fingerprints linked through BK-trees.

A text is lower-cased (A-Z), cut into words and shingles of ``shingle`` words, and every
shingle votes with the bits of its XXH64 hash. Fingerprints that differ in at most
``max_bits`` bits are linked, and linked documents share a component.

Two fingerprints within the radius agree in all bits outside at most ``max_bits`` of the
blocks of bits. Each choice of the other blocks deals the fingerprints into shards, so that
every link lies within a shard. A shard has one BK-tree, and all its members search it: only
edges whose distance lies within the radius of the distance to the parent can lead to a hit.
The trees are dealt to tasks with the members that search them: a broadcast of trees over
all documents would grow with the corpus. Shards larger than ``shard`` are cut into slices,
and each pair of slices is a task of its own. A task returns a spanning forest of its links.

Defined results: null text counts as empty; a text without words has fingerprint zero, and
with fewer words than ``shingle`` it has one shingle of all its words; repeated rows with one
doc_id give one row each; a null doc_id is never the name of a component unless all members
have none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import CHUNK_BYTES, chunks
from millrace.llm.components import connected_components
from millrace.llm.names import fresh, named
from millrace.session import Scratch

SEED = 42


def _fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    digests: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    of = xxhash.xxh64_digest
    for i, text in enumerate(texts):
        words = text.encode().lower().split() if text else []
        if not words:
            continue
        if len(words) <= shingle:
            found = [b" ".join(words)]
        else:
            found = list(map(b" ".join, zip(*[words[j:] for j in range(shingle)], strict=False)))
        digests.extend([of(s, SEED) for s in found])
        counts[i] = len(found)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        hashes = np.frombuffer(b"".join(digests), ">u8").astype(np.uint64)
        at = (np.cumsum(counts) - counts)[some]
        for bit in range(64):
            ones = (hashes >> np.uint64(bit)) & np.uint64(1)
            over_half = 2 * np.add.reduceat(ones.astype(np.int32), at) > counts[some]
            out[some] |= over_half.astype(np.uint64) << np.uint64(bit)
    return out


def add_fingerprint(df: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """``doc_id, fingerprint`` (a signed 64-bit number) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", CHUNK_BYTES // 2):
            found = _fingerprints(table["text"].to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays(
                [table["doc_id"].combine_chunks(), pa.array(found.view(np.int64))],
                ["doc_id", "fingerprint"],
            )

    return df.select("doc_id", F.col(f"`{text}`").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint long"
    )


class BKTree:
    """A tree whose edges carry the whole-number distance of child and parent."""

    def __init__(self, values: np.ndarray):
        """Built level by level: the first value of each group becomes its node."""
        n = len(values)
        self.values = values
        self.edge = np.zeros(n, np.int64)
        parent = np.full(n, -1, np.int64)
        group = np.zeros(n, np.int64)
        rest = np.arange(n)
        while len(rest):
            # Within a group (same parent, same distance), the first is the node.
            _, first, inverse = np.unique(group[rest], return_index=True, return_inverse=True)
            heads = rest[first]
            under = heads[inverse]
            others = rest != under
            rest, under = rest[others], under[others]
            distance = np.bitwise_count(values[rest] ^ values[under]).astype(np.int64)
            parent[rest], self.edge[rest] = under, distance
            group[rest] = under * 65 + distance
        # Children of a node lie together, sorted by edge.
        key = np.where(parent < 0, -1, parent * 65 + self.edge)
        self.children = np.argsort(key, kind="stable")
        self.keys = key[self.children]

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of query and node positions within the radius, a level of the tree at a time."""
        for start in range(0, len(queries), 512):
            yield from self._search(queries, start, min(start + 512, len(queries)), radius)

    def _search(
        self, queries: np.ndarray, start: int, stop: int, radius: int
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        q = np.arange(start, stop if len(self.values) else start)
        node = np.full(len(q), self.children[0] if len(q) else 0)
        while len(q):
            distance = np.bitwise_count(queries[q] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            yield q[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), "right")
            width = high - low
            q = np.repeat(q, width)
            at = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
            node = self.children[np.repeat(low, width) + at]


def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n members the least member that the pairs connect it with."""
    root = np.arange(n)
    for a, b in pairs:
        while True:
            ra, rb = root[a], root[b]
            open_ = ra != rb
            a, b = a[open_], b[open_]
            if not len(a):
                break
            ra, rb = ra[open_], rb[open_]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                up = root[root]
                if np.array_equal(up, root):
                    break
                root = up
    return root


def link_fingerprints(
    fingerprints: DataFrame,
    max_bits: int = 2,
    blocks: int = 4,
    shard: int = 4096,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Links ``a, b`` of different fingerprints that connect whatever lies within the radius.

    ``fingerprints`` has one column of distinct signed 64-bit numbers. ``blocks`` must exceed
    ``max_bits``; more blocks make more keys and smaller shards.
    """
    if not 0 <= max_bits < blocks <= 64:
        raise ValueError("blocks must exceed max_bits")
    name = fingerprints.columns[0]
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (e - s)) - 1) << s for s, e in zip(edges, edges[1:], strict=False)]
    choices = [sum(masks[i] for i in c) for c in combinations(range(blocks), blocks - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in choices]
    value = F.col(name)
    keyed = fingerprints.select(
        value.alias("value"),
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("choice"), value.bitwiseAND(F.lit(m)).alias("key"))
                    for i, m in enumerate(signed)
                ]
            )
        ).alias("k"),
    ).select("value", "k.choice", "k.key")
    sizes = keyed.groupBy("choice", "key").agg(F.count("*").alias("size")).filter("size > 1")
    slices = F.ceil(F.col("size") / F.lit(shard))
    # Slice i of a shard meets each slice j: the pair (i, j), i <= j, is one task's group.
    own = F.pmod(F.xxhash64("value"), slices)
    members = (
        keyed.join(sizes, ["choice", "key"])
        .withColumn("slices", slices)
        .withColumn("own", own)
        .select(
            "value",
            "choice",
            "key",
            "own",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("other"),
        )
        .select(
            "value",
            "choice",
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
        )
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in _groups(batches):
            change = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            bounds = np.concatenate([[0], change, [len(keys)]])
            a, b = [], []
            for start, stop in zip(bounds, bounds[1:], strict=False):
                if stop - start < 2:
                    continue
                group = values[start:stop]
                tree = BKTree(group)
                root = _forest(len(group), tree.search(group, max_bits))
                linked = np.flatnonzero(root != np.arange(len(group)))
                a.append(group[linked])
                b.append(group[root[linked]])
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], ["a", "b"]
                )

    def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Whole groups, several at a time; the last group of a batch waits for the next."""
        keys, values = np.zeros((0, 4), np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            more = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(5)]
            keys = np.concatenate([keys, np.stack(more[:4], axis=1).astype(np.int64)])
            values = np.concatenate([values, more[4].astype(np.int64).view(np.uint64)])
            ends = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
            if len(ends):
                yield keys[: ends[-1]], values[: ends[-1]]
                keys, values = keys[ends[-1] :], values[ends[-1] :]
        if len(keys):
            yield keys, values

    group = ["choice", "key", "i", "j"]
    return (
        members.select(*group, "value")
        .repartition(*group)
        .sortWithinPartitions(*group)
        .mapInArrow(search, "a long, b long")
    )


def simhash_components(
    df: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 2, shard: int = 4096
) -> DataFrame:
    """``doc_id, fingerprint, component_id``: the least doc_id that links can reach."""
    scratch = Scratch(df.sparkSession)
    documents, _ = scratch.write(add_fingerprint(df, text, shingle))
    distinct, _ = scratch.write(
        documents.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"))
    )
    links = link_fingerprints(distinct.select("fingerprint"), max_bits, shard=shard)
    roots = connected_components(links, scratch)
    named = distinct.join(roots, distinct["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root")
    )
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    # Few rows per fingerprint: documents meet their component by fingerprint.
    components = named.join(least, "root").select("fingerprint", "component_id")
    return documents.join(components, "fingerprint").select(
        "doc_id", "fingerprint", "component_id"
    )


def keep_one(
    df: DataFrame, text: str = "text", shingle: int = 3, max_bits: int = 2, shard: int = 4096
) -> DataFrame:
    """The rows of ``df`` with one row of each component: the one with the least doc_id.

    A null doc_id comes last; of rows with one doc_id, one of each component stays.
    """
    scratch = Scratch(df.sparkSession)
    (row,) = fresh(df.columns, "_row")
    # Rows are numbered as they are written, so that copies of a row can be told apart.
    rows, _ = scratch.write(df.withColumn(row, F.monotonically_increasing_id()))
    prints = add_fingerprint(
        rows.select(F.col(row).alias("doc_id"), named(text).alias("text")), "text", shingle
    ).select(F.col("doc_id").alias("_row"), "fingerprint")
    prints, _ = scratch.write(prints)
    distinct = prints.select("fingerprint").distinct()
    roots = connected_components(link_fingerprints(distinct, max_bits, shard=shard), scratch)
    found = prints.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "_row", F.coalesce("root", "fingerprint").alias("root")
    )
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_row")
    ids = rows.select(F.col(row).alias("_row"), "doc_id")
    first = found.join(ids, "_row").groupBy("root").agg(F.min(order).alias("f"))
    return rows.join(first.select(F.col("f._row").alias(row)), row, "left_semi").select(
        *[named(c) for c in df.columns]
    )


def hex_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
