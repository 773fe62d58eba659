"""Fuzzy line deduplication by MinHash.

Lines are compared without white space at their ends; blank lines are left alone. A line's
character shingles fill a one-permutation MinHash signature; empty bins borrow from the next
filled one. Lines that agree in a band of the signature are candidates, and meet in the bucket of that
band. A bucket goes by the least bucket that any of its lines is in as well, so that close lines,
which share most buckets, meet once and not in each. There shingle sets are
compared exactly, and lines with a Jaccard similarity of at least ``similarity`` are linked.
Each line is compared once with the lines that are not yet linked, so a tight group of n
lines takes about n comparisons, and in a large bucket only with those that share one of its
rarer shingles, as any similar line does; no pairs leave the task. A large bucket is cut into
slices of ``slice_chars``, and each pair of slices is a task's group. Distributed union-find
over the verified links gives the components, and each keeps one line: the first by doc_id
(null last), then by place.

Defined results: a null text stays null and has no lines; a line shorter than ``shingle`` has
one shingle, itself; rows equal in doc_id and text count as one document and get the same
result; a document whose lines all go keeps an empty text; an empty table gives no rows;
other columns are kept, and ``n_lines`` and ``n_removed`` are replaced if they exist.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from millrace.llm.arrow import chunks, flat_text, mix
from millrace.llm.bloom import Bloom, build_bloom
from millrace.llm.components import connected_components
from millrace.llm.names import fresh, named
from millrace.llm.substrings import _window_hash
from millrace.session import Scratch

SHINGLE = 8
SIMILARITY = 0.8
#: Two lines at the similarity of 0.8 share one of 12 bands of 5 with a chance of 0.99, at
#: 0.9 with one of 0.99999; lines below 0.2 do so about once in 260 pairs.
BANDS, ROWS = 12, 5
SLICE_CHARS = 4 << 20
_GROUP_CHARS = 1 << 18


def _lines(column: pa.ChunkedArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All lines of all texts, trimmed, and where each text's lines begin."""
    data, offsets = flat_text(column)
    breaks = np.flatnonzero(data == 0x0A) + 1
    # Every text has a first line, also if it is empty.
    starts = np.concatenate([offsets[:-1], breaks])
    kind = np.concatenate([np.zeros(len(offsets) - 1, np.int8), np.ones(len(breaks), np.int8)])
    # A break at the end of a text opens an empty last line, before the next text's first.
    order = np.lexsort((-kind, starts)) if len(offsets) > 1 else np.zeros(0, np.int64)
    starts = starts[order]
    text = np.searchsorted(breaks, offsets[:-1], side="right") + np.arange(len(offsets) - 1)
    lines = pa.LargeStringArray.from_buffers(
        len(starts),
        pa.py_buffer(np.append(starts, len(data))),
        pa.py_buffer(np.ascontiguousarray(data)),
    )
    return pc.ascii_trim_whitespace(lines), np.append(text, len(starts))


def _values(column: pa.Array | pa.ChunkedArray) -> list:
    """``to_pylist`` for texts and bytes, some times as fast."""
    return column.to_numpy(zero_copy_only=False).tolist() if isinstance(column, pa.Array) else column.to_numpy().tolist()


def _distinct(column: pa.ChunkedArray) -> tuple[np.ndarray, list[str], list[bytes], np.ndarray]:
    """Codes of all lines, the distinct lines with their ids, and where each text's begin."""
    lines, first = _lines(column)
    coded = lines.dictionary_encode()
    texts = _values(coded.dictionary)
    ids = [xxhash.xxh3_128_digest(t.encode()) for t in texts]
    return coded.indices.to_numpy(zero_copy_only=False), texts, ids, first


def _shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, and where each line's begin."""
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    counts = np.maximum(lengths - size + 1, 1)
    first = np.concatenate([[0], np.cumsum(counts)])
    begin = np.cumsum(lengths) - lengths
    at = np.repeat(begin - first[:-1], counts)
    at += np.arange(first[-1])
    hashed = _window_hash(_mixed_letters(data), size)
    # Short lines, which have no window of their own, are hashed below.
    out = hashed.take(at, mode="clip") if len(hashed) else np.zeros(len(at), np.uint64)
    for i in np.flatnonzero(lengths < size):
        out[first[i]] = xxhash.xxh64_intdigest(texts[i].encode(), 1)
    return mix(out), first


#: ``mix`` of the code points of the first plane.
_LETTERS = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))


def _mixed_letters(points: np.ndarray) -> np.ndarray:
    if len(points) and points.max() < len(_LETTERS):
        return _LETTERS[points]
    return mix(points.astype(np.uint64) + np.uint64(1))


def _signatures(texts: list[str], shingle: int, bins: int) -> np.ndarray:
    hashes, first = _shingles(texts, shingle)
    place = hashes >> np.uint64(32)
    place *= np.uint64(bins)
    place >>= np.uint64(32)
    place = place.view(np.int64)
    place += np.repeat(np.arange(len(texts)) * bins, np.diff(first))
    signature = np.full(len(texts) * bins, np.uint32(0xFFFFFFFF))
    np.minimum.at(signature, place, hashes.astype(np.uint32))
    # Any value can be a minimum or come of borrowing, so none can mark an empty bin.
    filled = np.zeros(len(signature), bool)
    filled[place] = True
    signature, filled = signature.reshape(len(texts), bins), filled.reshape(len(texts), bins)
    open_ = np.flatnonzero(~filled.all(axis=1))
    while len(open_):
        part, full = signature[open_], filled[open_]
        # The next bin's value, changed so that own and borrowed values differ.
        borrowed = np.roll(part, -1, axis=1) * np.uint32(0x9E3779B1) + np.uint32(1)
        takes = ~full & np.roll(full, -1, axis=1)
        part[takes] = borrowed[takes]
        full |= takes
        signature[open_], filled[open_] = part, full
        open_ = open_[~full.all(axis=1)]
    return signature


def _bands(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """``band, id`` of each distinct line of a chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            _, texts, ids, _ = _distinct(table["text"])
            kept = [i for i, t in enumerate(texts) if t]
            # So many shingles at a time, and single lines that have more.
            ends = np.cumsum([len(texts[i]) for i in kept]) // _GROUP_CHARS
            for part in np.split(np.array(kept, np.int64), np.flatnonzero(np.diff(ends)) + 1):
                if not len(part):
                    continue
                signature = _signatures([texts[i] for i in part], shingle, bands * rows)
                values = signature.reshape(len(part), bands, rows).astype(np.uint64)
                key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(part), 1))
                for r in range(rows):
                    key = mix(key ^ values[:, :, r])
                names = pa.array([ids[i] for i in part], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.ravel().view(np.int64)),
                        names.take(pa.array(np.repeat(np.arange(len(part)), bands))),
                    ],
                    ["band", "id"],
                )

    return docs.select("text").mapInArrow(run, "band long, id binary")


def _occurrences(keyed: DataFrame, bloom: Bloom) -> DataFrame:
    """``id, doc_id, k1, k2, line, text`` of every line that is not blank.

    ``text`` is the line where its id may be wanted, once in a chunk, and null elsewhere.
    """
    shared = keyed.sparkSession.sparkContext.broadcast((bloom.words, bloom.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bloom(*shared.value)
        for table in chunks(batches, "text"):
            codes, texts, ids, first = _distinct(table["text"])
            row = np.repeat(np.arange(table.num_rows), np.diff(first))
            line = np.arange(len(codes)) - first[:-1][row]
            filled = np.array([bool(t) for t in texts], bool)[codes] if len(codes) else np.zeros(0, bool)
            row, line, codes = row[filled], line[filled], codes[filled]
            heads = np.fromiter((xxhash.xxh64_intdigest(i, 42) for i in ids), np.uint64, count=len(ids))
            wanted = np.zeros(len(ids), bool)
            wanted[known.find(heads)] = True
            once = np.zeros(len(codes), bool)
            once[np.unique(codes, return_index=True)[1]] = True
            kept = np.where(wanted[codes] & once, codes, -1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.binary()).take(pa.array(codes)),
                    *[table[c].combine_chunks().take(pa.array(row)) for c in ("doc_id", "k1", "k2")],
                    pa.array(line.astype(np.int32)),
                    pa.array(texts, pa.large_string()).take(pa.array(kept, mask=kept < 0)),
                ],
                ["id", "doc_id", "k1", "k2", "line", "text"],
            )

    return keyed.select("doc_id", "k1", "k2", "text").mapInArrow(
        run, "id binary, doc_id long, k1 long, k2 long, line int, text string"
    )


#: Groups of more lines are compared by way of their rarer shingles.
_FEW = 16


class _RareShingles:
    """For each line the lines that share one of its rarer shingles.

    Ordered by how often they occur, any two sets of similarity s share one of their first
    ``n - ceil(s n) + 1`` shingles. Lines that are linked leave the lists as they are read.
    """

    def __init__(self, values: np.ndarray, sizes: np.ndarray, similarity: float):
        _, codes, counts = np.unique(values, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((codes, counts[codes], owner))
        codes = codes[order]
        first = np.cumsum(sizes) - sizes
        place = np.arange(len(codes)) - first[owner]
        prefix = sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1
        kept = (place < prefix[owner]) & (counts[codes] > 1)
        codes, owner = codes[kept], owner[kept]
        bounds = np.searchsorted(owner, np.arange(len(sizes) + 1))
        self.own = [codes[a:b].tolist() for a, b in zip(bounds, bounds[1:])]
        order = np.argsort(codes, kind="stable")
        known, start = np.unique(codes[order], return_index=True)
        self.lists = dict(zip(known.tolist(), np.split(owner[order], start[1:])))

    def near(self, line: int, group: np.ndarray) -> np.ndarray:
        found = []
        for code in self.own[line]:
            lines = self.lists.get(code)
            if lines is None:
                continue
            lines = lines[group[lines] < 0]
            if len(lines):
                self.lists[code] = lines
                found.append(lines)
            else:
                del self.lists[code]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _coded(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """How many different hashes there are, and a code for each."""
    bits = np.uint64(len(hashes).bit_length())
    # Sorted by their high bits, with the place in the low ones, which needs no indirect sort.
    placed = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    placed.sort()
    at = (placed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ordered = hashes[at]
    new = ordered[1:] != ordered[:-1]
    if (new & (placed[1:] >> bits == placed[:-1] >> bits)).any():
        known, codes = np.unique(hashes, return_inverse=True)
        return len(known), codes
    codes = np.empty(len(hashes), np.int64)
    codes[at] = np.cumsum(np.append(False, new))
    return int(new.sum()) + 1, codes


def _few_groups(lines: list[list[str]], shingle: int, similarity: float) -> list[np.ndarray]:
    """``similar_groups`` of many groups of a few short lines, all at once."""
    lengths = np.array([len(x) for x in lines], np.int64)
    begin = np.cumsum(lengths) - lengths
    number = np.repeat(np.arange(len(lines)), lengths)
    hashes, first = _shingles([t for x in lines for t in x], shingle)
    line = np.repeat(np.arange(len(number)), np.diff(first))
    # A code for each different shingle of a group, and for each line the set of its codes.
    known, codes = _coded(mix(hashes + mix(number.astype(np.uint64))[line]))
    bits = known.bit_length()
    codes |= line << bits
    codes.sort()
    codes = codes[np.append(True, codes[1:] != codes[:-1])]
    sizes = np.bincount(codes >> bits, minlength=len(number))
    codes &= (1 << bits) - 1
    # The lines whose codes are still held.
    held = np.arange(len(number))
    group = np.full(len(number), -1)
    # Lines that are linked and wait to be compared come first, then those not yet linked.
    rank = np.ones(len(number), np.int64)
    while True:
        pivot = np.minimum.reduceat(rank * len(number) + np.arange(len(number)), begin)
        left = np.maximum.reduceat((group < 0).astype(np.int8), begin).astype(bool)
        if not left.any() or not len(held):
            break
        pivot = pivot % len(number)
        group[pivot[left]] = np.where(group[pivot[left]] < 0, pivot[left], group[pivot[left]])
        rank[pivot[left]] = 2
        mine = np.zeros(len(number), bool)
        mine[pivot[left]] = True
        mark = np.zeros(known, bool)
        mark[codes[np.repeat(mine[held], sizes[held])]] = True
        common = np.zeros(len(number), np.int64)
        common[held] = np.add.reduceat(mark[codes], np.cumsum(sizes[held]) - sizes[held], dtype=np.int64)
        size = sizes[pivot][number]
        linked = (group < 0) & (sizes >= similarity * size) & (size >= similarity * sizes)
        linked &= common >= similarity * (sizes + size - common) - 1e-9
        group[linked] = group[pivot][number][linked]
        rank[linked] = 0
        needed = ((rank < 2) & left[number])[held]
        if needed.mean() < 0.8:
            codes, held = codes[np.repeat(needed, sizes[held])], held[needed]
    return np.split(group - begin[number], begin[1:])


def _is_few(texts: list[str]) -> bool:
    return len(texts) <= _FEW and sum(map(len, texts)) <= _GROUP_CHARS


def similar_groups(texts: list[str], shingle: int, similarity: float) -> np.ndarray:
    """For each line the first line that a chain of similar lines connects it with."""
    if texts and _is_few(texts):
        return _few_groups([texts], shingle, similarity)[0]
    hashes, bounds = _shingles(texts, shingle)
    sets = [np.unique(hashes[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
    sizes = np.array([len(s) for s in sets], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    group = np.full(len(texts), -1)
    rare = _RareShingles(values, sizes, similarity) if len(texts) > _FEW else None
    for start in range(len(texts)):
        if group[start] >= 0:
            continue
        group[start] = start
        queue = [start]
        while queue:
            pivot = queue.pop()
            rest = np.flatnonzero(group < 0) if rare is None else rare.near(pivot, group)
            near = (sizes[rest] >= similarity * sizes[pivot]) & (sizes[pivot] >= similarity * sizes[rest])
            near = rest[near]
            if not len(near):
                continue
            counts = sizes[near]
            ends = np.cumsum(counts)
            at = np.repeat(first[near] - (ends - counts), counts) + np.arange(ends[-1])
            mine = sets[pivot]
            place = np.minimum(np.searchsorted(mine, values[at]), len(mine) - 1)
            common = np.add.reduceat((mine[place] == values[at]).astype(np.int64), ends - counts)
            linked = near[common >= similarity * (counts + sizes[pivot] - common) - 1e-9]
            group[linked] = start
            queue.extend(linked.tolist())
    return group


def _links(ids: list[list[bytes]], found: list[np.ndarray]) -> pa.RecordBatch:
    a: list[bytes] = []
    b: list[bytes] = []
    for names, group in zip(ids, found, strict=True):
        for at in np.flatnonzero(group != np.arange(len(names))).tolist():
            a.append(names[at])
            b.append(names[group[at]])
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


def _verified(members: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links ``a, b`` of similar lines from ``root, i, j, id, line``."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], list[str]]]:
        held, ids, texts = None, [], []
        for batch in batches:
            columns = [_values(batch.column(c)) for c in ("root", "i", "j", "id", "line")]
            for root, i, j, line_id, line in zip(*columns, strict=True):
                if (root, i, j) != held:
                    if len(ids) > 1:
                        yield ids, texts
                    held, ids, texts = (root, i, j), [], []
                ids.append(line_id)
                texts.append(line)
        if len(ids) > 1:
            yield ids, texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few: list[tuple[list[bytes], list[str]]] = []
        chars = 0
        for ids, texts in groups(batches):
            if _is_few(texts):
                few.append((ids, texts))
                chars += sum(map(len, texts))
            else:
                yield _links([ids], [similar_groups(texts, shingle, similarity)])
            if chars > _GROUP_CHARS:
                yield _links([x for x, _ in few], _few_groups([x for _, x in few], shingle, similarity))
                few, chars = [], 0
        if few:
            yield _links([x for x, _ in few], _few_groups([x for _, x in few], shingle, similarity))

    keys = ["root", "i", "j"]
    return members.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a binary, b binary")


def candidate_groups(
    docs: DataFrame, scratch: Scratch, shingle: int, bands: int, rows: int
) -> tuple[DataFrame, Bloom]:
    """``root, id`` of lines that share a bucket with another line, and a filter of these ids."""
    by_band = Window.partitionBy("band")
    shared = (
        _bands(docs, shingle, bands, rows)
        .withColumns({"least": F.min("id").over(by_band), "most": F.max("id").over(by_band)})
        .filter("least <> most")
        .select("band", "id")
        .distinct()
    )
    shared, _ = scratch.write(shared)
    low = shared.groupBy("id").agg(F.min("band").alias("low"))
    roots = shared.join(low, "id").groupBy("band").agg(F.min("low").alias("root"))
    members, _ = scratch.write(shared.join(roots, "band").select("root", "id").distinct())
    wanted, found = scratch.write(members.select("id").distinct(), {"n": F.count("*")})
    # The function of this name is XXH64 with the seed 42.
    return members, build_bloom(wanted.select(F.xxhash64("id")), found["n"])


def line_components(
    members: DataFrame, lines: DataFrame, scratch: Scratch, shingle: int, similarity: float, slice_chars: int
) -> DataFrame:
    """``node, root``: ids of lines that are similar to another one, and their component.

    ``lines`` has the text of every id in ``members``, and may have others.
    """
    placed, _ = scratch.write(members.join(lines, "id").select("root", "id", "line"))
    sizes = placed.groupBy("root").agg(
        F.ceil(F.sum(F.length("line")) / F.lit(slice_chars)).alias("slices")
    )
    sliced = (
        placed.join(sizes, "root")
        .withColumn("own", F.pmod(F.xxhash64("id"), F.col("slices")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
        .select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "line")
    )
    return connected_components(_verified(sliced, shingle, similarity), scratch)


def dedup_lines(
    df: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    slice_chars: int = SLICE_CHARS,
) -> DataFrame:
    """``df`` with the repeated lines of ``text`` removed, and ``n_lines, n_removed``."""
    scratch = Scratch(df.sparkSession)
    names = [c for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    k1, k2, gone_col = fresh(names, "_k1", "_k2", "_removed")
    keys = {"k1": F.xxhash64("doc_id", "text"), "k2": F.xxhash64(F.lit("second"), "text", "doc_id")}
    keyed = df.select("doc_id", "text").withColumns(keys)
    members, bloom = candidate_groups(df, scratch, shingle, bands, rows)
    found, _ = scratch.write(_occurrences(keyed, bloom))
    texts = found.filter("text is not null").select("id", F.col("text").alias("line")).dropDuplicates(["id"])
    components = line_components(members, texts, scratch, shingle, similarity, slice_chars)
    occurrences = found.join(components, F.col("id") == F.col("node"), "left").select(
        F.coalesce("root", "id").alias("root"), "doc_id", "k1", "k2", "line"
    )
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2", "line")
    places, _ = scratch.write(occurrences.select("root", place.alias("place")))
    kept = (
        places.groupBy("root")
        .agg(F.min("place").alias("kept"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    removed = (
        places.join(kept, "root")
        .filter(~F.col("place").eqNullSafe(F.col("kept")))
        .groupBy(F.col("place.k1").alias(k1), F.col("place.k2").alias(k2))
        .agg(F.collect_set("place.line").alias(gone_col))
    )
    joined = df.select(*[named(c) for c in names]).withColumns({k1: keys["k1"], k2: keys["k2"]}).join(
        removed, [k1, k2], "left"
    )
    fields = [
        *[df.schema[c] if c != "text" else StructField("text", StringType()) for c in names],
        StructField("n_lines", LongType()),
        StructField("n_removed", LongType()),
    ]

    # Inside, columns go by their position: mapInArrow takes no names with dots.
    inner = {c: f"c{i}" for i, c in enumerate(names)}

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, inner["text"]):
            texts, n_lines, n_removed = [], [], []
            for text, gone in zip(_values(table[inner["text"]]), table["gone"].to_pylist(), strict=True):
                lines = text.split("\n") if text else []
                gone = set(gone or ())
                n_lines.append(sum(bool(_strip(line)) for line in lines))
                n_removed.append(len(gone))
                texts.append(text if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone))
            new = {"text": pa.array(texts, pa.large_string()), "n_lines": pa.array(n_lines, pa.int64()),
                   "n_removed": pa.array(n_removed, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [new[f.name] if f.name in new else table[inner[f.name]].combine_chunks() for f in fields],
                [f.name for f in fields],
            )

    return joined.select(
        *[named(c).alias(inner[c]) for c in names], F.col(gone_col).alias("gone")
    ).mapInArrow(rebuild, StructType(fields))


def _strip(line: str) -> str:
    return line.strip(" \t\n\r\x0b\x0c")
