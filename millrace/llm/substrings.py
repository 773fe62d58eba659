"""Exact removal of repeated passages, by super-k-mers.

A window is ``window`` consecutive words of one document. Its minimiser is the least hash of
the ``mer``-word sequences in it, so equal windows have equal minimisers. Consecutive windows
that share one travel together, as one packed string of their words, to the bucket of that
minimiser, where all windows of a bucket are sorted and equal ones counted.

Before that, a task counts the windows of the text it holds. A window found twice there is
already known to be repeated, and one copy of it travels; so a passage sends each bucket one
copy per chunk of text, not one per occurrence, and no bucket gathers a hot passage.

Equality is decided on words: within a task equal words have equal codes, windows are sorted
by a hash of their codes, and neighbours with equal hashes are compared code by code.

Defined results: a null text has no words; a document with fewer words than ``window`` has no
window; rows are judged one by one, so a repeated row is another occurrence of all its
windows; a null doc_id is an ordinary row; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import Words, chunks, flat_text, hash_words, mix, split_words

_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
#: Text in which a task finds repetitions by itself; what it sends is packed by this much.
SCAN_BYTES = 8 << 20
#: Rows that carry marks go past the buckets: a run of repeated windows of one document.
_MARK = -1

_ROWS = "bucket int, part int, k1 long, k2 long, start int, n int, head binary, words binary"
_ROWS_ARROW = pa.schema(
    [
        ("bucket", pa.int32()),
        ("part", pa.int32()),
        ("k1", pa.int64()),
        ("k2", pa.int64()),
        ("start", pa.int32()),
        ("n", pa.int32()),
        ("head", pa.binary()),
        ("words", pa.binary()),
    ]
)
_MARKS = "k1 long, k2 long, start int, n int"
#: Per super-k-mer: the document's keys, its first window, its words, whether it is repeated.
_HEAD = np.dtype([("k1", "<i8"), ("k2", "<i8"), ("start", "<i4"), ("words", "<i4"), ("multi", "?")])


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; a moderate number of them is kept."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, _KEPT_POWERS), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        _POWERS[base] = known[:_KEPT_POWERS].copy()
    return known[:n]


_POWERS: dict[int, np.ndarray] = {}
_KEPT_POWERS = 1 << 19


def _window_hash(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive values, from sums of a polynomial."""
    n = len(values)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _powers(_P, n), out=sums[1:])
    return (sums[size:] - sums[:-size]) * _powers(_P_INVERSE, n - size + 1)


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """The least of every ``size`` consecutive values."""
    have, out = 1, values
    while have < size:
        step = min(have, size - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _window_starts(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all windows that lie within one text, and their texts."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][text] + offset, text


def _classes(codes: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows ordered so that equal ones are adjacent, and whether each equals the one before.

    Stable: of equal windows the first comes first.
    """
    hashes = _window_hash(mix(codes.astype(np.uint64) + np.uint64(1)), size)[starts]
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    same = np.zeros(len(order), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    pairs = np.flatnonzero(same)
    differ = np.zeros(len(pairs), bool)
    for j in range(size):
        differ |= codes[starts[order[pairs]] + j] != codes[starts[order[pairs - 1]] + j]
    if differ.any():
        # Different windows share a hash: put those of such a hash in order by their words.
        for h in np.unique(ordered[pairs[differ]]):
            low, high = np.searchsorted(ordered, [h, h + np.uint64(1)]) if h < ~np.uint64(0) else (
                np.searchsorted(ordered, h), len(ordered))
            group = sorted(order[low:high], key=lambda w: (codes[starts[w] : starts[w] + size].tolist(), w))
            order[low:high] = group
            for i in range(low + 1, high):
                a, b = starts[order[i - 1]], starts[order[i]]
                same[i] = np.array_equal(codes[a : a + size], codes[b : b + size])
    return order, same


def _runs(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs in which the first column counts up and the others stay."""
    if not len(columns[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    broken = np.diff(columns[0]) != 1
    for c in columns[1:]:
        broken |= c[1:] != c[:-1]
    cut = np.flatnonzero(broken) + 1
    return np.concatenate([[0], cut]), np.concatenate([cut, [len(columns[0])]])


def _marks(k1: np.ndarray, k2: np.ndarray, start: np.ndarray) -> list[pa.Array]:
    """Runs of repeated windows as columns ``k1, k2, start, n``."""
    order = np.lexsort((start, k2, k1))
    k1, k2, start = k1[order], k2[order], start[order]
    a, b = _runs(start, k1, k2)
    return [
        pa.array(k1[a], pa.int64()),
        pa.array(k2[a], pa.int64()),
        pa.array(start[a].astype(np.int32)),
        pa.array((b - a).astype(np.int32)),
    ]


def _scan(
    batches: Iterator[pa.RecordBatch], window: int, mer: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    """Marks of windows repeated within a chunk; one copy of every window for its bucket."""
    for table in chunks(batches, "text", SCAN_BYTES):
        data, offsets = flat_text(table["text"])
        words = split_words(data, offsets)
        starts, text = _window_starts(words.first, window)
        if not len(starts):
            continue
        codes, distinct = words.encode()
        k1 = table["k1"].to_numpy()[text]
        k2 = table["k2"].to_numpy()[text]
        at = starts - words.first[:-1][text]
        order, same = _classes(codes, starts, window)
        repeated = same.copy()
        repeated[:-1] |= same[1:]
        is_repeated = np.empty(len(starts), bool)
        is_repeated[order] = repeated
        is_first = np.empty(len(starts), bool)
        is_first[order] = ~same
        found = np.flatnonzero(is_repeated)
        if len(found):
            marks = _marks(k1[found], k2[found], at[found])
            n = len(marks[0])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, _MARK, np.int32)),
                    pa.array((np.arange(n) % buckets).astype(np.int32)),
                    *marks,
                    pa.nulls(n, pa.binary()),
                    pa.nulls(n, pa.binary()),
                ],
                schema=_ROWS_ARROW,
            )
        mers = mix(_window_hash(hash_words(distinct)[codes], mer))
        least = _window_min(mers, window - mer + 1)[starts]
        yield _packed(words, starts, k1, k2, at, least, is_first, is_repeated, window, buckets)


def _packed(
    words: Words,
    starts: np.ndarray,
    k1: np.ndarray,
    k2: np.ndarray,
    at: np.ndarray,
    least: np.ndarray,
    is_first: np.ndarray,
    is_repeated: np.ndarray,
    window: int,
    buckets: int,
) -> pa.RecordBatch:
    sent = np.flatnonzero(is_first)
    # Windows of two documents are never consecutive: words of the last window lie between.
    a, b = _runs(starts[sent], least[sent], is_repeated[sent])
    head = np.zeros(len(a), _HEAD)
    begin, end = starts[sent[a]], starts[sent[b - 1]] + window
    head["k1"], head["k2"], head["start"] = k1[sent[a]], k2[sent[a]], at[sent[a]]
    head["words"], head["multi"] = end - begin, is_repeated[sent[a]]
    bucket = (least[sent[a]] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    head, bucket = head[order], bucket[order]
    low, high = words.starts[begin[order]], words.ends[end[order] - 1]
    view = memoryview(np.ascontiguousarray(words.data))
    numbers, first = np.unique(bucket, return_index=True)
    heads, packs = [], []
    for i, j in zip(first, np.append(first[1:], len(bucket)), strict=True):
        pack = b" ".join([view[x:y] for x, y in zip(low[i:j].tolist(), high[i:j].tolist(), strict=True)])
        heads.append(_squeeze(head[i:j].tobytes()))
        packs.append(_squeeze(pack))
    n = len(numbers)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(numbers.astype(np.int32)),
            pa.array(numbers.astype(np.int32)),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int64()),
            pa.nulls(n, pa.int32()),
            pa.nulls(n, pa.int32()),
            pa.array(heads, pa.binary()),
            pa.array(packs, pa.binary()),
        ],
        schema=_ROWS_ARROW,
    )


def _squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def _expand(packed: bytes) -> bytes:
    return pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd", asbytes=True)


def _count_bucket(heads: list[bytes], packs: list[bytes], window: int) -> pa.RecordBatch:
    head = np.concatenate([np.frombuffer(_expand(h), _HEAD) for h in heads])
    data = np.frombuffer(b" ".join([_expand(p) for p in packs]), np.uint8)
    words = split_words(data, np.array([0, len(data)]))
    codes, _ = words.encode()
    first = np.zeros(len(head) + 1, np.int64)
    np.cumsum(head["words"], out=first[1:])
    starts, mer = _window_starts(first, window)
    order, same = _classes(codes, starts, window)
    # A class is repeated if it has two members or one that was repeated where it came from.
    number = np.cumsum(~same) - 1
    size = np.bincount(number)
    multi = np.bincount(number, head["multi"][mer][order]) > 0
    repeated = ((size > 1) | multi)[number] & ~head["multi"][mer][order]
    found = order[repeated]
    at = head["start"][mer] + (starts - first[:-1][mer])
    return pa.RecordBatch.from_arrays(
        _marks(head["k1"][mer][found], head["k2"][mer][found], at[found]), ["k1", "k2", "start", "n"]
    )


def repeated_windows(
    keyed: DataFrame, window: int = 35, mer: int = 4, buckets: int | None = None
) -> DataFrame:
    """Runs ``k1, k2, start, n``: the ``n`` windows from word ``start`` on occur elsewhere too.

    ``keyed`` has ``k1, k2, text``. A task holds one bucket at a time: ``buckets`` (as a rule
    four for each shuffle partition) should keep one within some tens of MB.
    """
    if not 1 <= mer <= window:
        raise ValueError("a minimiser must fit into a window")
    spark = keyed.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = buckets or 4 * partitions

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _scan(batches, window, mer, buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: int | None = None
        heads: list[bytes] = []
        packs: list[bytes] = []
        for batch in batches:
            kinds = batch.column("bucket").to_numpy(zero_copy_only=False)
            marks = np.flatnonzero(kinds == _MARK)
            if len(marks):
                part = batch.take(pa.array(marks))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in ("k1", "k2", "start", "n")], ["k1", "k2", "start", "n"]
                )
            for i in np.flatnonzero(kinds != _MARK).tolist():
                if heads and kinds[i] != held:
                    yield _count_bucket(heads, packs, window)
                    heads, packs = [], []
                held = kinds[i]
                heads.append(batch.column("head")[i].as_py())
                packs.append(batch.column("words")[i].as_py())
        if heads:
            yield _count_bucket(heads, packs, window)

    return (
        keyed.select("k1", "k2", "text")
        .mapInArrow(scan, _ROWS)
        .repartition(partitions, "part")
        .sortWithinPartitions("bucket")
        .mapInArrow(count, _MARKS)
    )


_DIGEST = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_repeated(
    df: DataFrame, window: int = 35, mer: int = 4, buckets: int | None = None, texts: bool = True
) -> DataFrame:
    """Per row: ``doc_id, n_words, n_removed, kept_sha256``, and ``kept``, the words that stay.

    Words covered by a window that occurs elsewhere are removed; the others are joined by one
    space. ``texts=False`` leaves ``kept`` null where only the digest is wanted.
    """
    # Two 64-bit hashes name a row: rows they do not tell apart have one id and one text.
    keyed = df.select("doc_id", "text").withColumns(
        {
            "k1": F.xxhash64("doc_id", "text"),
            "k2": F.xxhash64(F.lit("second"), "text", "doc_id"),
        }
    )
    marks = (
        repeated_windows(keyed, window, mer, buckets)
        .groupBy("k1", "k2")
        .agg(F.collect_set(F.struct("start", "n")).alias("marks"))
    )

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            rows = {"doc_id": table["doc_id"].to_pylist(), "n_words": [], "n_removed": []}
            rows |= {"kept_sha256": [], "kept": []}
            for text, runs in zip(table["text"].to_pylist(), table["marks"].to_pylist(), strict=True):
                words = text.encode().split() if text else []
                change = np.zeros(len(words) + 1, np.int64)
                for run in runs or ():
                    change[run["start"]] += 1
                    change[run["start"] + run["n"] + window - 1] -= 1
                stays = np.cumsum(change)[:-1] == 0
                kept = words if not runs else [words[i] for i in np.flatnonzero(stays).tolist()]
                joined = b" ".join(kept)
                rows["n_words"].append(len(words))
                rows["n_removed"].append(len(words) - len(kept))
                rows["kept_sha256"].append(hashlib.sha256(joined).hexdigest())
                rows["kept"].append(joined.decode() if texts else None)
            yield pa.RecordBatch.from_pydict(rows, schema=_DIGEST_ARROW)

    return keyed.join(marks, ["k1", "k2"], "left").select("doc_id", "text", "marks").mapInArrow(
        keep, _DIGEST
    )


_DIGEST_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.large_string()),
    ]
)
