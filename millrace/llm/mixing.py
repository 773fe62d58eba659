"""Language-model scores by logistic context mixing, and a smoothed unigram base.

The model predicts the bits of the lower-cased (A-Z) UTF-8 text and of one end byte, each from
several predictors. A predictor is a table of bit counts under hashed contexts: the last
``ORDERS`` bytes, and the bits of the byte so far. Predictions are mixed in the logistic
domain with weights that the bits of the byte so far select (the gate), times two gains, of
short and of long contexts, that start at one and are refined online: after every ``BLOCK``
bytes of a document the gains follow the gradient of its coding cost. A last stage, adaptive while it is trained,
maps the mixed prediction to what was observed where it was made, and the two are averaged.
The cost of a text is its total bits; divided by its bytes, bits per byte.

Learning is distributed: tasks count the contexts of the documents they read and send their
counts in blocks, which are summed in two steps, by block and group of tasks, then by block.
Training documents of one tenth (``mix_fold``) are left out of the tables: they train weights,
gains' start and last stage, because contexts look too certain on texts they were counted on.
The tables have a fixed size, so that they can be sent along; other texts than those counted
share their slots, which costs accuracy and nothing else.

The base adds ``log10((c + 0.1) / (N + 0.1 (V + 1)))`` over tokens: words and one end. Tokens
that hold more than a share of all tokens are scored where they are read, from a broadcast
that this share bounds; all others meet their count in a bucket of their hash. What a bucket
finds for the rows of a chunk of text goes back to that chunk as one row.

Defined results: a null text counts as empty and has one token, the end; rows are scored one
by one, so repeated rows repeat their scores; a null doc_id is held out; with nothing to
learn from, the tables are empty and every bit costs one; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import Words, chunks, flat_text, mix, split_words
from millrace.session import Scratch

ORDERS = (1, 2, 3, 4, 6)
#: So many of the orders are short contexts.
SHORT = 2
#: Slots of each order's table, as powers of two; a slot has the 15 nodes of four bits.
SLOT_BITS = (12, 16, 17, 18, 19)
_PAD = max(ORDERS)
_END = 0xFF
#: Slots of a table that are summed, sent and stored together, and their entries.
_PART_SLOTS = 1 << 12
_PART = 16 * _PART_SLOTS
BLOCK = 256
GAIN_RATE = 3.0
WEIGHT_RATE = 0.5
_BUCKETS = 64
_GROUPS = 32
_STRETCH_SCALE = 16.0
_SCORE_BYTES = 1 << 14
#: Bytes whose logits are mixed while they stay in the processor's cache.
_CACHED = 1 << 12
_MIX_BYTES = 2 << 20
#: Bytes that a counting task counts before it sends its counts: each adds two at most to one of 32 bits.
_MOST = 1 << 31


#: Lower case of A-Z, other bytes as they are.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _windows(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Each byte to predict as a number with those before it, and how many each text has.

    The byte is highest, then come the ``_PAD`` bytes before it, the last one first, so that
    windows that share a context of any order and the byte are neighbours when sorted.
    """
    data, offsets = flat_text(column)
    sizes = np.diff(offsets) + 1
    texts = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(_LOWER.take(data))]
    )
    ends = [pa.scalar(bytes([_END]) * n, pa.large_binary()) for n in (_PAD + 1, 1, 0)]
    framed = pc.binary_join_element_wise(ends[0], texts, *ends[1:])
    framed = np.frombuffer(framed.buffers()[2], np.uint8, len(data) + (_PAD + 2) * len(sizes))
    # The eight bytes up to each place, of which the first is not used.
    eight = np.ascontiguousarray(np.ndarray(len(framed) - 7, "<u8", framed, strides=(1,)))
    places = np.repeat(np.arange(len(sizes)) * (_PAD + 1), sizes)
    places += np.arange(len(places))
    return eight.take(places) & np.uint64(0xFFFFFFFFFFFFFF00), sizes


def _byte(windows: np.ndarray) -> np.ndarray:
    return (windows >> np.uint64(56)).astype(np.int64)


def _runs(windows: np.ndarray, order: int) -> np.ndarray:
    """Which of the sorted windows differ from the one before in context of this order or byte."""
    known = windows >> np.uint64(56 - 8 * ORDERS[order])
    return np.append(True, known[1:] != known[:-1])[: len(windows)]


def _slots(windows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the first and of the last four bits of a byte after its context."""
    k = ORDERS[order]
    shift = np.uint64(64 - SLOT_BITS[order])
    # The bytes before as one number, the last in the lowest bits.
    context = (windows << np.uint64(8)).byteswap() & np.uint64((1 << 8 * k) - 1)
    own = mix(context * np.uint64(8) + np.uint64(k))
    low = mix(own ^ ((windows >> np.uint64(60)) + np.uint64(1)))
    return (own >> shift).astype(np.int64), (low >> shift).astype(np.int64)


def _entries(windows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each window's slots hold its byte's first and last four bits."""
    byte = _byte(windows)
    high, low = _slots(windows, order)
    return high * 16 + (byte >> 4), low * 16 + (byte & 15)


#: The nodes of each four bits within a slot.
_NODES = np.stack([(1 << b) + (np.arange(16) >> (4 - b)) for b in range(4)], axis=1)


def _bits(byte: np.ndarray) -> np.ndarray:
    return (byte[None, :] >> np.arange(7, -1, -1)[:, None]) & 1


_COUNTS = "part int, grp int, counts binary"


def _pack(part: int, group: int, counts: np.ndarray) -> dict:
    raw = counts.astype("<u4").tobytes()
    return {"part": part, "grp": group, "counts": pa.compress(raw, "zstd", asbytes=True)}


def _unpack(counts: bytes) -> np.ndarray:
    """How often each four bits followed, for the slots of a part."""
    raw = pa.decompress(counts, _PART * 4, "zstd", asbytes=True)
    return np.frombuffer(raw, "<u4").astype(np.int64)


def _sizes() -> list[int]:
    return [16 << b for b in SLOT_BITS]


def _add_counts(counts: np.ndarray, windows: np.ndarray, times: np.ndarray) -> None:
    """Adds to the counts of all tables the four bits of these sorted windows."""
    base = 0
    for order, entries in enumerate(_sizes()):
        # Windows that this order does not tell apart are counted once, with their sum.
        first = np.flatnonzero(_runs(windows, order))
        weights = np.add.reduceat(times, first) if len(first) else times
        own = counts[base : base + entries]
        for places in _entries(windows[first], order):
            np.add.at(own, places, weights.astype(counts.dtype))
        base += entries


def _count_contexts(docs: DataFrame) -> DataFrame:
    """Each task's bit counts, in parts of the tables that it touched."""

    def packed(group: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        parts = counts.reshape(-1, _PART)
        for part in np.flatnonzero(parts.any(axis=1)).tolist():
            yield pa.RecordBatch.from_pylist(
                [_pack(part, group % _GROUPS, parts[part])], schema=_COUNTS_ARROW
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = seen = 0
        counts = np.zeros(sum(_sizes()), np.uint32)
        for table in chunks(batches, "text"):
            whole, _ = _windows(table["text"])
            group ^= int(_byte(whole[: 1 << 16]).sum()) + len(whole)
            if seen and seen + len(whole) > _MOST:
                yield from packed(group, counts)
                seen = 0
                counts[:] = 0
            # Every different context and byte is handled once, with its frequency.
            _add_counts(counts, *np.unique(whole, return_counts=True))
            seen += len(whole)
        yield from packed(group, counts)

    return docs.select("text").mapInArrow(run, _COUNTS)


_COUNTS_ARROW = pa.schema([("part", pa.int32()), ("grp", pa.int32()), ("counts", pa.binary())])


def _sum_parts(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts summed by key, one row at a time in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if key != held:
                    if held is not None:
                        yield _summed(held, total)
                    held, total = key, np.zeros(_PART, np.int64)
                total += _unpack(row["counts"])
        if held is not None:
            yield _summed(held, total)

    def _summed(key: tuple, total: np.ndarray) -> pa.RecordBatch:
        clipped = np.minimum(total, 0xFFFFFFFF)
        return pa.RecordBatch.from_pylist([_pack(key[0], 0, clipped)], schema=_COUNTS_ARROW)

    return counts.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, _COUNTS)


def _stretched(counts: DataFrame) -> np.ndarray:
    """All tables as one array: the logits of the counted bits, in sixteenths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nibbles = _unpack(row["counts"]).reshape(_PART_SLOTS, 16)
                logit = np.zeros((_PART_SLOTS, 16))
                for bit in range(4):
                    # The nodes of a bit: what followed each value of the bits before it.
                    pair = nibbles.reshape(_PART_SLOTS, 1 << bit, 2, 8 >> bit).sum(axis=3) + 0.03
                    logit[:, 1 << bit : 2 << bit] = np.log(pair[:, :, 1] / pair[:, :, 0])
                logit = np.rint(logit.ravel() * _STRETCH_SCALE)
                small = np.clip(logit, -127, 127).astype(np.int8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]], pa.int32()), pa.array([small.tobytes()], pa.binary())],
                    ["part", "logits"],
                )

    out = np.zeros(sum(_sizes()), np.int8)
    for row in counts.mapInArrow(run, "part int, logits binary").toArrow().to_pylist():
        out[row["part"] * _PART : (row["part"] + 1) * _PART] = np.frombuffer(row["logits"], np.int8)
    return out


#: Bits of every byte, and the gate of each: the bits before it, after a leading one.
_BYTE_BITS = _bits(np.arange(256)).T
_BYTE_GATES = np.stack([(1 << b) + (np.arange(256) >> (8 - b)) for b in range(8)], axis=1)
#: Mixed logits are cut into so many levels within this range.
_LEVELS, _RANGE = 512, 12.0
_CENTERS = 1 / (1 + np.exp(-(np.arange(_LEVELS) / (_LEVELS - 1) * 2 - 1) * _RANGE))
#: Where the costs of a byte's bits begin, in a table by bit, gate and level: a row for each bit.
_BASE_INDEX = np.ascontiguousarray((_BYTE_BITS * 256 + _BYTE_GATES).T * _LEVELS, np.int32)


class Mixer:
    """Tables, gated weights and the last stage."""

    def __init__(self, tables: np.ndarray, weights: np.ndarray, last: np.ndarray):
        self.tables = tables
        self.weights = weights
        self.last = last
        self.errors = np.repeat(
            np.stack([-_CENTERS, 1 - _CENTERS])[:, None, :], 256, axis=1
        ).astype(np.float32).ravel()
        self.by_byte = _by_byte(weights)
        self.paths: list[np.ndarray] = []
        self.space = np.empty((5, 8, _CACHED), np.float32)
        self.index = np.empty((8, _CACHED), np.int64)
        self.base = np.empty((8, _CACHED), np.int32)
        step = _LEVELS // _BUCKETS
        refined = np.repeat(self.last[1] / self.last.sum(axis=0), step, axis=1)
        final = np.clip(0.5 * _CENTERS + 0.5 * refined, 1e-6, 1 - 1e-6)
        self.costs = -np.log2(np.stack([1 - final, final])).astype(np.float32).ravel()

    def __getstate__(self) -> dict:
        return {**self.__dict__, "paths": []}

    def _logits(self, windows: np.ndarray, order: int) -> np.ndarray:
        """A predictor's logits, in sixteenths, of the eight bits of each window's byte."""
        if not self.paths:
            # By slot and four bits, the logits of their nodes as one number.
            bounds = np.cumsum([0, *_sizes()])
            self.paths = [
                self.tables[a:b].reshape(-1, 16).take(_NODES.ravel(), axis=1).view("<u4").ravel()
                for a, b in zip(bounds, bounds[1:], strict=False)
            ]
        found = np.empty((len(windows), 2), "<u4")
        for half, places in enumerate(_entries(windows, order)):
            self.paths[order].take(places, out=found[:, half], mode="clip")
        return found.view(np.int8)

    def _distinct(self, windows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order the sorted windows that it tells apart, which each window is, their logits."""
        for order in range(len(ORDERS)):
            runs = _runs(windows, order)
            some = windows[runs]
            logits = np.empty((len(some), 8), np.int8)
            for a in range(0, len(some), _SCORE_BYTES):
                logits[a : a + _SCORE_BYTES] = self._logits(some[a : a + _SCORE_BYTES], order)
            yield some, np.cumsum(runs, dtype=np.int32) - 1, logits

    def _groups(self, windows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Sums of the weighted logits of short and of long contexts, which have a gain each.

        Of each group come the place of each window's sum, and the sums.
        """
        weights = np.ascontiguousarray(self.by_byte.transpose(1, 0, 2)) * np.float32(1 / _STRETCH_SCALE)
        groups = []
        for order, (some, places, logits) in enumerate(self._distinct(windows)):
            weighted = weights[order].take(_byte(some), axis=0)
            weighted *= logits
            if order not in (0, SHORT):
                last, total = groups.pop()
                weighted += total.take(last[np.flatnonzero(_runs(windows, order))], axis=0)
            groups.append((places, weighted))
        return groups

    def _separate(self, windows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """The logits of all predictors for each window, each predictor's eight as one number."""
        values = np.empty((len(windows), len(ORDERS)), "<i8")
        for order, (_, places, logits) in enumerate(self._distinct(windows)):
            values[:, order] = logits.view("<i8").ravel().take(places)
        return [(np.arange(len(windows), dtype=np.int32), values)]

    def run(self, column: pa.ChunkedArray, learn: str = "") -> tuple[np.ndarray, np.ndarray]:
        """Total bits of each text, and its bytes with the end.

        ``learn`` is what is trained meanwhile: ``weights``, ``last`` or nothing.
        """
        whole, sizes = _windows(column)
        # What the tables say depends on a window of bytes alone: each is looked up once.
        codes, windows = _coded(whole)
        rows = self._separate(windows) if learn == "weights" else self._groups(windows)
        order, pieces, names, calls = _by_block(sizes)
        byte = (whole >> np.uint64(56)).astype(np.uint8).take(order)
        codes = codes.take(order)
        total = np.zeros(len(sizes))
        gains = np.ones((2, len(sizes)), np.float32)
        # Blocks of equal number are mixed together; those of one text follow each other.
        firsts = np.searchsorted(pieces, calls).tolist()
        for low, high, i, j in zip(calls, calls[1:], firsts, firsts[1:], strict=False):
            self._mix(
                rows, codes[low:high], byte[low:high], pieces[i:j] - low, names[i:j],
                gains, total, learn,
            )
        return total, sizes

    def _mix(
        self,
        rows: list[tuple[np.ndarray, np.ndarray]],
        codes: np.ndarray,
        byte: np.ndarray,
        new: np.ndarray,
        names: np.ndarray,
        gains: np.ndarray,
        total: np.ndarray,
        learn: str,
    ) -> None:
        """``new`` says where the bytes of each text in ``names`` begin."""
        lengths = np.diff(np.append(new, len(byte)))
        own = [np.repeat(g[names], lengths) for g in gains]
        if learn == "weights":
            # Gradients are sums by byte: equal ones come together.
            ordered = np.argsort(byte, kind="stable")
            codes, byte, *own = (x.take(ordered) for x in (codes, byte, *own))
        byte = byte.astype(np.int64)
        cost = np.empty(len(byte), np.float32)
        steps = np.empty((2, len(byte)), np.float32)
        gradients = np.zeros((len(ORDERS), 8, 256))
        if learn == "last":
            observed = np.zeros(self.last.size, np.int64)
        elif learn == "weights":
            by_order = np.ascontiguousarray(self.by_byte.transpose(1, 2, 0))
        for a in range(0, len(byte), _CACHED):
            part = slice(a, a + _CACHED)
            some = byte[part]
            # A row for each bit. Results go to the same arrays: new ones would be new memory each time.
            short, long, mixed, other, error = self.space[:, :, : len(some)]
            place, base = self.index[:, : len(some)], self.base[:, : len(some)]
            found = [
                values.take(codes[part] if len(places) == len(values) else places.take(codes[part]), axis=0)
                for places, values in rows
            ]
            if learn == "weights":
                logits = np.multiply(
                    found[0].view(np.int8).T, np.float32(1 / _STRETCH_SCALE), order="C"
                ).reshape(len(ORDERS), 8, -1)
                weighted = by_order.take(some, axis=2)
                weighted *= logits
                short[:] = sum(weighted[1:SHORT], weighted[0])
                long[:] = sum(weighted[SHORT + 1 :], weighted[SHORT])
            else:
                short[:], long[:] = found[0].T, found[1].T
            np.multiply(short, own[0][part], out=mixed)
            np.multiply(long, own[1][part], out=other)
            mixed += other
            mixed *= (_LEVELS - 1) / (2 * _RANGE)
            mixed += _LEVELS / 2
            np.clip(mixed, 0, _LEVELS - 1, out=mixed)
            # The mode spares a pass that looks for places outside.
            _BASE_INDEX.take(some, axis=1, out=base, mode="clip")
            base += mixed.astype(np.int32)
            place[:] = base
            self.costs.take(place, out=mixed, mode="clip")
            cost[part] = _added(mixed[0::2] + mixed[1::2])
            self.errors.take(place, out=error, mode="clip")
            for group, values in enumerate((short, long)):
                np.multiply(values, error, out=other)
                steps[group, part] = _added(other[:4] + other[4:])
            if learn == "weights":
                logits *= error
                first = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
                gradients[:, :, some[first]] += np.add.reduceat(logits, first, axis=2, dtype=np.float64)
            elif learn == "last":
                observed += np.bincount((base // (_LEVELS // _BUCKETS)).ravel(), minlength=self.last.size)
        if learn == "weights":
            for values in (cost, *steps):
                values[ordered] = values.copy()
        total[names] += np.add.reduceat(cost, new, dtype=np.float64)
        for group in (0, 1):
            step = np.add.reduceat(steps[group], new)
            gains[group, names] += (GAIN_RATE * step / (lengths * 8.0 + 256)).astype(np.float32)
        np.clip(gains, 0.2, 3, out=gains)
        if learn == "weights":
            seen = np.bincount(_BYTE_GATES.ravel(), np.bincount(byte, minlength=256).repeat(8), 256)
            for k in range(len(ORDERS)):
                gradient = np.bincount(_BYTE_GATES.T.ravel(), gradients[k].ravel(), 256)
                self.weights[k] += (WEIGHT_RATE * gradient / (seen + 64)).astype(np.float32)
            self.by_byte = _by_byte(self.weights)
        elif learn == "last":
            self.last += observed.reshape(self.last.shape)


def _added(four: np.ndarray) -> np.ndarray:
    two = four[0::2] + four[1::2]
    return two[0] + two[1]


def _by_block(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The places of all bytes of texts of these sizes, by number of block, then as they come.

    They are mixed in calls of one number of block and ``_SCORE_BYTES`` at most. Then come where
    each piece of one text and one call begins, its text, and where calls begin, with the end.
    """
    blocks = -(-sizes // BLOCK)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), blocks)
    number = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    start = np.repeat(ends - sizes, blocks) + number * BLOCK
    length = np.minimum(np.repeat(ends, blocks) - start, BLOCK)
    order = np.argsort(number, kind="stable")
    text, number, start, length = (x.take(order) for x in (text, number, start, length))
    begin = np.cumsum(length) - length
    places = np.repeat(start - begin, length)
    places += np.arange(len(places))
    first = np.flatnonzero(np.append(True, number[1:] != number[:-1])[: len(number)])
    bounds = [*begin[first].tolist(), len(places)]
    calls = [a for x, y in zip(bounds, bounds[1:], strict=False) for a in range(x, y, _SCORE_BYTES)]
    pieces = np.union1d(begin, calls).astype(np.int64)
    names = text[np.searchsorted(begin, pieces, side="right") - 1]
    return places, pieces, names, [*calls, len(places)]


def _coded(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each window's place among the distinct ones, and these in order.

    They are sorted twice with their place in the lowest bits: by the five highest bytes, then
    by the place of these five among all and the two bytes left. The lowest byte is not used.
    """
    bits = np.uint64(max(len(values) - 1, 1).bit_length())
    if bits > 24:
        distinct, codes = np.unique(values, return_inverse=True)
        return codes.astype(np.int32), distinct
    keys = values >> np.uint64(24) << bits
    keys |= np.arange(len(values), dtype=np.uint64)
    keys.sort()
    at = (keys & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    rest = (values >> np.uint64(8)).astype(np.uint16).take(at)
    keys >>= bits
    ranks = np.cumsum(np.append(True, keys[1:] != keys[:-1])[: len(keys)], dtype=np.uint64)
    ranks <<= np.uint64(16)
    ranks |= rest
    ranks <<= bits
    ranks |= at.view(np.uint64)
    ranks.sort()
    at = (ranks & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)
    ranks >>= bits
    new = np.append(True, ranks[1:] != ranks[:-1])[: len(ranks)]
    codes = np.empty(len(values), np.int32)
    codes[at] = np.cumsum(new, dtype=np.int32) - np.int32(1)
    return codes, values.take(at[new])


def _by_byte(weights: np.ndarray) -> np.ndarray:
    """The weights of each byte's bits: byte, predictor, bit."""
    return np.ascontiguousarray(weights[:, _BYTE_GATES].transpose(1, 0, 2))


def _fresh() -> tuple[np.ndarray, np.ndarray]:
    """Weights before training, and a last stage that changes nothing."""
    weights = np.full((len(ORDERS), 256), 0.3, np.float32)
    centers = _CENTERS.reshape(_BUCKETS, -1).mean(axis=1)
    last = np.stack([np.tile(1 - centers, (256, 1)), np.tile(centers, (256, 1))]) * 8
    return weights, last


def train_mixer(counted: DataFrame, mixed: DataFrame, scratch: Scratch) -> Mixer:
    """Tables from the texts of ``counted``; weights and last stage from those of ``mixed``.

    Each task trains weights of its own on the texts it reads, which are averaged by the bytes
    they have seen. With these weights a second pass adds up what the last stage observes.
    """
    sums = _sum_parts(_sum_parts(_count_contexts(counted), "part", "grp"), "part")
    stored, _ = scratch.write(sums)
    tables = _stretched(stored)
    spark = counted.sparkSession
    shared = spark.sparkContext.broadcast(tables)
    weights, last = _fresh()

    def train(learn: str, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            mixer = Mixer(shared.value, weights.copy(), _fresh()[1])
            seen = 0
            for table in chunks(batches, "text", _MIX_BYTES):
                seen += int(mixer.run(table["text"], learn)[1].sum())
            if seen:
                value = mixer.weights * seen if learn == "weights" else mixer.last - _fresh()[1]
                yield pa.RecordBatch.from_pydict(
                    {"place": np.arange(size), "value": value.ravel().astype(float), "seen": np.full(size, seen)}
                )

        found = (
            mixed.select("text").mapInArrow(run, "place long, value double, seen long")
            .groupBy("place").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")).toArrow()
        )
        value, seen = np.zeros(size), np.zeros(size)
        value[found["place"].to_numpy()] = found["value"].to_numpy()
        seen[found["place"].to_numpy()] = found["seen"].to_numpy()
        return value, seen

    value, seen = train("weights", weights, weights.size)
    if seen.any():
        weights = (value / seen).reshape(weights.shape).astype(np.float32)
    value, _ = train("last", weights, last.size)
    return Mixer(tables, weights, last + value.reshape(last.shape))


def mixer_scores(docs: DataFrame, mixer: Mixer, keys: list[str]) -> DataFrame:
    """``keys``, ``bits`` (the total cost of the text) and ``n_bytes`` with the end."""
    shared = docs.sparkSession.sparkContext.broadcast((mixer.tables, mixer.weights, mixer.last))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Mixer(*shared.value)
        for table in chunks(batches, "text", _MIX_BYTES):
            bits, sizes = own.run(table["text"])
            yield pa.RecordBatch.from_arrays(
                [*[table[k].combine_chunks() for k in keys], pa.array(bits), pa.array(sizes)],
                [*keys, "bits", "n_bytes"],
            )

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.select(*keys).schema)
    return docs.select(*keys, "text").mapInArrow(run, f"{fields}, bits double, n_bytes long")


# -- the base: smoothed token counts ----------------------------------------------------------

#: The end of a text; no word holds a space.
_END_TOKEN = " "
#: Hot tokens hold more than 1 / (8 * buckets) of all tokens, so there are fewer than 8 * buckets.
_HOT = 8


def _tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.LargeStringArray, np.ndarray]:
    """Codes of the words of all texts, the distinct words, and where each text's begin."""
    data, offsets = flat_text(column)
    words = split_words(_LOWER.take(data), offsets)
    codes, distinct = _coded_words(words)
    return codes, distinct, words.first


def _coded_words(words: Words) -> tuple[np.ndarray, pa.LargeStringArray]:
    """``Words.coded``; words of seven bytes and less are told apart as numbers, with their length."""
    lengths = words.ends - words.starts
    is_short = lengths < 8
    padded = np.append(words.data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(words.data) + 1, "<u8", padded, strides=(1,))
    size = lengths[is_short]
    keys = eight[words.starts[is_short]] & _FIRST_BYTES.take(size)
    keys |= size.astype(np.uint64) << np.uint64(56)
    short = pa.array(keys).dictionary_encode()
    keys = short.dictionary.to_numpy()
    size = (keys >> np.uint64(56)).astype(np.int64)
    letters = keys.view(np.uint8).reshape(-1, 8)[np.arange(8) < size[:, None]]
    starts, size_long = words.starts[~is_short], lengths[~is_short]
    places = np.repeat(starts - np.cumsum(size_long) + size_long, size_long)
    places += np.arange(len(places))
    long = _strings(size_long, words.data.take(places)).dictionary_encode()
    codes = np.empty(len(lengths), np.int32)
    codes[is_short] = short.indices.to_numpy()
    codes[~is_short] = long.indices.to_numpy() + np.int32(len(keys))
    return codes, pa.concat_arrays([_strings(size, letters), long.dictionary])


#: Which bits hold so many bytes.
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)], np.uint64)


def _strings(sizes: np.ndarray, letters: np.ndarray) -> pa.LargeStringArray:
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    return pa.LargeStringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))
    )


def _bucket(tokens: pa.LargeStringArray, buckets: int) -> np.ndarray:
    """A bucket by all bytes of each token."""
    data, offsets = flat_text(tokens)
    lengths = np.diff(offsets)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], lengths)
    letters = mix((place.astype(np.uint64) << np.uint64(8)) + data + np.uint64(1))
    sums = np.add.reduceat(letters, offsets[:-1]) if len(lengths) else letters
    return (mix(sums) % np.uint64(buckets)).astype(np.int32)


def token_counts(docs: DataFrame, buckets: int) -> DataFrame:
    """``bucket, token, c`` of all tokens, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            codes, distinct, _ = _tokens(table["text"])
            tokens = pa.concat_arrays([distinct, pa.array([_END_TOKEN], pa.large_string())])
            counts = np.append(np.bincount(codes, minlength=len(distinct)), table.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_bucket(tokens, buckets)), tokens.cast(pa.string()), pa.array(counts)],
                ["bucket", "token", "c"],
            )

    return (
        docs.select("text").mapInArrow(run, "bucket int, token string, c long")
        .groupBy("bucket", "token").agg(F.sum("c").alias("c"))
    )


def _bucket_sums(
    docs: DataFrame, counts: DataFrame, hot: dict[str, int], keys: list[str], partitions: int, buckets: int
) -> DataFrame:
    """``bucket, chunk, entries``: a row for each chunk of texts, and one for each bucket it needs.

    The first holds keys, sizes and sums of hot tokens of the chunk's rows, the others what the
    bucket's counts add to them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)
    k1, k2 = keys

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        names = pa.array([*known], pa.large_string())
        hot_counts = np.array([*known.values(), -1], np.int64)
        chunk = TaskContext.get().partitionId() << 32
        for table in chunks(batches, "text"):
            chunk += 1
            codes, distinct, first = _tokens(table["text"])
            rows = np.repeat(np.arange(table.num_rows), np.diff(first))
            c = hot_counts[pc.fill_null(pc.index_in(distinct, names), -1).to_numpy(zero_copy_only=False)]
            end = known.get(_END_TOKEN, 0)
            is_hot = (c >= 0).take(codes)
            hot_rows, logs = rows[is_hot], np.log10(np.maximum(c, 0) + 0.1)
            weight = np.bincount(hot_rows, logs.take(codes[is_hot]), table.num_rows) + math.log10(end + 0.1)
            seen = np.bincount(hot_rows, minlength=table.num_rows) + (end > 0)
            keys1, keys2 = (table[k].combine_chunks().to_numpy() for k in (k1, k2))
            whole = _squeeze(
                keys1.astype("<i8").tobytes(), keys2.astype("<i8").tobytes(),
                (np.diff(first) + 1).astype("<i8").tobytes(), seen.astype("<i8").tobytes(),
                weight.astype("<f8").tobytes(),
            )
            # The other tokens go to their buckets with the numbers of the rows that hold them.
            bucket = _bucket(distinct, buckets)
            order = np.argsort(bucket, kind="stable")
            ranks = np.empty(len(order), np.int64)
            ranks[order] = np.arange(len(order))
            pair = ranks.take(codes[~is_hot]) << 32 | rows[~is_hot]
            pair, times = np.unique(pair, return_counts=True)
            code, row = pair >> 32, pair & 0xFFFFFFFF
            new = np.append(True, code[1:] != code[:-1])[: len(code)]
            words = distinct.take(pa.array(order)).to_numpy(zero_copy_only=False)
            numbers, begin = np.unique(bucket.take(order).take(code), return_index=True)
            packed = [whole]
            for a, b in zip(begin, [*begin[1:], len(code)], strict=False):
                local = np.cumsum(new[a:b]) - 1
                packed.append(
                    _squeeze(
                        "\n".join(words[code[a:b][new[a:b]]]).encode(),
                        local.astype("<u4").tobytes(), row[a:b].astype("<u4").tobytes(),
                        times[a:b].astype("<u4").tobytes(),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(_WHOLE, numbers).astype(np.int32)),
                    pa.array(np.append(chunk % buckets, numbers).astype(np.int32)),
                    pa.array(np.full(len(packed), chunk)),
                    pa.array(packed, pa.binary()),
                ],
                ["bucket", "part", "chunk", "entries"],
            )

    # A bucket's counts come first, one row, then its tokens.
    in_bucket = counts.groupBy("bucket").agg(
        F.collect_list(F.struct("token", "c")).alias("known")
    )
    entries = docs.select(*keys, "text").mapInArrow(read, "bucket int, part int, chunk long, entries binary")
    both = entries.withColumn("known", F.lit(None).cast("array<struct<token:string,c:long>>")).unionByName(
        in_bucket.select("bucket", F.col("bucket").alias("part"), "known"), allowMissingColumns=True
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, {}
        for batch in batches:
            for i, number in enumerate(batch.column("bucket").to_pylist()):
                if number != held:
                    held, known = number, {}
                if batch.column("known")[i].is_valid:
                    rows = batch.column("known")[i].values
                    known = dict(zip(*(rows.field(f).to_numpy(zero_copy_only=False).tolist() for f in ("token", "c"))))
                    continue
                body = batch.column("entries")[i].as_py()
                if number != _WHOLE:
                    tokens, local, row, times = _expand(body, 4)
                    c = np.array([known.get(t, 0) for t in tokens.decode().split("\n")], np.int64)
                    local, row, times = (np.frombuffer(x, "<u4") for x in (local, row, times))
                    rows, place = np.unique(row, return_inverse=True)
                    body = _squeeze(
                        rows.tobytes(),
                        np.bincount(place, times * (c[local] > 0), len(rows)).astype("<i8").tobytes(),
                        np.bincount(place, times * np.log10(c + 0.1)[local], len(rows)).astype("<f8").tobytes(),
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int32()), batch.column("chunk").slice(i, 1), pa.array([body], pa.binary())],
                    ["bucket", "chunk", "entries"],
                )

    return (
        both.repartition(partitions, "part")
        .sortWithinPartitions("bucket", F.col("known").isNull())
        .select("bucket", "chunk", "entries", "known")
        .mapInArrow(meet, "bucket int, chunk long, entries binary")
    )


def base_scores(docs: DataFrame, training: DataFrame, keys: list[str], scratch: Scratch) -> DataFrame:
    """``keys, n_tokens, n_known, train_tokens, base_score`` of each row of ``docs``.

    ``keys`` name the rows; rows with equal keys must have equal texts, and count as one.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * partitions
    counts, found = scratch.write(
        token_counts(training, buckets), {"n": F.sum("c"), "v": F.count("*")}
    )
    n, v = found["n"] or 0, found["v"] or 0
    norm = math.log10(n + 0.1 * (v + 1))
    hot_rows = counts.filter(
        (F.col("c") > n / (_HOT * buckets)) | (F.col("token") == _END_TOKEN)
    ).select("token", "c").toArrow()
    hot = dict(zip(hot_rows["token"].to_pylist(), hot_rows["c"].to_pylist(), strict=True))
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of each chunk, which come first, with the sums of all its buckets."""
        whole: list[np.ndarray] = []
        for batch in batches:
            for number, body in zip(batch.column("bucket").to_pylist(), batch.column("entries"), strict=True):
                if number == _WHOLE:
                    if whole:
                        yield _base_rows(whole)
                    parts = _expand(body.as_py(), 5)
                    whole = [np.frombuffer(x, t).copy() for x, t in zip(parts, ("<i8",) * 4 + ("<f8",), strict=True)]
                else:
                    rows, seen, weight = _expand(body.as_py(), 3)
                    rows = np.frombuffer(rows, "<u4")
                    whole[3][rows] += np.frombuffer(seen, "<i8")
                    whole[4][rows] += np.frombuffer(weight, "<f8")
        if whole:
            yield _base_rows(whole)

    sums = (
        _bucket_sums(docs, counts, hot, keys, partitions, buckets)
        .repartition(partitions, "chunk")
        .sortWithinPartitions("chunk", "bucket")
        .mapInArrow(add, "k1 long, k2 long, n_tokens long, n_known long, weight double")
        .groupBy("k1", "k2")
        .agg(*[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "weight")], F.count("*").alias("rows"))
    )
    # Rows with equal keys have added up: each gets its share.
    k1, k2 = keys
    return sums.select(
        F.col("k1").alias(k1),
        F.col("k2").alias(k2),
        *[(F.col(c) / F.col("rows")).cast("long").alias(c) for c in ("n_tokens", "n_known")],
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("weight") / F.col("rows")).alias("weight"),
    ).withColumn("base_score", F.col("weight") - F.col("n_tokens") * F.lit(norm)).drop("weight")


#: In place of a bucket: what a chunk's own rows say.
_WHOLE = -1


def _base_rows(columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c) for c in columns], ["k1", "k2", "n_tokens", "n_known", "weight"]
    )


def _squeeze(*parts: bytes) -> bytes:
    sizes = np.array([len(p) for p in parts], "<u8").tobytes()
    raw = b"".join(parts)
    return sizes + pa.compress(raw, "zstd", asbytes=True)


def _expand(packed: bytes, parts: int) -> list[bytes]:
    sizes = np.frombuffer(packed[: 8 * parts], "<u8").tolist()
    raw = pa.decompress(packed[8 * parts :], sum(sizes), "zstd", asbytes=True)
    ends = np.cumsum(sizes).tolist()
    return [raw[e - s : e] for s, e in zip(sizes, ends, strict=True)]


def score_documents(docs: DataFrame, held_out: Column, mix_fold: Column) -> DataFrame:
    """All rows scored: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    (log10 probability), ``n_bytes`` and ``bits_per_byte``.

    The model learns from rows that are not ``held_out``; those of ``mix_fold`` train the mixer.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        "doc_id",
        "text",
        held_out.alias("held_out"),
        mix_fold.alias("_mix"),
        F.xxhash64("doc_id", "text").alias("k1"),
        F.xxhash64(F.lit("second"), "text", "doc_id").alias("k2"),
    )
    training = rows.filter("not held_out")
    mixer = train_mixer(training.filter("not _mix"), training.filter("_mix"), scratch)
    base = base_scores(rows, training, ["k1", "k2"], scratch)
    scores = mixer_scores(rows, mixer, ["doc_id", "held_out", "k1", "k2"])
    return scores.join(base, ["k1", "k2"]).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        (F.col("bits") * F.lit(-math.log10(2))).alias("score"),
        "n_bytes",
        (F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )
