"""Text columns as flat numpy buffers inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Text that a task holds at a time, whatever the size of its partition.
CHUNK_BYTES = 4 << 20

#: The bytes \x20 and \x09-\x0D, which separate words.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def chunks(
    batches: Iterator[pa.RecordBatch], column: str, size: int = CHUNK_BYTES
) -> Iterator[pa.Table]:
    """Rows regrouped so that ``column`` has about ``size`` bytes; a row is never cut."""
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = int(np.searchsorted(ends, before + size - held_bytes, side="right"))
            stop = min(max(stop, start + (not held)), batch.num_rows)
            if stop > start:
                held.append(batch.slice(start, stop - start))
                held_bytes += int(ends[stop - 1]) - before
            if stop < batch.num_rows or held_bytes >= size:
                yield pa.Table.from_batches(held)
                held, held_bytes = [], 0
            start = stop
    if held:
        yield pa.Table.from_batches(held)
    del held
    _give_back()


def _give_back() -> None:
    """Python workers go on to other tasks: what this one has freed goes back to the system.

    The C library keeps freed memory of small objects; where it can, it is asked to let go.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def flat_text(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and their offsets; null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks) if array.num_chunks else pa.array([], pa.large_string())
    array = pc.fill_null(array.cast(pa.large_string()), "")
    buffers = array.buffers()
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(buffers[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


@dataclass(frozen=True)
class Words:
    """The words of some texts. ``first[i]:first[i + 1]`` are those of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def encode(self) -> tuple[np.ndarray, list[str]]:
        """A code for each word, and the word of each code; equal words have equal codes."""
        codes, words = self.coded()
        return codes, words.to_numpy(zero_copy_only=False).tolist()

    def coded(self) -> tuple[np.ndarray, pa.LargeStringArray]:
        """``encode`` with the words in an Arrow array."""
        lengths = self.ends - self.starts
        offsets = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=offsets[1:])
        letters = self.data[~IS_SPACE[self.data]]
        words = pa.LargeStringArray.from_buffers(
            len(lengths), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(letters))
        )
        found = words.dictionary_encode()
        return found.indices.to_numpy(zero_copy_only=False), found.dictionary


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text, as byte ranges."""
    space = IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[1:] = space[:-1]
    after = np.empty(len(data), bool)
    after[:-1] = space[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    if len(data):
        before[0] = after[-1] = True
        before[edges] = True
        after[edges - 1] = True
    starts = np.flatnonzero(~space & before)
    ends = np.flatnonzero(~space & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def hash_words(words: list[str], seed: int = 0) -> np.ndarray:
    """XXH64 of each word's UTF-8 bytes."""
    return np.fromiter(
        (xxhash.xxh64_intdigest(w.encode(), seed) for w in words), np.uint64, count=len(words)
    )


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (MurmurHash3's finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h
