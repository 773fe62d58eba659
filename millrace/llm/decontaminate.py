"""Benchmark decontamination by spaced seeds.

Tokens are words in lower case, reduced to letters and digits; words without any are left
out. A mask takes some tokens of ``SPAN`` consecutive ones and ignores the others, so texts
that differ in ignored tokens have equal hashes. The hashes of the benchmark fill a Bloom
filter of a bounded size; only hashes of documents that pass it are joined with those of the
benchmark. Around each hit the document and the item are laid side by side, and the overlap
counts if in some window of ``window`` aligned tokens (the whole item, if it is shorter) at
least ``agreement`` of them are equal.

Items shorter than the longest mask have masks of their own, whose hashes are looked for only
if there are such items.

Defined results: null texts count as empty; items with fewer than ``LEAST_TOKENS`` tokens match
nothing; ids are whole numbers; documents with one doc_id count as one, with the best overlap of any; a
null doc_id or item_id is an ordinary value; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrow import CHUNK_BYTES, chunks, flat_text, hash_words, mix, split_words
from millrace.llm.bloom import Bloom, build_bloom
from millrace.llm.names import fresh
from millrace.session import Scratch

#: In 10 to 20 aligned tokens any substitutions that an overlap may have leave some place of
#: some mask whole (tests/llm tries them all), so every overlap that counts has a hit.
MASKS = ("11111", "1101011", "110010011", "1010010101", "1110000111")
SPAN = max(map(len, MASKS))
#: Masks of items with fewer than ``SPAN`` tokens, by the numbers of tokens they serve.
SHORT_MASKS = {
    "111": (3, 3),
    "1111": (4, SPAN - 1),
    "10111": (5, SPAN - 1),
    "11011": (5, SPAN - 1),
    "11101": (5, SPAN - 1),
}
#: Items with fewer tokens match nothing: any text has their words.
LEAST_TOKENS = 3
_LENGTHS = {**{mask: (SPAN, None) for mask in MASKS}, **SHORT_MASKS}
WINDOW = 20
AGREEMENT = 0.8


def _tokens(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the normalised tokens of all rows, and where each row's begin."""
    words = split_words(*flat_text(table["text"]))
    codes, distinct = words.encode()
    plain = ["".join(filter(str.isalnum, w.lower())) for w in distinct]
    some = np.array([bool(p) for p in plain], bool)[codes] if len(codes) else np.zeros(0, bool)
    hashes = hash_words(plain)[codes[some]]
    before = np.concatenate([[0], np.cumsum(some)])
    return hashes, before[words.first]


def _seeds(
    tokens: np.ndarray, first: np.ndarray, masks: Sequence[str]
) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """For each mask the hashes of all places within one row, and the places."""
    row_end = np.repeat(first[1:], np.diff(first))
    numbers = list(_LENGTHS)
    for mask in masks:
        number = numbers.index(mask)
        n = len(tokens) - len(mask) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(np.arange(n) + len(mask) <= row_end[:n])
        value = np.full(len(at), number + 1, np.uint64)
        for j in (j for j, c in enumerate(mask) if c == "1"):
            value = mix(value ^ tokens[at + j])
        yield mask, value, at


def _test_seeds(benchmark: DataFrame) -> DataFrame:
    """``mask, seed, item_key, place`` for every place of every mask that serves the item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", CHUNK_BYTES // 2):
            tokens, first = _tokens(table)
            for mask, value, at in _seeds(tokens, first, list(_LENGTHS)):
                row = np.searchsorted(first, at, side="right") - 1
                least, most = _LENGTHS[mask]
                length = np.diff(first)[row]
                served = (length >= least) & (length <= (most or length.max(initial=0)))
                at, row, value = at[served], row[served], value[served]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([mask] * len(at), pa.string()),
                        pa.array(value.view(np.int64)),
                        table["item_key"].combine_chunks().take(pa.array(row)),
                        pa.array((at - first[row]).astype(np.int32)),
                    ],
                    ["mask", "seed", "item_key", "place"],
                )

    return benchmark.select("item_key", "text").mapInArrow(
        run, "mask string, seed long, item_key long, place int"
    )


def _item_tokens(benchmark: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text", CHUNK_BYTES // 2):
            tokens, first = _tokens(table)
            yield pa.RecordBatch.from_arrays(
                [
                    table["item_id"].combine_chunks(),
                    table["item_key"].combine_chunks(),
                    pa.ListArray.from_arrays(
                        pa.array(first.astype(np.int32)), pa.array(tokens.view(np.int64))
                    ),
                ],
                ["item_id", "item_key", "item"],
            )

    return benchmark.select("item_id", "item_key", "text").mapInArrow(
        run, "item_id long, item_key long, item array<long>"
    )


_REGIONS = "doc_id long, start long, region array<long>, hits array<struct<seed:long,place:int>>"


def _regions(documents: DataFrame, bloom: Bloom, reach: int, masks: Sequence[str]) -> DataFrame:
    """Stretches of documents around seeds that pass the filter, with these seeds."""
    shared = documents.sparkSession.sparkContext.broadcast((bloom.words, bloom.bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Bloom(*shared.value)
        for table in chunks(batches, "text", CHUNK_BYTES // 2):
            tokens, first = _tokens(table)
            seeds, places = [], []
            for _, value, at in _seeds(tokens, first, masks):
                hit = known.find(value)
                seeds.append(value[hit])
                places.append(at[hit])
            if not sum(map(len, places)):
                continue
            seed, at = np.concatenate(seeds), np.concatenate(places)
            order = np.argsort(at, kind="stable")
            seed, at = seed[order], at[order]
            row = np.searchsorted(first, at, side="right") - 1
            # Hits whose surroundings overlap share a region.
            new = np.ones(len(at), bool)
            new[1:] = (row[1:] != row[:-1]) | (at[1:] - at[:-1] > 2 * reach)
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(at))
            low = np.maximum(at[begin] - reach, first[row[begin]])
            high = np.minimum(at[end - 1] + SPAN + reach, first[row[begin] + 1])
            lengths = high - low
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            taken = np.repeat(low - offsets[:-1], lengths) + np.arange(offsets[-1])
            group = np.cumsum(new) - 1
            yield pa.RecordBatch.from_arrays(
                [
                    table["doc_id"].combine_chunks().take(pa.array(row[begin])),
                    pa.array(low - first[row[begin]]),
                    pa.ListArray.from_arrays(
                        pa.array(offsets.astype(np.int32)), pa.array(tokens[taken].view(np.int64))
                    ),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(begin, len(at)).astype(np.int32)),
                        pa.StructArray.from_arrays(
                            [pa.array(seed.view(np.int64)), pa.array((at - low[group]).astype(np.int32))],
                            ["seed", "place"],
                        ),
                    ),
                ],
                ["doc_id", "start", "region", "hits"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, _REGIONS)


def best_overlap(
    region: np.ndarray, item: np.ndarray, diagonal: int, window: int
) -> tuple[int, int]:
    """Most equal tokens in a window of the item laid at ``diagonal``, and the window's size."""
    equal = np.zeros(len(item), np.int64)
    a, b = max(0, -diagonal), min(len(item), len(region) - diagonal)
    if b > a:
        equal[a:b] = region[a + diagonal : b + diagonal] == item[a:b]
    size = min(window, len(item))
    sums = np.concatenate([[0], np.cumsum(equal)])
    return int((sums[size:] - sums[:-size]).max()), size


def find_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    agreement: float = AGREEMENT,
) -> DataFrame:
    """``doc_id, item_id, n_equal, n_window, doc_token``: documents that hold a part of an item.

    One row per pair, with its best overlap: ``n_equal`` of ``n_window`` aligned tokens are
    equal, in a window that begins at token ``doc_token`` of the document at the earliest.
    """
    spark: SparkSession = documents.sparkSession
    scratch = Scratch(spark)
    keyed = benchmark.select(
        "item_id", "text", F.xxhash64("item_id", "text").alias("item_key")
    ).distinct()
    items, _ = scratch.write(_item_tokens(keyed))
    seeds, found = scratch.write(_test_seeds(keyed), {"n": F.count("*")})
    bloom = build_bloom(seeds.select("seed").distinct(), found["n"])
    # A window that holds a hit reaches at most so far to either side of it.
    used = {r["mask"] for r in seeds.select("mask").distinct().collect()}
    masks = [m for m in _LENGTHS if m in MASKS or m in used]
    regions, _ = scratch.write(
        _regions(documents, bloom, window, masks).withColumn("id", F.monotonically_increasing_id())
    )
    # A seed of a passage in many documents is one row of the benchmark's side.
    candidates = (
        regions.select("id", F.explode("hits").alias("h"))
        .select("id", "h.seed", F.col("h.place").alias("at"))
        .join(seeds.drop("mask"), "seed")
        .select("id", "item_key", (F.col("at") - F.col("place")).alias("diagonal"))
        .distinct()
        .groupBy("id", "item_key")
        .agg(F.collect_list("diagonal").alias("diagonals"))
    )
    pairs = candidates.join(items, "item_key").join(regions.drop("hits"), "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                region, item = np.array(r["region"], np.int64), np.array(r["item"], np.int64)
                overlaps = [(*best_overlap(region, item, d, window), -d) for d in r["diagonals"]]
                equal, size, shift = max(overlaps)
                if equal >= math.ceil(agreement * size - 1e-9):
                    rows.append(
                        {
                            "doc_id": r["doc_id"],
                            "item_id": r["item_id"],
                            "n_equal": equal,
                            "n_window": size,
                            "doc_token": max(0, r["start"] - shift),
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

    verified = pairs.select("doc_id", "item_id", "start", "region", "item", "diagonals").mapInArrow(
        verify, "doc_id long, item_id long, n_equal long, n_window long, doc_token long"
    )
    best = F.max(F.struct("n_equal", "n_window", (-F.col("doc_token")).alias("t")))
    return (
        verified.groupBy("doc_id", "item_id")
        .agg(best.alias("b"))
        .select("doc_id", "item_id", "b.n_equal", "b.n_window", (-F.col("b.t")).alias("doc_token"))
    )


_FOUND = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "item_id", "n_equal", "n_window", "doc_token")]
)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, **options: object) -> DataFrame:
    """The documents that hold no part of an item; all columns stay."""
    (found_id,) = fresh(documents.columns, "_found_id")
    found = find_contamination(documents, benchmark, **options).select(F.col("doc_id").alias(found_id))
    return documents.join(found.distinct(), F.col("doc_id").eqNullSafe(F.col(found_id)), "left_anti")
