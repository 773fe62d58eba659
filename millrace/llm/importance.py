"""Importance resampling towards a target: hashed n-gram features, gains, Gumbel top-k.

A feature is a run of 1 to ``max_run`` consecutive words, its bucket the unsigned CRC32 of its
UTF-8 bytes modulo ``buckets``. Features of the pool and of the target are counted per bucket;
a bucket's gain is the floored thousandfold logarithm of its smoothed share in the target over
that in the pool. A document's weight is the floored mean gain of its features, its score the
weight plus Gumbel noise that depends on ``seed`` and its id alone, so that the highest scores
are a draw without replacement whose chances follow the weights.

Inside tasks everything is Arrow and numpy over chunks of whole texts: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` give the words as dictionary
indices; indices shifted by a word form the runs; CRCs are computed once for each distinct pair
of a run and the word after it; gains are gathered with ``take`` and summed over the segments
of the documents. Tasks send at most a count per bucket. The pool is read twice and no text is
shuffled; only ids, weights and scores are, to number the draw by a sort over all tasks.

Defined results: a null text has no features; a text without words has weight 0; rows that
share an id are rows of their own with equal noise; a null id counts as the empty text in the
noise and sorts first; ties of score go to the smaller id; an empty pool gives no rows, an
empty target gains from the smoothing alone; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrow import chunks, flat_text
from millrace.operators.ids import assign_ids
from millrace.session import Scratch

#: Bytes that end a word, after lower-casing: all ASCII but digits and small letters.
_BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Features:
    """Buckets of the features of some texts; ``first[i]:first[i + 1]`` are those of text i."""

    buckets: np.ndarray
    first: np.ndarray
    words: np.ndarray


def text_features(texts: pa.ChunkedArray | pa.Array, max_run: int, buckets: int) -> Features:
    """The buckets of all features of each text, and its number of words."""
    # Laid out from offset 0: the kernel returns arrays with wrong offsets for slices.
    data, offsets = flat_text(texts)
    plain = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))
    )
    lowered = pc.ascii_lower(plain)
    parts = pc.split_pattern_regex(lowered, _BREAKS)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    # Breaks at the ends of a text leave empty parts.
    real = pc.greater(pc.binary_length(flat), 0)
    flat, owner = flat.filter(real), owner.filter(real).to_numpy(zero_copy_only=False)
    coded = flat.dictionary_encode()
    index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    crcs = np.fromiter((zlib.crc32(w) for w in words), np.uint32, count=len(words))
    # ``run`` numbers the distinct runs of a length, ``crcs`` has a value for each of them.
    run, found, owners = index, [crcs[index] % buckets], [owner]
    for length in range(2, max_run + 1):
        if len(index) < length:
            break
        pair = run[:-1] * max(len(words), 1) + index[length - 1 :]
        inside = owner[: len(pair)] == owner[length - 1 :]
        distinct, back = np.unique(pair, return_inverse=True)
        left, right = distinct // max(len(words), 1), distinct % max(len(words), 1)
        crcs = np.fromiter(
            (zlib.crc32(b" " + words[r], int(crcs[p])) for p, r in zip(left.tolist(), right.tolist())),
            np.uint32,
            count=len(distinct),
        )
        run = back
        found.append((crcs[run] % buckets)[inside])
        owners.append(owner[: len(pair)][inside])
    held = np.bincount(owner, minlength=len(lowered))
    if len(found) == 1:
        bucket, counts = found[0], held
    else:
        order = np.argsort(np.concatenate(owners), kind="stable")
        bucket = np.concatenate(found)[order]
        counts = np.bincount(np.concatenate(owners), minlength=len(lowered))
    first = np.zeros(len(lowered) + 1, np.int64)
    np.cumsum(counts, out=first[1:])
    return Features(bucket.astype(np.int64), first, held)


def bucket_counts(df: DataFrame, max_run: int, buckets: int, text_col: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket; ``buckets`` numbers in all."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for table in chunks(batches, "text"):
            total += np.bincount(text_features(table["text"], max_run, buckets).buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    found = (
        df.select(F.col(f"`{text_col}`").alias("text"))
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    counts = np.zeros(buckets, np.int64)
    counts[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return counts


def bucket_gains(pool: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed share in the target over that in the pool."""
    all_pool, all_target, n = float(pool.sum()), float(target.sum()), float(len(pool))
    return np.array(
        [
            math.floor(1000.0 * math.log((t + 1.0) * (all_pool + n) / ((s + 1.0) * (all_target + n))))
            for s, t in zip(pool.tolist(), target.tolist())
        ],
        np.int64,
    )


def weigh(
    df: DataFrame,
    gains: np.ndarray,
    max_run: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` for every row."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = pa.array(gains)
        for table in chunks(batches, "text"):
            features = text_features(table["text"], max_run, buckets)
            gathered = values.take(pa.array(features.buckets)).to_numpy(zero_copy_only=False)
            sums = np.zeros(len(gathered) + 1, np.int64)
            np.cumsum(gathered, out=sums[1:])
            total = sums[features.first[1:]] - sums[features.first[:-1]]
            n = np.diff(features.first)
            ids = table["doc_id"].combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [
                    ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids,
                    pa.array(features.words.astype(np.int64)),
                    pa.array(n),
                    pa.array(total // np.maximum(n, 1)),
                ],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    narrow = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    return narrow.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def add_score(weighed: DataFrame, seed: int) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise of the id, in thousandths, floored."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long").cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed.withColumn("score", F.col("weight") + noise.cast("long"))


def resample(
    pool: DataFrame,
    target: DataFrame,
    scratch: Scratch,
    percent: int = 10,
    least_words: int = 20,
    max_run: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of the pool.

    ``rank`` numbers the drawn rows from 1 by falling score and is null for the others. Drawn
    are ``percent`` of the rows with ``least_words`` words or more, rounded down. ``scratch``
    holds the scores; its owner drops it when the result has been used.
    """
    gains = bucket_gains(
        bucket_counts(pool, max_run, buckets), bucket_counts(target, max_run, buckets)
    )
    eligible = F.col("n_words") >= least_words
    scored, found = scratch.write(
        add_score(weigh(pool, gains, max_run), seed), {"eligible": F.count_if(eligible)}
    )
    drawn = percent * (found["eligible"] or 0) // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.filter(~eligible).select(*columns, F.lit(None).cast("long").alias("rank"))
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("n_features"), F.asc("weight")]
    ranked = assign_ids(scored.filter(eligible).select(*columns), order, "rank", 1, scratch)
    place = F.when(F.col("rank") <= drawn, F.col("rank")).cast("long").alias("rank")
    return ranked.select(*columns, place).unionByName(rest)
