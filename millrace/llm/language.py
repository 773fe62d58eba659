"""Language identification by nearest centroids.

A text is a vector of hashed character n-grams (1 to ``LONGEST``, in lower case, digits and
everything but letters read as one space), weighted by the logarithm of their number and by
how few of the sampled texts hold them, and scaled to length one. Each language has several
centroids, clustered from a bounded sample of its labelled texts. A text gets the language of
the centroid with the largest cosine. The reach of a language's centroids is a distance: all but
``STRAYS`` of a centroid's sampled texts have at least some cosine with it, and a text whose cosine is
less than ``share`` of the least of these lies beyond their reach and is rejected. A text with fewer than
``FULL`` different n-grams cannot come as close: the root of that part counts as its full cosine, in the
sample as well.

Defined results: a null text and a text without letters are ``und``, with score 0, rejected;
repeated rows repeat their result; rows without a label teach nothing; with nothing to learn
from, every text is ``und``; an empty table gives no rows; of tied centroids the one of the
alphabetically first language wins; other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from millrace.llm.arrow import chunks, mix
from millrace.session import Scratch

UNKNOWN = "und"
LONGEST = 3
_BITS = 13
DIMENSIONS = 1 << _BITS
#: Labelled texts of each language that the centroids are made from, chosen by a hash.
SAMPLE = 400
CLUSTERS = 4
SHARE = 0.35
#: The part of a centroid's texts that does not count for its reach: odd or wrongly labelled ones.
STRAYS = 0.05
#: Different n-grams from which on a text is judged in full; ten words have about as many.
FULL = 100
#: More languages than this would make the model too large to send along with the tasks.
MOST_LANGUAGES = 1000
_GROUP_CHARS = 1 << 18


def _normal(column: pa.ChunkedArray) -> list[str]:
    lowered = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    spaced = pc.replace_substring_regex(lowered, r"[^\pL]+", " ")
    return pc.utf8_trim(spaced, characters=" ").to_pylist()


def _pieces(text: str) -> Iterator[str]:
    """The text cut at spaces into pieces of about ``_GROUP_CHARS``; no n-gram spans a space."""
    start = 0
    while len(text) - start > _GROUP_CHARS:
        cut = text.find(" ", start + _GROUP_CHARS)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def _count(texts: list[str]) -> np.ndarray:
    """N-gram counts, a row for each text. An n-gram may begin or end with a space."""
    framed = [f" {t} " for t in texts]
    data = np.frombuffer("".join(framed).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in framed])
    row = np.repeat(np.arange(len(framed)) * DIMENSIONS, lengths)
    space = data == 0x20
    counts = np.zeros(len(framed) * DIMENSIONS, np.int64)
    value = np.zeros(len(data), np.uint64)
    inner = np.ones(len(data), bool)
    for n in range(1, LONGEST + 1):
        size = len(data) - n + 1
        value = value[:size] * np.uint64(0x100000001B3) + data[n - 1 :] + np.uint64(1)
        if n == 1:
            valid = ~space
        elif n == 2:
            # Two spaces meet only where two texts do.
            valid = ~(space[:-1] & space[1:])
        else:
            inner = inner[:size] & ~space[n - 2 : n - 2 + size]
            valid = inner
        place = (mix(value) >> np.uint64(64 - _BITS)).astype(np.int64)
        place += row[:size]
        counts += np.bincount(place[valid], minlength=len(counts))
    return counts.reshape(len(framed), DIMENSIONS)


def _vectors(column: pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of rows: the first one, the logarithms of the counts, and whether there are letters."""
    texts = _normal(column)
    start = 0
    while start < len(texts):
        if len(texts[start]) > _GROUP_CHARS:
            counts = sum(_count([piece]) for piece in _pieces(texts[start]))
            stop = start + 1
        else:
            stop, total = start, 0
            while stop < len(texts) and stop - start < 128 and total + len(texts[stop]) <= _GROUP_CHARS:
                total += len(texts[stop])
                stop += 1
            counts = _count(texts[start:stop])
        letters = np.array([bool(t) for t in texts[start:stop]])
        yield start, np.log1p(counts.astype(np.float32)), letters
        start = stop


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    return vectors / np.where(norm > 0, norm, 1)


def _cluster(vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from seeds far apart; centroids and each vector's."""
    seeds = [vectors.sum(axis=0)]
    centroids = _unit(np.array(seeds))
    while len(centroids) < min(k, len(vectors)):
        farthest = vectors[np.argmin((vectors @ centroids.T).max(axis=1))]
        centroids = np.concatenate([centroids, farthest[None]])
    for _ in range(10):
        member = np.argmax(vectors @ centroids.T, axis=1)
        centroids = _unit(
            np.stack(
                [vectors[member == c].sum(axis=0) if (member == c).any() else centroids[c]
                 for c in range(len(centroids))]
            )
        )
    return centroids, np.argmax(vectors @ centroids.T, axis=1)


def _within_reach(counts: np.ndarray) -> np.ndarray:
    """The cosine that a text of so many different n-grams may have at most, roughly."""
    return np.sqrt(np.clip((counts > 0).sum(axis=1) / FULL, 1 / FULL, 1))


@dataclass(frozen=True)
class LanguageModel:
    """Unit centroids with their language, weights of the n-grams, and the reach of each centroid."""

    languages: list[str]
    centroids: np.ndarray
    reach: np.ndarray
    weights: np.ndarray

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroid, cosine and whether the centroid reaches as far, for each row of counts."""
        cosines = _unit(vectors * self.weights) @ self.centroids.T
        best = np.argmax(cosines, axis=1)
        cosine = np.clip(cosines[np.arange(len(best)), best], 0, 1)
        return best, cosine, 1 - cosine / _within_reach(vectors) <= self.reach[best]


def train(
    labelled: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS, share: float = SHARE
) -> LanguageModel:
    """Centroids from ``doc_id, text, lang``: at most ``sample`` texts of each language are read.

    The texts are those with the smallest hashes of id and language, so a language that holds
    most rows weighs no more than another, and the choice is the same however rows are dealt.
    """
    order = Window.partitionBy("lang").orderBy("_h", "doc_id")
    usable = labelled.filter("lang is not null and doc_id is not null and text is not null").select(
        "doc_id", "lang", F.xxhash64("doc_id", "lang").alias("_h")
    )
    # Hashes below this bound leave about twice the sample of each language to put in order.
    bound = F.lit(float(1 << 64)) * F.least(F.lit(1.0), F.lit(2.0 * sample) / F.count("*"))
    bounds = usable.groupBy("lang").agg((bound - float(1 << 63)).alias("_bound"))
    if bounds.count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    chosen = (
        # At most MOST_LANGUAGES rows: labelled rows stay where they are until few are left.
        usable.join(F.broadcast(bounds), "lang")
        .filter(F.col("_h").cast("double") <= F.col("_bound"))
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= sample)
        .select("doc_id", "lang", "_place")
    )
    texts = (
        # At most MOST_LANGUAGES * sample ids: no text is shuffled to find its place.
        labelled.join(F.broadcast(chosen), ["doc_id", "lang"])
        .select("lang", "_place", "text")
        .dropDuplicates(["lang", "_place"])
    )

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in chunks(batches, "text"):
            for start, counts, letters in _vectors(table["text"]):
                rows = np.flatnonzero(letters)
                part = table.slice(start, len(counts)).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        part["lang"].combine_chunks(),
                        part["_place"].combine_chunks(),
                        pa.array([c.tobytes() for c in counts[rows].astype(np.float16)], pa.binary()),
                    ],
                    ["lang", "place", "v"],
                )

    found = texts.mapInArrow(vectors, "lang string, place int, v binary")

    def fit(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("place")
        counts = np.stack(
            [np.frombuffer(v, np.float16) for v in table["v"].to_pylist()]
        ).astype(np.float32)
        centroids, member = _cluster(_unit(counts), clusters)
        # Sums over the members: the weights are not known yet when the clusters are made.
        lang = key[0].as_py()
        sums = [counts[member == c] for c in range(len(centroids))]
        rows = [
            {"lang": lang, "n": len(s), "members": s.astype(np.float16).tobytes()}
            for s in sums if len(s)
        ]
        return pa.Table.from_pylist(
            rows, schema=pa.schema([("lang", pa.string()), ("n", pa.int64()), ("members", pa.binary())])
        )

    groups = found.groupBy("lang").applyInArrow(fit, "lang string, n long, members binary")
    return _assemble(groups, share)


def _assemble(groups: DataFrame, share: float) -> LanguageModel:
    """Weights from all sampled texts, then centroids and their reach under these weights."""
    scratch = Scratch(groups.sparkSession)
    stored, _ = scratch.write(groups)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column("members").to_pylist():
                counts = _members(members)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(DIMENSIONS)), pa.array((counts > 0).sum(axis=0)),
                     pa.array(np.full(DIMENSIONS, len(counts)))],
                    ["place", "n", "texts"],
                )

    rows = (
        stored.mapInArrow(presence, "place long, n long, texts long")
        .groupBy("place").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts")).toArrow()
    )
    weights = np.zeros(DIMENSIONS, np.float32)
    if rows.num_rows:
        n, texts = rows["n"].to_numpy(), rows["texts"].to_numpy()
        weights[rows["place"].to_numpy()] = np.log((1 + texts) / (1 + n)) + 1

    def centroid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                counts = _members(row["members"])
                vectors = _unit(counts * weights)
                center = _unit(vectors.sum(axis=0, keepdims=True))[0]
                cosines = np.minimum(vectors @ center / _within_reach(counts), 1)
                reach = 1 - share * float(np.quantile(cosines, STRAYS))
                out.append(
                    {"lang": row["lang"], "reach": reach, "center": center.astype(np.float32).tobytes()}
                )
            yield pa.RecordBatch.from_pylist(
                out,
                schema=pa.schema([("lang", pa.string()), ("reach", pa.float64()), ("center", pa.binary())]),
            )

    found = stored.mapInArrow(centroid, "lang string, reach double, center binary").toArrow()
    scratch.drop()
    by = sorted(found.to_pylist(), key=lambda r: (r["lang"], r["center"]))
    return LanguageModel(
        [r["lang"] for r in by],
        np.stack([np.frombuffer(r["center"], np.float32) for r in by])
        if by
        else np.zeros((0, DIMENSIONS), np.float32),
        np.array([max(r["reach"] for r in by if r["lang"] == own["lang"]) for own in by]),
        weights,
    )


def _members(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.float16).reshape(-1, DIMENSIONS).astype(np.float32)


def predict(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` (the cosine) and ``rejected``."""
    shared = df.sparkSession.sparkContext.broadcast(
        (model.languages, model.centroids, model.reach, model.weights)
    )
    added = [
        StructField("lang_pred", StringType()),
        StructField("score", DoubleType()),
        StructField("rejected", BooleanType()),
    ]
    fields = [f for f in df.schema.fields if f.name not in {a.name for a in added}]
    schema = StructType([*fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = LanguageModel(*shared.value)
        names = np.array([*known.languages, UNKNOWN], object)
        for table in chunks(batches, text):
            n = table.num_rows
            best, score, rejected = np.full(n, -1), np.zeros(n), np.ones(n, bool)
            for start, counts, letters in _vectors(table[text]):
                some = np.flatnonzero(letters)
                if not len(some) or not known.languages:
                    continue
                at, cosine, reached = known.nearest(counts[some])
                best[start + some], score[start + some], rejected[start + some] = at, cosine, ~reached
            yield pa.RecordBatch.from_arrays(
                [
                    *[table[f.name].combine_chunks() for f in fields],
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(score),
                    pa.array(rejected),
                ],
                [f.name for f in schema.fields],
            )

    return df.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    """CRC-32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
