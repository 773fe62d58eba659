"""SentencePiece models on the tokenizers library.

The model file is parsed from its protobuf fields, and its parts are rebuilt: the normaliser
with its character map, the marker for spaces, the scores (of a unigram model, or as the merge
order of a BPE model), and the fallback to bytes. Batches are encoded by several threads.

Where no piece continues over the beginning of a word, each different word is encoded once,
together with the spaces before it, which also bounds the length of what the library encodes at
a time by the longest word and not by the longest text. Many new words go to the library as one
text, and a task remembers a bounded number of words. Ids are decoded by a table of the bytes of
every piece; where these are not the text, the library's decoder says what the ids mean.

Defined results: a null text has null ids, an empty one has none; equal texts have equal ids;
an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from millrace.llm.arrow import chunks, flat_text

MARK = "▁"
#: Where the public tokenizer files lie on this machine; a parameter everywhere.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: A model larger than this is not sent along with the tasks.
MOST_MODEL_BYTES = 64 << 20
#: Words that go to the library as one text.
_JOINED = 4096
#: A task forgets its words beyond so many, or so many characters.
_MOST_WORDS, _MOST_CHARS = 1 << 18, 8 << 20

_UNIGRAM, _BPE = 1, 2
_NORMAL, _UNKNOWN, _CONTROL, _USER, _UNUSED, _BYTE = 1, 2, 3, 4, 5, 6


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            value: int | bytes = varint()
        elif kind in (1, 2, 5):
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"not a SentencePiece model: wire type {kind}")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = _UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    collapse_spaces: bool = True
    escape_spaces: bool = True
    suffix_marker: bool = False

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in _fields(data):
            if number == 1:
                parts = dict(_fields(value))
                score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
                model.pieces.append((parts[1].decode(), score, parts.get(3, _NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
                model.kind = trainer.get(3, _UNIGRAM)
                model.suffix_marker = bool(trainer.get(24, 0))
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                spec = dict(_fields(value))
                model.char_map = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                model.collapse_spaces = bool(spec.get(4, 1))
                model.escape_spaces = bool(spec.get(5, 1))
        if model.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and BPE models can be rebuilt")
        if model.suffix_marker or not model.escape_spaces:
            raise ValueError("models that mark the end of words or keep spaces are not supported")
        if any(kind == _USER for _, _, kind in model.pieces):
            raise ValueError("models with user-defined symbols are not supported")
        return model

    @property
    def word_by_word(self) -> bool:
        """Whether the marker stands at the beginning of pieces only, and texts stay as they are."""
        return not self.char_map and not self.collapse_spaces and not any(
            MARK in p.lstrip(MARK) for p, _, kind in self.pieces if kind == _NORMAL
        )

    def merges(self) -> list[tuple[str, str]]:
        """The BPE merges in order: a piece's score says when its halves are joined."""
        mergeable = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (_NORMAL, _UNUSED)}
        found = []
        for i, (piece, score, kind) in enumerate(self.pieces):
            if kind not in (_NORMAL, _UNUSED):
                continue
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in mergeable and right in mergeable:
                    found.append((-score, i, mergeable[left], mergeable[right], left, right))
        found.sort(key=lambda m: m[:4])
        return [m[4:] for m in found]

    def tokenizer(self, prefix: bool = True):
        """A tokenizer of the tokenizers library; without ``prefix`` for what follows a cut."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unknown = next((i for i, p in enumerate(self.pieces) if p[2] == _UNKNOWN), None)
        if self.kind == _BPE:
            model = models.BPE(
                {p: i for i, (p, _, _) in enumerate(self.pieces)},
                self.merges(),
                unk_token=None if unknown is None else self.pieces[unknown][0],
                byte_fallback=self.byte_fallback,
                fuse_unk=True,
            )
        else:
            # Only normal pieces may be found in a text: the others keep their ids, but are
            # given a score that no path takes.
            model = models.Unigram(
                [(p, s if kind == _NORMAL else -1e9) for p, s, kind in self.pieces],
                unk_id=unknown,
                byte_fallback=self.byte_fallback,
            )
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.char_map)] if self.char_map else []
        if self.collapse_spaces:
            steps += [
                normalizers.Replace(Regex("^ +| +$"), ""),
                normalizers.Replace(Regex(" {2,}"), " "),
            ]
        if self.dummy_prefix and prefix:
            steps.append(normalizers.Prepend(MARK))
        steps.append(normalizers.Replace(" ", MARK))
        out.normalizer = normalizers.Sequence(steps)
        if self.word_by_word:
            out.pre_tokenizer = pre_tokenizers.Split(
                Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), behavior="isolated"
            )
        last = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        out.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *last]
        )
        return out


class Codec:
    """Encodes and decodes batches of texts; ``threads`` of the library work on each."""

    def __init__(self, model: bytes, threads: int = 2):
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = PieceModel.parse(model)
        # With words on their own the prefix is one more space, and one tokenizer does for all.
        self.by_word = self.model.word_by_word
        self.tokenizer = self.model.tokenizer(prefix=not self.by_word)
        self.prefix = " " if self.model.dummy_prefix else ""
        pieces = [_piece_bytes(p) for p, _, _ in self.model.pieces]
        self.unknown = [i for i, p in enumerate(self.model.pieces) if p[2] == _UNKNOWN]
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self._ids, self._first, self._chars = np.zeros(0, np.int32), np.zeros(1, np.int64), 0

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and the offsets of each text's."""
        if self.by_word:
            texts = [self.prefix + t if t else "" for t in texts]
            if not any(MARK in t for t in texts):
                return self._encode_words(texts)
        return self._encode_whole(texts)

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return _flat([e.ids for e in found])

    def _encode_words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Every different word is encoded once, with the spaces before it."""
        data, bounds = flat_text(pa.array(texts, pa.large_string()))
        starts_word = data == 0x20
        starts_word[1:] &= data[:-1] != 0x20
        starts_word[bounds[:-1][bounds[:-1] < len(data)]] = True
        starts = np.flatnonzero(starts_word)
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(np.ascontiguousarray(data))
        ).dictionary_encode()
        codes = words.indices.to_numpy(zero_copy_only=False)
        places = self._learn(words.dictionary.to_pylist())[codes]
        sizes = np.diff(self._first)[places]
        ends = np.cumsum(sizes)
        at = np.repeat(self._first[places] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self._ids[at], np.append(0, ends)[np.searchsorted(starts, bounds)]

    def _learn(self, words: list[str]) -> np.ndarray:
        """The places of these words among those remembered; new ones are encoded."""
        if len(self._places) > _MOST_WORDS or self._chars > _MOST_CHARS:
            self._forget()
        new = [w for w in words if w not in self._places]
        # Only between these does the pre-tokenizer cut a joined text as it was joined.
        joined = [w for w in new if w[0] == " " and w[-1] != " "]
        alone = [w for w in new if w[0] != " " or w[-1] == " "]
        for some, encode in ((joined, self._encode_joined), (alone, self._encode_whole)):
            if some:
                ids, first = encode(some)
                known = len(self._first) - 1
                self._places.update(zip(some, range(known, known + len(some)), strict=True))
                self._first = np.append(self._first, first[1:] + len(self._ids))
                self._ids = np.append(self._ids, ids)
                self._chars += sum(map(len, some))
        return np.fromiter(map(self._places.__getitem__, words), np.int64, count=len(words))

    def _encode_joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words that begin, but do not end, with a space: many at a time, told apart by their bytes."""
        ids, _ = self._encode_whole(
            ["".join(words[i : i + _JOINED]) for i in range(0, len(words), _JOINED)]
        )
        ends = np.cumsum(self.sizes[ids])
        word_ends = np.cumsum([len(w.encode()) for w in words])
        last = np.searchsorted(ends, word_ends)
        # A piece for unknown text has no bytes of its own, and may stand for any number.
        if np.isin(self.unknown, ids).any() or not np.isin(word_ends, ends).all():
            return self._encode_whole(words)
        return ids, np.append(0, last + 1)

    def gives_back(self, ids: np.ndarray, offsets: np.ndarray, texts: list[str]) -> np.ndarray:
        """Whether decoding the ids of each text gives it back."""
        want, bounds = flat_text(pa.array([self.prefix + t if t else "" for t in texts], pa.large_string()))
        sizes = self.sizes[ids]
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.begins[ids] - ends[:-1], sizes) + np.arange(ends[-1])
        found, found_bounds = self.bytes[at], ends[offsets]
        lengths, found_lengths = np.diff(bounds), np.diff(found_bounds)
        same = lengths == found_lengths
        if same.all():
            wrong = np.append(0, np.cumsum(found != want))
            same = wrong[bounds[1:]] == wrong[bounds[:-1]]
        else:
            for i in np.flatnonzero(same).tolist():
                same[i] = np.array_equal(
                    found[found_bounds[i] : found_bounds[i + 1]], want[bounds[i] : bounds[i + 1]]
                )
        other = np.flatnonzero(~same).tolist()
        back = self.decode([ids[offsets[i] : offsets[i + 1]].tolist() for i in other])
        same[other] = [texts[i] == b for i, b in zip(other, back, strict=True)]
        return same

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


def _piece_bytes(piece: str) -> bytes:
    """What a piece stands for: its text with spaces for markers, or the byte that it names."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        try:
            return bytes([int(piece[3:5], 16)])
        except ValueError:
            pass
    return piece.replace(MARK, " ").encode()


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.zeros(len(ids) + 1, np.int64)
    np.cumsum([len(i) for i in ids], out=offsets[1:])
    return np.fromiter(chain.from_iterable(ids), np.int32, count=offsets[-1]), offsets


def _id_lists(ids: np.ndarray, offsets: np.ndarray, null: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(
        pa.array(offsets.astype(np.int32), mask=np.append(null, False)), pa.array(ids)
    )


def read_model(path: str = MODEL_PATH) -> bytes:
    """The model file, read by the driver; it travels with the tasks, so its size is checked."""
    with open(path, "rb") as file:
        data = file.read(MOST_MODEL_BYTES + 1)
    if len(data) > MOST_MODEL_BYTES:
        raise ValueError(f"the model has more than {MOST_MODEL_BYTES} bytes")
    PieceModel.parse(data)
    return data


def _with_column(df: DataFrame, name: str, kind) -> StructType:
    return StructType([*[f for f in df.schema.fields if f.name != name], StructField(name, kind)])


def encode_pieces(
    df: DataFrame,
    model: bytes,
    text: str = "text",
    into: str = "token_ids",
    threads: int = 2,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """Add ``into``, the ids of each text; a column of that name is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = _with_column(df, into, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, threads)
        for table in chunks(batches, text, batch_bytes):
            texts = table[text].to_pylist()
            null = np.array([t is None for t in texts], bool)
            column = _id_lists(*codec.encode([t or "" for t in texts]), null)
            kept = [table[f.name].combine_chunks() for f in schema.fields[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, column], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def decode_pieces(
    df: DataFrame,
    model: bytes,
    ids: str = "token_ids",
    into: str = "decoded",
    threads: int = 2,
    batch_bytes: int = 1 << 20,
) -> DataFrame:
    """Add ``into``, the text of each row's ids; null ids give null."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = _with_column(df, into, StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, threads)
        for batch in batches:
            # About four bytes of text for each id.
            rows = max(1, batch.num_rows * batch_bytes // max(1, batch.column(ids).nbytes))
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                found = part.column(ids).to_pylist()
                texts = codec.decode([i or [] for i in found])
                column = pa.array(
                    [None if i is None else t for i, t in zip(found, texts, strict=True)], pa.large_string()
                )
                kept = [part.column(f.name) for f in schema.fields[:-1]]
                yield pa.RecordBatch.from_arrays([*kept, column], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)


def tokenize_and_verify(
    df: DataFrame, model: bytes, text: str = "text", threads: int = 2, batch_bytes: int = 1 << 20
) -> DataFrame:
    """Add ``token_ids``, ``n_tokens`` and ``round_trip``: whether decoding gives the text back.

    One pass: a batch is encoded and decoded while it is in memory. ``round_trip`` is null
    for a null text. It is false where a text holds the marker itself, or where the model's
    normaliser changes the text.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    added = [
        StructField("token_ids", ArrayType(IntegerType())),
        StructField("n_tokens", LongType()),
        StructField("round_trip", BooleanType()),
    ]
    names = {f.name for f in added}
    kept_fields = [f for f in df.schema.fields if f.name not in names]
    schema = StructType([*kept_fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value, threads)
        for table in chunks(batches, text, batch_bytes):
            null = table[text].combine_chunks().is_null().to_numpy(zero_copy_only=False)
            texts = [t or "" for t in table[text].to_pylist()]
            ids, offsets = codec.encode(texts)
            columns = [
                _id_lists(ids, offsets, null),
                pa.array(np.diff(offsets), mask=null),
                pa.array(codec.gives_back(ids, offsets, texts), mask=null),
            ]
            kept = [table[f.name].combine_chunks() for f in kept_fields]
            yield pa.RecordBatch.from_arrays([*kept, *columns], [f.name for f in schema.fields])

    return df.mapInArrow(run, schema)
