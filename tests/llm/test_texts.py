"""Chat formatting, SentencePiece and language-model scores."""

import collections
import hashlib
import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from millrace.llm import chat, mixing, pieces


def test_chats_read_back_whole(spark):
    odd = [chat.FORGED_TEXT, "<|", "<\\|", "<\\\\|x<", "|<|>", "é😀\n\n", "", None, "<|im_end|>\n", "<"]
    rng = random.Random(1)
    rows = []
    for c in range(40):
        for t in range(rng.randint(1, 6)):
            text = "".join(rng.choice([o or "" for o in odd]) for _ in range(3)) if c % 2 else rng.choice(odd)
            rows.append((c, t, rng.choice(["user", "assistant", None, "a|\\\nb"]), text))
    rows += [(None, 1, "user", "x"), (None, 0, "assistant", "y"), (3, 0, rows[0][2], "same turn"), (99, None, "assistant", "z")]
    rows += [(500, t, "assistant", "long " * 300) for t in range(200)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("last", F.lit(1))
    for piece in (16 << 20, 2000):
        formatted = chat.format_chats(chat.with_forged_chat(frame), piece_bytes=piece)
        got = {r.conv_id: r for r in chat.chat_digests(formatted).collect()}
        groups = collections.defaultdict(list)
        for r in [*rows, *[(-1, i, r, chat.FORGED_TEXT) for i, r in enumerate(("user", "assistant"))]]:
            groups[r[0]].append(tuple((x is not None, x) for x in r[1:]))
        assert got.keys() == groups.keys()
        for conv, turns in groups.items():
            turns = [[x for _, x in t] for t in sorted(turns)]
            whole = "".join(f"{role or ''}\n{text or ''}\n" for _, role, text in turns)
            loss = "".join(text or "" for _, role, text in turns if role == "assistant")
            r = got[conv]
            assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
            assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_digests(chat.format_chats(frame.limit(0))).count() == 0


def test_long_turns_keep_conversations_apart(spark):
    """A turn longer than a piece, alone, first, last, and after a short conversation."""
    def digests(rows, **options):
        frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
        return {r.conv_id: r for r in chat.chat_digests(chat.format_chats(frame, **options)).collect()}

    def expected(turns):
        whole = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        return len(turns), hashlib.sha256(whole.encode()).hexdigest(), hashlib.sha256(loss.encode()).hexdigest()

    big = "y " * 9_000_000
    rows = [(1, 0, "assistant", big)]
    got = digests(rows)[1]
    assert (got.n_turns, got.turns_sha256, got.loss_sha256) == expected(rows)
    long = "z<|" * 2000
    rows = [(1, 0, "user", "hi"), (2, 0, "assistant", long), (3, 0, "user", "a"), (3, 1, "assistant", long),
            (3, 2, "user", "b"), (4, 0, "user", long), (4, 1, "assistant", "c"), (5, 0, "assistant", long),
            (5, 1, "assistant", long), (6, 0, "user", "d")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        found = digests(rows, piece_bytes=2000)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for conv in range(1, 7):
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_sha256) == expected([t for t in rows if t[0] == conv]), conv


ODD_TEXTS = ["", " ", "   a", "a  b ", "é日本😀\x00", "<s></s><unk><0x41>", "▁x ▁", "\n\t\r", "x" * 500, "a b " * 40_000, None]


def test_pieces_equal_the_reference_library(spark):
    model = pieces.read_model()
    known = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(2)
    texts = ODD_TEXTS + ["".join(rng.choice(" ab the\né▁<s>  ") for _ in range(rng.randint(0, 50))) for _ in range(500)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as n_tokens")
    rows = pieces.tokenize_and_verify(frame, model, batch_bytes=3000).collect()
    for r in rows:
        if r.text is None:
            assert r.token_ids is None and r.n_tokens is None and r.round_trip is None
            continue
        assert r.token_ids == known.encode(r.text), r.text
        assert r.n_tokens == len(r.token_ids) and r.round_trip == ("▁" not in r.text)
    both = pieces.decode_pieces(pieces.encode_pieces(frame, model), model).collect()
    assert all(r.decoded == (None if r.text is None else known.decode(r.token_ids)) for r in both)
    assert pieces.tokenize_and_verify(frame.limit(0), model).count() == 0


def test_known_words_are_encoded_once_and_decoded_by_a_table(monkeypatch):
    data = pieces.read_model()
    known = sentencepiece.SentencePieceProcessor(model_proto=data)
    monkeypatch.setattr(pieces, "_JOINED", 7)
    codec = pieces.Codec(data)
    sent, decoded = [], []
    whole, decode = codec._encode_whole, codec.decode
    monkeypatch.setattr(codec, "_encode_whole", lambda texts: sent.append(texts) or whole(texts))
    monkeypatch.setattr(codec, "decode", lambda ids: decoded.extend(ids) or decode(ids))
    texts = ["", " ", "   ", "a  b", "é日本😀\x00 <0x41> <s>", "a b ", *[f"w{i} w{i % 5}é\n" for i in range(40)], "x" * 500]
    for _ in range(2):
        ids, offsets = codec.encode(texts)
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [known.encode(t) for t in texts]
        assert codec.gives_back(ids, offsets, texts).all()
        first, sent[:] = list(sent), []
    assert not first and not decoded
    # Ids that mean something else, and as many bytes.
    other = codec.gives_back(np.append(ids[:-1], ids[0]), offsets, texts)
    assert other[:-1].all() and not other[-1] and len(decoded) == 1
    monkeypatch.setattr(pieces, "_MOST_WORDS", 5)
    again, _ = codec.encode(texts)
    assert sent and (again == ids).all()


def message(*fields):
    out = b""
    for number, value in fields:
        if isinstance(value, float):
            out += bytes([number << 3 | 5]) + struct.pack("<f", value)
        elif isinstance(value, int):
            out += bytes([(number << 3 & 0x7F) | 0x80, number >> 4, value]) if number > 15 else bytes([number << 3, value])
        else:
            size, tail = len(value), b""
            while True:
                tail += bytes([size & 0x7F | (0x80 if size > 0x7F else 0)])
                size >>= 7
                if not size:
                    break
            out += bytes([number << 3 | 2]) + tail + value
    return out


@pytest.mark.parametrize("collapse", [0, 1])
def test_unigram_models(collapse):
    vocabulary = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    vocabulary += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    vocabulary += [(p, -float(i + 1), 1) for i, p in enumerate(["▁", "▁the", "th", "e", "t", "h", "▁a", "ab", "b", "a", "▁▁", "he"])]
    parts = [(1, message((1, p.encode()), (2, s), (3, k))) for p, s, k in vocabulary]
    data = message(*parts, (2, message((3, 1), (35, 1))), (3, message((1, b"identity"), (3, 1), (4, collapse), (5, 1))))
    known = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = pieces.Codec(data)
    rng = random.Random(3)
    texts = ["".join(rng.choice("the ab  é") for _ in range(rng.randint(0, 20))) for _ in range(300)]
    ids, offsets = codec.encode(texts)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == known.encode(text), text


def test_models_that_cannot_be_rebuilt_are_refused():
    piece = (1, message((1, b"<unk>"), (2, 0.0), (3, 2)))
    with pytest.raises(ValueError, match="unigram and BPE"):
        pieces.PieceModel.parse(message(piece, (2, message((3, 3)))))
    with pytest.raises(ValueError, match="user-defined"):
        pieces.PieceModel.parse(message((1, message((1, b"x"), (2, 0.0), (3, 4)))))


def test_scores_of_texts(spark):
    rng = random.Random(5)
    vocabulary = ["the", "House", "garden", "of", "and", "Tree", "river", "stone"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1010, "zq xj " * 30), (None, "the house"), (1003, "the " * 30_000), rows[7]]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k1", "2 as bits")
    held = F.coalesce(F.col("doc_id") % 10 == 0, F.lit(True))
    got = mixing.score_documents(frame, held, F.col("doc_id") % 10 == 9).collect()
    assert len(got) == len(rows)
    tokens = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + [" "]
    count = collections.Counter(x for i, t in rows if i is not None and i % 10 for x in tokens(t))
    n, v = sum(count.values()), len(count)
    text_of = dict(rows)
    for r in got:
        mine = tokens(text_of[r.doc_id])
        base = sum(math.log10((count[t] + 0.1) / (n + 0.1 * (v + 1))) for t in mine)
        assert r.n_tokens == len(mine) and r.n_known == sum(t in count for t in mine) and r.train_tokens == n
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.held_out == (r.doc_id is None or r.doc_id % 10 == 0)
        assert r.score < 0 and r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / r.n_bytes)
    rate = {r.doc_id: r.bits_per_byte for r in got}
    usual = [r.bits_per_byte for r in got if r.held_out and r.n_bytes > 100 and r.doc_id and r.doc_id < 300]
    assert max(usual) < 1.5 < rate[1010]
    assert mixing.score_documents(frame.limit(0), held, held).count() == 0
    alone = mixing.score_documents(frame.limit(5), F.lit(True), F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known) for r in alone} == {(0, 0)}
    assert all(r.bits_per_byte == pytest.approx(8, rel=0.01) for r in alone)


def test_buckets_answer_a_chunk_with_one_row(spark):
    """Not one for each text that holds a word of the bucket."""
    rng = random.Random(4)
    rows = [(i, -i, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "k1 long, k2 long, text string").coalesce(1)
    counts = mixing.token_counts(docs, 16)
    found = mixing._bucket_sums(docs, counts, {}, ["k1", "k2"], 4, 16)
    assert found.groupBy("bucket").count().filter("count <> 1").count() == 0 and found.count() == 17


def test_both_values_of_a_bit_share_its_probability():
    weights, last = mixing._fresh()
    last[1] += 5
    mixer = mixing.Mixer(np.zeros(0, np.int8), weights, last)
    costs = mixer.costs.reshape(2, 256, -1).astype(float)
    assert np.allclose((2**-costs).sum(axis=0), 1)
    # Every byte has its own path of gates and bits, so its probabilities add up to one too.
    paths = {tuple(zip(g, b)) for g, b in zip(mixing._BYTE_GATES.tolist(), mixing._BYTE_BITS.tolist())}
    assert len(paths) == 256


def test_each_context_and_byte_is_looked_up_once(monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choice("abé D") for _ in range(rng.randint(0, 900))) for _ in range(40)] + [None, ""]
    weights, last = mixing._fresh()
    tables = np.random.default_rng(2).integers(-127, 127, sum(mixing._sizes()), np.int8)
    mixer = mixing.Mixer(tables, weights, last)
    looked, found = collections.Counter(), mixing.Mixer._logits
    monkeypatch.setattr(
        mixing.Mixer, "_logits", lambda self, w, order: looked.update({order: len(w)}) or found(self, w, order)
    )
    bits, sizes = mixer.run(pa.chunked_array([pa.array(texts)]))
    framed = [b"\xff" * 6 + (t or "").lower().encode() + b"\xff" for t in texts]
    for order, k in enumerate(mixing.ORDERS):
        assert looked[order] == len({f[i - k : i + 1] for f in framed for i in range(6, len(f))})
    assert sizes.tolist() == [len((t or "").encode()) + 1 for t in texts] and (bits > 0).all()
    # The same logits, node by node from the tables.
    windows, _ = mixing._windows(pa.chunked_array([pa.array(texts[:3])]))
    codes, distinct = mixing._coded(windows)
    assert (distinct[codes] == windows).all() and (np.diff(distinct.astype(object)) >= 0).all()
    starts = np.cumsum([0, *mixing._sizes()])
    for order in range(len(mixing.ORDERS)):
        logits = found(mixer, distinct, order)
        for half, slots in enumerate(mixing._slots(distinct, order)):
            for b in range(4):
                nibble = (mixing._byte(distinct) >> (4 - 4 * half)) & 15
                node = (1 << b) + (nibble >> (4 - b))
                assert (logits[:, 4 * half + b] == tables[starts[order] + slots * 16 + node]).all()


def test_a_counting_task_sends_each_part_once(spark):
    """However many different windows it meets, and whatever the number of its chunks."""
    rng = np.random.default_rng(8)
    rows = [("".join(map(chr, rng.integers(97, 123, 3_000_000))),) for _ in range(2)]
    docs = spark.createDataFrame(rows, "text string").coalesce(1)
    found = mixing._count_contexts(docs).collect()
    assert len({r.part for r in found}) == len(found) == sum(mixing._sizes()) // mixing._PART
    # Each byte and end has two entries in each table.
    total = sum(int(mixing._unpack(bytes(r.counts)).sum()) for r in found)
    assert total == 2 * len(mixing.ORDERS) * 2 * 3_000_001


def test_counts_that_may_overflow_are_sent_before(spark, monkeypatch):
    docs = spark.createDataFrame([("ab" * 1000,)] * 4, "text string").coalesce(1)
    whole = mixing._sum_parts(mixing._count_contexts(docs), "part").collect()
    monkeypatch.setattr(mixing, "_MOST", 5000)
    monkeypatch.setattr(mixing, "chunks", lambda b, *_: (pa.Table.from_batches([x.slice(i, 1)]) for x in b for i in range(len(x))))
    parts = mixing._sum_parts(mixing._count_contexts(docs), "part").collect()
    key = lambda r: (r.part, mixing._unpack(bytes(r.counts)).tolist())
    assert sorted(map(key, whole)) == sorted(map(key, parts)) != []


def test_blocks_of_equal_number_come_together():
    sizes = np.array([1, 700, 256, 257, 60_000, 3, 512])
    places, pieces, names, calls = mixing._by_block(sizes)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(sizes)), sizes)
    number = (np.arange(ends[-1]) - (ends - sizes)[text]) // mixing.BLOCK
    order = np.argsort(number, kind="stable")
    assert (places == order).all() and calls[0] == 0 and calls[-1] == len(order)
    assert np.diff(calls).min() > 0 and np.diff(calls).max() <= mixing._SCORE_BYTES
    for a, b in zip(calls, calls[1:]):
        assert len(set(number[order[a:b]])) == 1
    lengths = np.diff(np.append(pieces, len(order)))
    assert (np.repeat(names, lengths) == text[order]).all() and set(calls[:-1]) <= set(pieces.tolist())
    assert mixing._by_block(sizes[:0])[3] == [0]


def test_gradients_are_those_of_each_bit():
    """Learning sorts the bytes of a call; weights are those that its bits ask for one by one."""
    rng = np.random.default_rng(9)
    weights, last = mixing._fresh()
    tables = rng.integers(-127, 127, sum(mixing._sizes()), np.int8)
    mixer = mixing.Mixer(tables, weights.copy(), last)
    text = "the garden of é stone " * 9
    column = pa.chunked_array([pa.array([text])])
    windows, _ = mixing._windows(column)
    byte = mixing._byte(windows)
    logits = [mixer._logits(windows, k) / 16 for k in range(len(mixing.ORDERS))]
    gates, bits = mixing._BYTE_GATES[byte], mixing._BYTE_BITS[byte]
    mixed = sum(w[gates] * x for w, x in zip(weights, logits))
    level = np.clip(mixed * 511 / 24 + 256, 0, 511).astype(int)
    error = bits - mixing._CENTERS[level]
    mixer.run(column, "weights")
    assert len(windows) < mixing.BLOCK
    for k, x in enumerate(logits):
        gradient = np.bincount(gates.ravel(), (x * error).ravel(), 256)
        step = mixing.WEIGHT_RATE * gradient / (np.bincount(gates.ravel(), minlength=256) + 64)
        assert mixer.weights[k] == pytest.approx(weights[k] + step, abs=1e-3)
        assert np.abs(step).max() > 0.01


def test_short_words_are_coded_as_numbers(monkeypatch):
    texts = ["a ab abc\x00 abc abcdefg abcdefgh abcdefghi", None, "", "  ", "é\x00 é 漢字 漢字漢 a\x00 a 1234567\x00 1234567"] * 2
    monkeypatch.setattr(mixing.Words, "coded", None)
    codes, distinct, first = mixing._tokens(pa.chunked_array([pa.array(texts)]))
    assert [distinct[c].as_py() for c in codes] == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert len(distinct) == len(set(distinct.to_pylist())) == 14
    assert first.tolist() == [0, 7, 7, 7, 7, 15, 22, 22, 22, 22, 30]
    codes, distinct, _ = mixing._tokens(pa.chunked_array([pa.array([None, ""])]))
    assert len(codes) == len(distinct) == 0


def test_tokens_are_dealt_by_all_their_bytes():
    words = [f"{a}{'x' * n}{b}" for a in "pq" for b in "rs" for n in range(300)]
    found = mixing._bucket(pa.array(words, pa.large_string()), 16)
    assert found.tolist() == [mixing._bucket(pa.array([w], pa.large_string()), 16)[0] for w in words]
    assert np.bincount(found, minlength=16).min() > 40
