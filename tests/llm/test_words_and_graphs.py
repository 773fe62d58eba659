"""What the operators share: words, chunks, the Bloom filter, connected components."""

import random

import numpy as np
import pyarrow as pa

from millrace.llm import arrow
from millrace.llm.bloom import build_bloom
from millrace.llm.components import connected_components


def test_words_are_runs_between_ascii_spaces():
    texts = ["a  b\tc\n", "", None, "é x y", " \r\x0b\x0c", "last"]
    data, offsets = arrow.flat_text(pa.array(texts))
    words = arrow.split_words(data, offsets)
    found = [bytes(data[s:e]).decode() for s, e in zip(words.starts, words.ends)]
    assert found == ["a", "b", "c", "é x", "y", "last"]
    assert words.first.tolist() == [0, 3, 3, 3, 5, 5, 6]
    codes, distinct = words.encode()
    assert [distinct[c] for c in codes] == found


def test_chunks_keep_rows_whole_and_in_order():
    texts = [None, "a" * 50, "", "b" * 5, "c" * 5, "d" * 200, "e"]
    batches = [pa.RecordBatch.from_pydict({"text": texts[:3]}), pa.RecordBatch.from_pydict({"text": texts[3:]})]
    got = list(arrow.chunks(iter(batches), "text", 12))
    assert [t for table in got for t in table["text"].to_pylist()] == texts
    assert all(table.num_rows for table in got) and len(got) > 3


def test_bloom_loses_nothing(spark):
    values = spark.range(5000).selectExpr("xxhash64(id) as v")
    bloom = build_bloom(values, 5000)
    known = np.array([r.v for r in values.collect()], np.int64).view(np.uint64)
    assert len(bloom.find(known)) == 5000
    others = np.arange(20000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    assert len(bloom.find(others)) < 20


def test_components_of_chains_stars_and_loops(spark, scratch):
    random.seed(3)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 530)]
    noise = [(random.randrange(1000, 1200), random.randrange(1000, 1200)) for _ in range(90)]
    edges = [*chain, *star, (7, 7), (8, 9), (9, 8), (8, 9), *noise]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    frame = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    rows = connected_components(frame, scratch).collect()
    assert len(rows) == len(want) and {r.node: r.root for r in rows} == want
    assert connected_components(frame.filter("a = 7"), scratch).collect() == []
