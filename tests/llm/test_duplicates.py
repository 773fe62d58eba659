"""Repeated passages, SimHash components, similar lines and neighbours against brute force."""

import collections
import hashlib
import random
import re
import signal
import time

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontaminate, lines, neighbours, simhash, substrings
from millrace.llm.arrow import mix

WORDS = [f"w{i}" for i in range(300)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(rng):
    passage = prose(rng, 60)
    texts = [prose(rng, rng.randint(0, 120)) for _ in range(40)]
    texts += [f"{prose(rng, 20)} {passage[: rng.randint(100, 240)]} {prose(rng, 9)}" for _ in range(8)]
    texts += [texts[3], texts[3], "a " * 200, "a " * 100, None, "", " \n", "é b " * 60]
    near = prose(rng, 80).split()
    for i in range(10):
        near[i * 7] = rng.choice(WORDS)
        texts.append(" ".join(near))
    return [(i, t) for i, t in enumerate(texts)] + [(None, passage), (7, texts[7])]


def test_repeated_passages(spark):
    rows = corpus(random.Random(8))
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as k1", "2 as marks").repartition(3)
    for window, mer in ((35, 4), (10, 3), (1, 1)):
        words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
        count = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
        want = []
        for (doc, _), w in zip(rows, words):
            gone = {
                j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)
            }
            kept = " ".join(x for j, x in enumerate(w) if j not in gone)
            want.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
        got = [tuple(r) for r in substrings.remove_repeated(frame, window, mer, buckets=5).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert substrings.remove_repeated(frame.limit(0)).count() == 0


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(substrings, "_window_hash", lambda v, size: np.zeros(max(0, len(v) - size + 1), np.uint64))
    codes = np.array([1, 2, 3, 1, 2, 9, 1, 2, 3])
    order, same = substrings._classes(codes, np.arange(8), 2)
    pairs = {(int(order[i - 1]), int(order[i])) for i in np.flatnonzero(same)}
    assert pairs == {(0, 3), (3, 6), (1, 7)}


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    found = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in found]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components(spark):
    rows = corpus(random.Random(9)) + [(100, "One two"), (101, "one\ttwo"), (102, "É x y z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fingerprint", "2 as root")
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = collections.defaultdict(list)
    for g, (doc, _) in zip(group, rows):
        least[g].append(doc)
    want = [
        (doc, f"{p:016x}", min((d for d in least[g] if d is not None), default=None))
        for (doc, _), p, g in zip(rows, prints, group)
    ]
    for shard in (4096, 3):
        got = simhash.hex_fingerprint(simhash.simhash_components(frame, shard=shard)).collect()
        assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({w[2] for w in want}, key=str)
    assert simhash.simhash_components(frame.limit(0)).count() == 0


def test_bk_tree_finds_all_within_the_radius():
    rng = np.random.default_rng(4)
    values = np.unique(rng.integers(0, 1 << 12, 700).astype(np.uint64))
    tree = simhash.BKTree(values)
    for radius in (0, 2, 5):
        got = {(a, b) for q, n in tree.search(values, radius) for a, b in zip(q.tolist(), n.tolist())}
        close = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius
        assert got == set(zip(*map(lambda x: x.tolist(), np.nonzero(close))))


def test_similar_lines(spark):
    rng = random.Random(6)
    base = [prose(rng, 30) for _ in range(30)]
    near = []
    for i, line in enumerate(base[:12]):
        words = line.split()
        words[i % 30] = "other"
        near.append(" ".join(words))
    rows = [(i, "\n".join(base[i * 3 : i * 3 + 3])) for i in range(10)]
    rows += [(20 + i, f"  {x}\r\n\n{prose(rng, 25)}\nab\n") for i, x in enumerate(near)]
    rows += [(40, "ab"), (41, None), (42, ""), (43, "\n \n"), (None, base[0]), (20, rows[10][1]), (44, "q" * 300_000)]
    rows += [(45, "q" * 299_990)]
    distinct = list(dict.fromkeys(x.strip() for _, t in rows for x in (t or "").split("\n") if x.strip()))
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in distinct]
    group = list(range(len(distinct)))
    for i in range(len(distinct)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    of = dict(zip(distinct, group))
    seen = {}
    for doc, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        for n, line in enumerate((text or "").split("\n")):
            if line.strip():
                seen.setdefault(of[line.strip()], (doc, n))
    want = []
    for doc, text in rows:
        all_lines = (text or "").split("\n")
        kept = [x for n, x in enumerate(all_lines) if not x.strip() or seen[of[x.strip()]] == (doc, n)]
        filled = sum(bool(x.strip()) for x in all_lines)
        want.append((doc, None if text is None else "\n".join(kept), 5, filled, len(all_lines) - len(kept)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 as root", "6 as n_lines")
    for chars in (4 << 20, 500):
        got = lines.dedup_lines(frame, slice_chars=chars)
        assert got.columns == ["doc_id", "text", "root", "n_lines", "n_removed"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert lines.dedup_lines(frame.limit(0)).count() == 0


def test_groups_of_many_lines_equal_brute_force():
    rng = random.Random(9)
    for size in (2, 10, 40, 150, 400):
        texts = []
        while len(texts) < size:
            line = list("".join(rng.choice("abcd ") for _ in range(rng.randint(4, 60))))
            for _ in range(rng.randint(1, 12)):
                texts.append("".join(line) or "x")
                line[rng.randrange(len(line))] = rng.choice("abcdefgh")
        texts = list(dict.fromkeys(texts))
        sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for x in texts]
        want = list(range(len(texts)))
        for i in range(len(texts)):
            for j in range(i):
                both = len(sets[i] & sets[j])
                if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) and want[i] != want[j]:
                    a, b = sorted((want[i], want[j]))
                    want = [a if g == b else g for g in want]
        assert lines.similar_groups(texts, 8, 0.8).tolist() == want


def test_many_loose_lines_take_seconds():
    rng = random.Random(4)
    loose = [f"Item number {rng.randrange(10**9)} costs {rng.randrange(10**5)} and goes to shelf {rng.randrange(10**4)}" for _ in range(40_000)]
    begin = time.process_time()
    groups = lines.similar_groups(loose, 8, 0.8)
    assert len(groups) == 40_000 and time.process_time() - begin < 60
    tight = [f"{'the same long line of a template, over and over again ' * 3}{i}" for i in range(20_000)]
    begin = time.process_time()
    assert set(lines.similar_groups(tight, 8, 0.8).tolist()) == {0}
    assert time.process_time() - begin < 60


def test_columns_of_any_name_are_kept(spark):
    odd = ["_k1", "_k2", "_removed", "N_LINES", "a.b", "_row", "_found_id", "and so on"]
    frame = spark.createDataFrame(
        [(1, "a long enough line of text", *range(8)), (2, "a long enough line of text", *range(8)), (3, None, *range(8))],
        "doc_id long, text string, " + ", ".join(f"`{n.replace('`', '``')}` int" for n in odd),
    )
    got = lines.dedup_lines(frame)
    assert got.columns == [c for c in frame.columns if c != "N_LINES"] + ["n_lines", "n_removed"]
    assert {(r["doc_id"], r["_k1"], r["_removed"], r["a.b"], r["n_removed"]) for r in got.collect()} == {
        (1, 0, 2, 4, 0), (2, 0, 2, 4, 1), (3, 0, 2, 4, 0)
    }
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns and {(r["doc_id"], r["_row"]) for r in kept.collect()} == {(1, 5), (3, 5)}
    benchmark = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    clean = decontaminate.drop_contaminated(frame, benchmark)
    assert clean.columns == frame.columns and clean.count() == 3


def test_signatures_end_for_any_hash(monkeypatch):
    # The first comes of borrowing as the greatest value, the second is a minimum with it.
    lows = [0xE2E9A15E, 0xFFFFFFFF]
    assert (lows[0] * 0x9E3779B1 + 1) % 2**32 == 0xFFFFFFFF
    hashes = np.array([(1 << 63) + low for low in lows], np.uint64)
    monkeypatch.setattr(lines, "_shingles", lambda texts, size: (hashes, np.arange(3)))

    def stop(*_):
        raise TimeoutError

    held = signal.signal(signal.SIGALRM, stop)
    signal.alarm(20)
    try:
        got = lines._signatures(["a", "b"], 8, 60)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, held)
    for row, low in zip(got.tolist(), lows, strict=True):
        for step in range(60):
            assert row[(30 - step) % 60] == low
            low = (low * 0x9E3779B1 + 1) % 2**32


def test_neighbours_have_exact_scores_and_high_recall(spark):
    rng = np.random.default_rng(3)
    centers = rng.standard_normal((10, 24))
    vectors = centers[rng.integers(0, 10, 900)] + 0.8 * rng.standard_normal((900, 24))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(vectors)]
    rows += [(rows[0][0], rows[0][1]), (2000, rows[40][1]), (2020, rows[40][1])]
    bad = [(3000, None), (3020, []), (3040, [0.0] * 24), (3060, [float("nan")] * 24), (3080, [1.0, 2.0]), (None, rows[1][1]),
           (3100, [None] + [1.0] * 23), (3120, [float("inf")] + [1.0] * 23)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 as score", "2 as p")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(frame, frame.vec_id % 20 == 0, block=256).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    data = {i: np.array(v, dtype=float) for i, v in rows}
    queries = [i for i in data if i % 20 == 0]
    assert set(got) == set(queries)
    recall = []
    for q in queries:
        exact = {i: float(np.cumsum(data[q] * v)[-1]) for i, v in data.items() if i != q}
        best = sorted(exact, key=lambda i: (-exact[i], i))[:20]
        assert [r for r, _, _ in got[q]] == list(range(1, len(got[q]) + 1))
        assert all(s == exact[i] for _, i, s in got[q])
        assert [(-s, i) for _, i, s in got[q]] == sorted((-s, i) for _, i, s in got[q])
        recall.append(len({i for _, i, _ in got[q]} & set(best)) / 20)
    assert np.mean(recall) >= 0.9
    assert neighbours.nearest(frame.limit(0), frame.vec_id % 20 == 0).count() == 0


def test_neighbours_of_vectors_of_unequal_length(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1000, 24))
    vectors /= np.sqrt((vectors**2).sum(axis=1, keepdims=True))
    vectors[7] *= 50
    frame = spark.createDataFrame(list(enumerate(vectors.tolist())), "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(frame, frame.vec_id % 20 == 0).collect():
        got[r.query_id].add(r.vec_id)
    recall = []
    for q in range(0, 1000, 20):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        assert len(got[q]) == 20
        recall.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    assert np.mean(recall) >= 0.9 and min(recall) >= 0.5


def test_few_members_of_buckets_are_gathered_and_more_are_sought_without():
    rng = np.random.default_rng(6)
    v = rng.standard_normal((600, 24)) * np.exp(rng.standard_normal((600, 1)))
    ids = np.arange(600)
    longest = np.sqrt((v**2).sum(axis=1)).max()
    for probes in (1, 60):
        hasher = neighbours.Hasher(24, 2, 8, 2.0, probes, 1)
        members = neighbours._members(v, longest, hasher, 2)
        assert all(sorted(np.concatenate([p for _, _, p in t]).tolist()) == ids.tolist() for t in members)
        found = neighbours._rank(v[:50], ids[:50], v, ids, hasher, members, 20)
        assert collections.Counter(found["query_id"].to_pylist()) == {i: 20 for i in range(50)}


def test_probes_begin_with_the_own_bucket_and_are_all_different():
    hasher = neighbours.Hasher(5, 2, 4, 2.0, 40, 1)
    points = np.random.default_rng(1).standard_normal((30, 6))
    for table in (0, 1):
        probes = hasher.probes(points, table)
        assert (probes[:, 0] == hasher.buckets(points, table)).all()
        assert all(len(set(row)) == len(row) for row in probes.tolist())


def test_bands_of_a_chunk_come_as_one_batch_and_depend_on_the_line_alone(spark):
    texts = ["", "a\nb", "\U0001f600" * 20 + "\nabcdefg\nabcdefgh", None, "x" * 3000 + "\n" + "yz" * 30, "one line of some length"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    rows = lines._bands(frame, 8, 12, 5).withColumn("at", F.monotonically_increasing_id()).collect()
    assert len(rows) == 12 * 8
    # The twelve bands of a line stand together.
    assert all(len({r.id for r in rows[i : i + 12]}) == 1 for i in range(0, len(rows), 12))
    found = {}
    for r in rows:
        found.setdefault(r.id, set()).add(r.band)
    for text in texts:
        for line in (text or "").split("\n"):
            if line:
                signature = lines._signatures([line], 8, 60)[0].astype(np.uint64)
                keys = set()
                for b in range(12):
                    key = np.full(1, b + 1, np.uint64)
                    for value in signature[b * 5 : b * 5 + 5]:
                        key = mix(key ^ value)
                    keys.add(int(key.view(np.int64)[0]))
                assert keys == found[xxhash.xxh3_128_digest(line.encode())]


def test_many_small_groups_are_compared_at_once(monkeypatch):
    rng, calls, found = random.Random(8), [], lines._shingles
    monkeypatch.setattr(lines, "_shingles", lambda *a: calls.append(1) or found(*a))
    groups = []
    for _ in range(120):
        base = "".join(rng.choice("abc dé") for _ in range(rng.choice([0, 5, 9, 80])))
        groups.append([base[: rng.randint(0, 90)] + rng.choice(["", "x", "x y"]) for _ in range(rng.randint(1, 9))])
    got = lines._few_groups(groups, 8, 0.8)
    assert len(calls) == 1
    for texts, group in zip(groups, got, strict=True):
        sets = [{t[i : i + 8] for i in range(max(len(t) - 8, 0) + 1)} for t in texts]
        want = list(range(len(texts)))
        for _ in texts:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if len(a & b) >= 0.8 * len(a | b) - 1e-9:
                        want[i] = want[j] = min(want[i], want[j])
        assert group.tolist() == want
    # Hashes that share their high bits are still told apart.
    hashes = np.array([7, 5, 7, 1 << 40, 5, 6], np.uint64)
    n, codes = lines._coded(hashes)
    assert n == 4 and len({(h, c) for h, c in zip(hashes.tolist(), codes.tolist())}) == 4
