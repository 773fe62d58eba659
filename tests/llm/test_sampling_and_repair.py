"""Conversation repair, exact top-k and importance resampling against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import importance, queries, repair, topk

BREAKS = " \t\n\x0b\x0c\r"


def plain_faults(rows):
    """First fault of each row of one conversation in order."""
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.rstrip(BREAKS)
        if not bare:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """All edits with at most two insertions at a place, tried one by one."""
    faults = plain_faults(rows)
    best = None
    per_row = [
        [
            (k, e)
            for k in range(3)
            for e in ("D", "K", "Ru", "Ra")
            if e == "D" or fault not in ("blank", "duplicate")
        ]
        for fault in faults
    ]
    for choice in itertools.product(*per_row, range(3)):
        *edits, tail = choice
        cost, audit, turns = 0, "", []
        for (k, e), (_, role, text), fault in zip(edits, rows, faults):
            turns += [None] * k
            cost += 3 * k + {"D": 4, "K": 0}.get(e, 3) + (3 if fault == "truncated" and e != "D" else 0)
            audit += "I" * k + e[0]
            if e != "D":
                turns.append((role if e == "K" else {"Ru": "user", "Ra": "assistant"}[e], text))
        turns, cost, audit = turns + [None] * tail, cost + 3 * tail, audit + "I" * tail
        if best is not None and (cost, audit) >= best[:2]:
            continue
        # Inserted turns take the role that fits; the others have theirs.
        starts_with_system = bool(turns) and turns[0] is not None and turns[0][0][:1] == "s"
        wanted = [("ua"[(i - starts_with_system) % 2]) for i in range(len(turns))]
        if starts_with_system:
            wanted[0] = "s"
        names = {"u": "user", "a": "assistant", "s": None}
        filled = [(names[w], "") if t is None else t for t, w in zip(turns, wanted)]
        if re.fullmatch("(s?(ua)+)?", "".join((r or "")[:1] or "-" for r, _ in filled)):
            best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in filled))
    return best


def plain_damage(rows):
    out, ids = [], {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        ids.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        ids[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv, found in ids.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = plain_faults(found)
        cost, audit, text = plain_repair(found)
        initials = [r[1][:1] for r in found]
        turns = [r[0] for r in found if r[0] is not None]
        out.append(
            (
                conv,
                max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                cost,
                audit,
                hashlib.sha256(text.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def test_repair_equals_brute_force(spark):
    rng = random.Random(11)
    texts = ["Yes.", "no", "Why? ", "", " \n", None, "Done!\t", "cut off", "é。", ". x"]
    rows = []
    for conv in [None, *range(120)]:
        for turn in range(rng.choice([1, 2, 2, 3, 3, 3, 4 if conv == 7 else 3])):
            turn = rng.choice([turn, turn, turn * 2, 1, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "User", "", None])
            rows.append((conv, turn, role, rng.choice(texts)))
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    noisy = frame.selectExpr("*", "1 as edit", "2 as fault", "3 as _digest", "4 as dropped").repartition(4)
    got = sorted((tuple(r) for r in repair.damaged_and_repaired(noisy).collect()), key=str)
    assert got == plain_damage(rows)
    assert repair.damaged_and_repaired(frame.limit(0)).collect() == []


def test_repair_decides_while_it_reads(spark):
    """Survivors that agree let go of their rows; a whole conversation is never held."""
    search, held = repair._Search(), 0
    for i in range(20_000):
        list(search.add(repair.Row(i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.", "")))
        held = max(held, _size(search.root))
    assert held < 40
    # A system turn and blank rows alone: the survivors keep apart, but no more than that.
    search = repair._Search()
    for i in range(500):
        list(search.add(repair.Row(i, "system" if not i else "user", "", "" if not i else "blank")))
    assert _size(search.root) < 2500
    assert "".join(e for e, *_ in search.finish()) == "D" * 500


def _size(node):
    total, todo = 0, [node]
    while todo:
        node = todo.pop()
        total += 1
        todo += node.children
    return total


def test_long_runs_of_one_role(spark):
    """Ties that only the end settles: compared with the search over all rows' strings."""
    rng = random.Random(3)
    for _ in range(30):
        rows = [(i, rng.choice(["user", "user", "assistant"]), f"t{i}.") for i in range(60)]
        search = repair._Search()
        audit = [e for r in rows for e, *_ in search.add(repair.Row(*r, ""))]
        audit = "".join([*audit, *(e for e, *_ in search.finish())])
        assert audit == _strings_search(rows)
    texts = ["x." * 300_000, "y " * 400_000]
    rows = [(1, i, "user", texts[i % 2] + str(i)) for i in range(6)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = repair.repair_conversations(frame).collect()
    assert [r["text"] for r in found if r["edit"] == "K"] == [
        rows[r["turn"]][3] for r in found if r["edit"] == "K"
    ]


def _strings_search(rows):
    """The same recursion with whole strings in place of a tree."""
    state = {0: (0, "")}
    for _, role, _ in rows:
        new = {}
        for step in repair.steps(role[0], ""):
            if step.source in state:
                cost, text = state[step.source]
                way = (cost + step.cost, text + step.letters)
                new[step.target] = min(new.get(step.target, way), way)
        state = new
    return min(
        (cost + more, text + letters)
        for q, (cost, text) in state.items()
        for more, letters, _ in repair.endings(q)
    )[1]


def plain_top(rows, k):
    usable = [
        (i, v) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and len(v) == 6
    ]
    usable = list(dict.fromkeys((i, tuple(math.floor(64 * x) for x in v)) for i, v in usable))
    out = []
    for qi, q in usable:
        if qi % 4:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in usable if i != qi)[:k]
        out += [(qi, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("slices,block", [(1, 1000), (2, 7), (4, 20), (9, 5)])
def test_top_k_equals_brute_force(spark, slices, block):
    rng = random.Random(slices)
    rows = [(i, [rng.choice([0.0, 0.25, -0.5, rng.gauss(0, 1)]) for _ in range(6)]) for i in range(70)]
    rows += [(90, rows[4][1]), (91, rows[4][1]), (3, rows[3][1]), (92, [0.0] * 6), (93, None), (94, [])]
    rows += [(95, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (96, [float("nan")] * 6), (97, [float("inf")] * 6), (98, [1.0] * 5)]
    rows += [(None, [1.0] * 6), (-8, [-1.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    noisy = frame.selectExpr("*", "1 as id", "2 as cutoff", "3 as score").repartition(3)
    for k in (1, 5, 200):
        got = topk.top_k(noisy, F.col("vec_id") % 4 == 0, k=k, slices=slices, block=block)
        assert sorted(tuple(r) for r in got.collect()) == plain_top(rows, k)
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 4 == 0).collect() == []


def test_top_k_of_large_numbers(spark):
    rows = [(0, [1e300, 1.0]), (1, [1e300, 0.0]), (2, [3e9, 7.0]), (3, [-1e300, 0.0]), (4, [2.0**30, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 0, k=3).collect()]
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, 2**63 - 1), (0, 3, 4, 2**63 - 1)]
    got = [tuple(r) for r in topk.top_k(frame, F.col("vec_id") == 4, k=4).collect()]
    assert [r[2] for r in got] == [0, 1, 2, 3]
    # 2^36 times floor(64 * 3e9), and 64 times 448: exact beyond 53 bits.
    assert got[2][3] == min(2**36 * (64 * 3 * 10**9) + 64 * 448, 2**63 - 1)


def test_cutoffs_leave_points_out():
    rng = np.random.default_rng(5)
    v = np.floor(64 * rng.standard_normal((3000, 32)))
    q = v[:50] + np.floor(rng.standard_normal((50, 32)))
    lists = topk.local_lists(q, v, topk.slice_bounds(32, 2))
    other = np.ones((50, 3000), bool)
    cutoff = topk._kth(lists.sum(axis=0), 20)
    kept = topk.collect(lists, other, cutoff)
    assert (kept | (lists.sum(axis=0) < cutoff[:, None])).all()
    assert kept.mean() < 0.3


def plain_features(text, runs, buckets):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    out = [
        zlib.crc32(" ".join(words[i : i + n]).encode()) % buckets
        for n in range(1, runs + 1)
        for i in range(len(words) - n + 1)
    ]
    return len(words), out


@pytest.mark.parametrize("runs", [1, 2, 4])
def test_importance_equals_brute_force(spark, scratch, runs):
    rng = random.Random(runs)
    vocabulary = ["Aa", "é", "x1", "日本", "z", "to", "BE", "or"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    texts += [None, "", "...", "\x00a\x7fb", "one", "one", "to be-or NOT" * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "to be"), (3, texts[3])]
    target = ["to be or not", None, "é é z"]
    buckets = 40
    pool = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as score", "2 as n")
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(pool.repartition(4), aim, scratch, 30, 5, runs, buckets, 7)
    s, t = [0] * buckets, [0] * buckets
    found = [(i, *plain_features(x, runs, buckets)) for i, x in rows]
    for _, _, f in found:
        for b in f:
            s[b] += 1
    for x in target:
        for b in plain_features(x, runs, buckets)[1]:
            t[b] += 1
    gain = [
        math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets))))
        for a, b in zip(s, t)
    ]
    want = []
    for i, n_words, f in found:
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        want.append([i, len(f), weight, weight + noise, n_words])
    able = sorted((w for w in want if w[4] >= 5), key=lambda w: (-w[3], w[0] is not None, w[0] or 0, w[1], w[2]))
    ranks = {id(w): n for n, w in enumerate(able[: 30 * len(able) // 100], 1)}
    want = sorted(((*w[:4], ranks.get(id(w))) for w in want), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_importance_of_empty_tables(spark, scratch):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert importance.resample(none, some, scratch).collect() == []
    assert [r["weight"] for r in importance.resample(some, none, scratch).collect()] == [-693]


def test_queries_read_the_given_tables(spark, tmp_path):
    """The registered forms: every conversation, every twentieth vector, every document."""
    rng = random.Random(1)
    talks = [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for c in range(30) for t in range(4)]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet"
    )
    vectors = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    assert sorted((tuple(r) for r in queries.op11_repair(spark, str(tmp_path)).collect()), key=str) == plain_damage(talks)
    top = queries.op12_top_k(spark, str(tmp_path)).collect()
    assert {r["query_id"] for r in top} == {0, 20, 40} and len(top) == 60
