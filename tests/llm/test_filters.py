"""Decontamination, personal data, language, and the pipeline, on small tables."""

import hashlib
import itertools
import math
import random
import time
import re

import pytest

import corpus_pipeline
from millrace.llm import decontaminate, language, pii

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def documents(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def test_masks_see_every_overlap_that_counts():
    for length in range(decontaminate.LEAST_TOKENS, 21):
        wrong = length - math.ceil(0.8 * length - 1e-9)
        masks = [m for m, (a, b) in decontaminate._LENGTHS.items() if a <= length <= (b or length)]
        for places in itertools.combinations(range(length), wrong):
            assert any(
                all(at + i not in places for i, c in enumerate(mask) if c == "1")
                for mask in masks
                for at in range(length - len(mask) + 1)
            ), (length, places)


def plain_overlap(document, item, window):
    """The best window of the item laid at any place of the document."""
    size = min(window, len(item))
    best = (-1, 0)
    for diagonal in range(-len(item), len(document) + 1):
        equal = [0 <= j + diagonal < len(document) and document[j + diagonal] == t for j, t in enumerate(item)]
        for j in range(len(item) - size + 1):
            best = max(best, (sum(equal[j : j + size]), -diagonal))
    return best[0], size


def test_decontamination_equals_brute_force(spark):
    """Items of every length, laid into documents with as many substitutions as may be, or one more."""
    rng = random.Random(12)
    items = [(i, prose(rng, n)) for i, n in enumerate([*range(1, 21), 33, 47, 7, 10])]
    docs = []
    for i, text in items:
        for extra in (0, 1):
            words = text.split()
            size = min(20, len(words))
            wrong = size - math.ceil(0.8 * size - 1e-9) + extra
            for _ in range(4):
                copy = list(words)
                for place in rng.sample(range(size), min(wrong, size)):
                    copy[place] = f"other{rng.random()}"
                docs.append((len(docs), f"{prose(rng, rng.randint(0, 40))} {' '.join(copy[:size])} {prose(rng, 5)}"))
    docs += [(len(docs) + i, prose(rng, 60)) for i in range(20)]
    want = {}
    for doc, text in docs:
        for item, words in items:
            words = words.split()
            equal, size = plain_overlap(text.split(), words, 20)
            if len(words) >= decontaminate.LEAST_TOKENS and equal >= math.ceil(0.8 * size - 1e-9):
                want[doc, item] = (equal, size)
    found = decontaminate.find_contamination(documents(spark, docs), documents(spark, items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): (r.n_equal, r.n_window) for r in found.collect()} == want
    assert len(want) > 80


def test_decontamination_tolerates_substitutions_and_keeps_the_clean(spark):
    rng = random.Random(5)
    items = [(i, prose(rng, n)) for i, n in enumerate((15, 40, 60, 9))] + [(9, None), (8, "")]
    long_item = items[1][1].split()
    swapped = [("x" if i % 6 == 2 else w) for i, w in enumerate(long_item)]
    half = [("x" if i % 3 == 2 else w) for i, w in enumerate(long_item)]
    docs = [
        (1, f"{prose(rng, 30)} {items[0][1].upper()}, {prose(rng, 5)}"),
        (2, " ".join(swapped)),
        (3, " ".join(half)),
        (4, prose(rng, 3000) + " " + " ".join(long_item[:20]) + "\n" + prose(rng, 50)),
        (5, prose(rng, 200)),
        (6, None), (7, ""), (None, items[2][1]), (1, "again"), (10, items[3][1]),
    ]
    frame = documents(spark, docs).selectExpr("*", "1 as item_id", "'x' as seed", "2 as k1")
    bench = documents(spark, items, "item_id long, text string").selectExpr("*", "0 as doc_id")
    got = {(r.doc_id, r.item_id): (r.n_equal, r.n_window) for r in decontaminate.find_contamination(frame, bench).collect()}
    assert got.keys() == {(1, 0), (2, 1), (4, 1), (None, 2), (10, 3)}
    assert got[1, 0] == (15, 15) and got[4, 1] == (20, 20) and got[2, 1][0] >= 16
    kept = decontaminate.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 5, 6, 7]
    assert decontaminate.find_contamination(frame.limit(0), bench).count() == 0
    assert decontaminate.find_contamination(frame, bench.limit(0)).count() == 0


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in out)


PERSONAL = [
    "mail bob.x@a-b.example.com.", "a@b.c@d.e x@y a@b.c_d@e.f.g +@a.b", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 79927398713", "+1 (988) 555-2485 +44 20 7946 0958 +1 2", "é😀 a@b.co 4111111111111111😀",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789", "the number 123-45-6789", "", None,
    "9" * 3000 + ".1.1.1", "a" * 5000 + "@" + "b." * 3000 + "c", "+1" + " " * 4000 + "5", "0" * 50 + ".1.1.1", "a@b.c\na@b.c", "@@@ a@ @b.c",
]


def test_personal_data_against_plain_patterns(spark):
    rng = random.Random(1)
    alphabet = "a1.@+- ()25é_%\n"
    texts = PERSONAL + ["".join(rng.choice(alphabet) for _ in range(60)) for _ in range(400)]
    frame = documents(spark, list(enumerate(texts))).selectExpr("*", "1 as kind", "2 as start", "3 as value")
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(frame)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        base = plain_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest(), (text, got[i].spans, base)
        assert got[i].n_email == base.count("email") and got[i].n_phone == base.count("phone")
        assert got[i].spans.startswith(base)
    assert got[6].spans.endswith("iban:5:32") and "ssn:4:15" in got[7].spans and got[8].spans == ""
    assert pii.pii_digest(pii.find_pii(frame.limit(0))).count() == 0
    plan = pii.find_pii(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_parts_of_an_address_are_read_whole(spark):
    texts = ["10.0.19041.1", "1234.1.1.1", "0001.1.1.1", "1.1.1.1000 1.2.3.255", "00256.1.1.1", "1.1.1.4294967297"]
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(documents(spark, list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        base = plain_spans(text)
        assert (got[i].spans, got[i].n_ip) == (base, base.count("ip")), text
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()


def test_texts_with_very_many_matches(spark):
    """Offsets across blocks of matches and pieces of text, in time that follows the length."""
    cells = ["4111 1111 1111 1111", "a@b.org", "1.2.3.4", "+49 30 123456789", "12", "é😀"]
    texts = [" , ".join(cells * 1200), "x" * 9000 + " call +49 30 123456789", " , ".join(["17"] * 400_000)]
    begin = time.monotonic()
    frame = documents(spark, list(enumerate(texts)))
    got = {r.doc_id: r for r in pii.pii_digest(pii.find_pii(frame)).collect()}
    assert time.monotonic() - begin < 120
    for i, text in enumerate(texts):
        base = plain_spans(text)
        assert got[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert got[i].n_card == base.count("card")
    spans = pii.find_pii(frame).filter("doc_id = 1").first()["pii"]
    assert [round(s["score"], 2) for s in spans] == [0.95]


def test_found_data_goes_beside_columns_of_any_name(spark):
    frame = documents(spark, [(1, "a@b.org")]).selectExpr("*", "7 as _pii_email", "8 as _PII_pieces", "9 as `a.b`")
    found = pii.find_pii(frame)
    assert found.columns == [*frame.columns, "pii"]
    row = found.first()
    assert (row["_pii_email"], row["_PII_pieces"], row["a.b"], len(row["pii"])) == (7, 8, 9, 1)


SAMPLES = {
    "en": "the house and the garden of that with this from there",
    "de": "der die und das nicht auch über schön groß mit einer",
    "ja": "これは日本語の文です とても良い天気ですね",
}


def test_language_of_held_out_texts(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        lang = rng.choice(sorted(SAMPLES))
        words = SAMPLES[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(2, 30))), lang, i % 4 == 2))
    frame = documents(spark, rows, "doc_id long, text string, lang string, held boolean")
    model = language.train(frame.filter("not held").select("doc_id", "text", "lang"), sample=50)
    found = language.predict(frame.withColumn("score", frame.doc_id), model).collect()
    assert all(r.lang_pred == r.lang and not r.rejected and 0 <= r.score <= 1 for r in found)
    odd = [(1, None), (2, ""), (3, "12 34 !!"), (4, "ξένη γλώσσα"), (5, "the and " * 200_000), (5, "the and " * 200_000)]
    got = sorted((r.doc_id, r.lang_pred, r.rejected) for r in language.predict(documents(spark, odd), model).collect())
    assert got[:3] == [(i, "und", True) for i in (1, 2, 3)]
    assert got[3][2] and got[4:] == [(5, "en", False)] * 2
    nothing = language.train(frame.limit(0).select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.predict(frame, nothing).collect()} == {"und"}


def test_noise_and_languages_never_learned_are_rejected(spark):
    rng = random.Random(8)
    rows = []
    for i in range(400):
        lang = rng.choice(["en", "de"])
        words = SAMPLES[lang].split()
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 3, 8, 40, 200]))), lang))
    rows += [(400 + i, "zq xv jj kw", "en") for i in range(3)]
    frame = documents(spark, rows, "doc_id long, text string, lang string")
    model = language.train(frame)
    kept = language.predict(frame.filter("doc_id < 400"), model)
    assert kept.filter("rejected").count() == 0
    finnish = "suomi on kaunis maa jossa paljon järviä ja metsiä ihmiset puhuvat suomea talvella kylmä lunta".split()
    odd = [(i, " ".join(rng.choice(finnish) for _ in range(n))) for i, n in enumerate([12, 30, 200])]
    for n in (8, 50, 500):
        for letters in ("abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz", "これは日本語"):
            odd.append((len(odd), " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(n))))
    noise = language.predict(documents(spark, odd), model)
    assert noise.filter("not rejected").select("doc_id", "score").collect() == []


@pytest.mark.parametrize("rows", [[], None])
def test_pipeline_on_small_documents(spark, tmp_path, rows):
    rng = random.Random(4)
    item = prose(rng, 30)
    if rows is None:
        shared = prose(rng, 12)
        rows = [(i, f"{prose(rng, 40)}\n{shared}\n{prose(rng, 20)}", "en", "s", 0) for i in range(12)]
        rows += [(50, rows[3][1], "en", "s", 0), (51, f"{prose(rng, 8)} {item}", "en", "s", 0)]
        rows += [(52, None, None, None, None), (53, "", "en", "s", 0), (54, "??", "en", "s", 2), rows[5]]
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    folder = str(tmp_path)
    spark.createDataFrame(rows, columns).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = corpus_pipeline.run(spark, folder).orderBy("doc_id").collect()
    if not rows:
        assert got == []
        return
    assert [r.doc_id for r in got] == list(range(12))
    assert sum(shared in r.text for r in got) == 1 and shared in got[0].text
    assert all(r.n_chars == len(r.text) for r in got if r.doc_id) and all(r.round_trip for r in got)
