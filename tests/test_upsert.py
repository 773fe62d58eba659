from datetime import date, datetime, timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule
from millrace.operators.ids import assign_ids, unordered_ids
from millrace.operators.upsert import (
    AmbiguousSourceError, Merge, ambiguous_keys, plan_changes, upsert,
)
from millrace.session import Scratch

MERGE = Merge(("a", "b"), ("v", "w"), "id", "made", KeyRule({"b": "1900-01-01"}))
TARGET = "id bigint, a string, b date, v string, w int, made timestamp"
SOURCE = "a string, b date, v string, w int"
OLD = datetime(2024, 1, 1)
NEW = datetime(2025, 1, 1, tzinfo=timezone.utc)
DAY, OTHER = date(2000, 1, 1), date(2001, 1, 1)


def made(df):
    return df.withColumn("made", F.year("made"))


def test_update_insert_keep(spark, scratch, rows):
    target = spark.createDataFrame(
        [(1, "x", DAY, "old", 1, OLD), (2, "y", None, "old", 2, OLD), (5, "z", DAY, "kept", 3, OLD)], TARGET
    )
    source = spark.createDataFrame(
        [("x", DAY, "new", None), ("x", DAY, "new", None), ("y", None, None, 9), ("q", OTHER, "n", 1), ("p", None, "n", 2)],
        SOURCE,
    )
    assert rows(made(upsert(target, source, MERGE, NEW, scratch))) == [
        (1, "x", DAY, "new", None, 2024),
        (2, "y", None, None, 9, 2024),
        (5, "z", DAY, "kept", 3, 2024),
        (6, "p", None, "n", 2, 2025),
        (7, "q", OTHER, "n", 1, 2025),
    ]


def test_sentinel_matches_null(spark, scratch, rows):
    target = spark.createDataFrame([(1, "x", date(1900, 1, 1), "old", 1, OLD)], TARGET)
    source = spark.createDataFrame([("x", None, "new", 1)], SOURCE)
    assert rows(upsert(target, source, MERGE, NEW, scratch), "id", "b", "v") == [
        (1, date(1900, 1, 1), "new")
    ]


def test_second_time_changes_nothing(spark, scratch, rows):
    source = spark.createDataFrame([("x", DAY, "v", 1), ("y", None, None, None)], SOURCE)
    once, _ = scratch.write(upsert(spark.createDataFrame([], TARGET), source, MERGE, NEW, scratch))
    changes = plan_changes(once, source, MERGE, datetime.now(timezone.utc), scratch)
    assert (changes.updated_rows, changes.inserted_rows, changes.parts) == (0, 0, [])
    assert rows(upsert(once, source, MERGE, datetime.now(timezone.utc), scratch)) == rows(once)


def test_touched_parts(spark, scratch):
    target = spark.createDataFrame(
        [(1, "x", DAY, "same", 1, OLD), (2, "y", OTHER, "old", 1, OLD)], TARGET
    )
    source = spark.createDataFrame([("x", DAY, "same", 1), ("y", OTHER, "new", 1)], SOURCE)
    changes = plan_changes(target, source, MERGE, NEW, scratch, part=F.year("b").cast("string"))
    assert changes.parts == ["2001"]


def test_ambiguous_source(spark, scratch, rows):
    source = spark.createDataFrame(
        [("x", DAY, "1", 1), ("x", DAY, "2", 1), ("y", DAY, "1", None), ("y", DAY, "1", None),
         ("z", None, "1", 1), ("z", None, None, 1)],
        SOURCE,
    )
    with pytest.raises(AmbiguousSourceError, match="2 keys.*'x'"):
        upsert(spark.createDataFrame([], TARGET), source, MERGE, NEW, scratch)
    assert rows(ambiguous_keys(source, MERGE), "a", "b") == [("x", DAY), ("z", None)]


def test_case_folding(spark, scratch, rows):
    merge = Merge(MERGE.keys, MERGE.update_cols, "id", "made", KeyRule(MERGE.rule.null_sentinels, True))
    target = spark.createDataFrame([(1, "Ann", DAY, "old", 1, OLD)], TARGET)
    source = spark.createDataFrame([("ANN", DAY, "new", 1), ("ann", DAY, "NEW", 1)], SOURCE)
    got = rows(upsert(target, source, merge, NEW, scratch), "id", "a", "v")
    assert [(i, a, v.lower()) for i, a, v in got] == [(1, "Ann", "new")]
    apart = rows(upsert(target, source, MERGE, NEW, scratch), "id", "a")
    assert apart == [(1, "Ann"), (2, "ANN"), (3, "ann")]


def test_many_copies_of_one_key(spark, scratch, rows):
    source = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.lit(DAY).alias("b"), F.lit("v").alias("v"), F.lit(1).alias("w"),
    )
    out = upsert(spark.createDataFrame([], TARGET), source, MERGE, NEW, scratch)
    assert out.count() == 1 + 5000 - 1667
    assert out.filter("a = 'hot'").count() == 1


def test_ids_follow_the_order(spark, scratch):
    df = spark.range(2000).select((F.col("id") * 7919 % 2000).alias("k"))
    got = assign_ids(df, [F.col("k")], "id", 11, scratch).collect()
    assert all(r["id"] == 11 + r["k"] for r in got) and len(got) == 2000


def test_unordered_ids_are_distinct(spark):
    df = spark.range(1000, numPartitions=7).select(F.monotonically_increasing_id().alias("s"))
    got = [r[0] for r in df.select(unordered_ids(F.col("s"), 7, 100)).collect()]
    assert len(set(got)) == 1000 and min(got) == 100 and max(got) < 100 + 1100


names, dates, values = st.sampled_from("xyz"), st.sampled_from([None, DAY]), st.sampled_from([None, "1", "2"])
table = st.dictionaries(st.tuples(names, dates), values, max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table, table)
def test_against_a_model(spark, target, source):
    scratch = Scratch(spark)
    before = spark.createDataFrame(
        [(i, a, b, v, 0, OLD) for i, ((a, b), v) in enumerate(target.items())], TARGET
    )
    batch = spark.createDataFrame([(a, b, v, 0) for (a, b), v in source.items()], SOURCE)
    once, _ = scratch.write(upsert(before, batch, MERGE, NEW, scratch))
    got = {(r["a"], r["b"]): r["v"] for r in once.collect()}
    assert got == {**target, **source} and once.count() == len(got)
    ids = {(r["a"], r["b"]): r["id"] for r in once.collect()}
    assert all(ids[key] == i for i, key in enumerate(target)) and len(set(ids.values())) == len(ids)
    twice = upsert(once, batch, MERGE, datetime.now(timezone.utc), scratch)
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
