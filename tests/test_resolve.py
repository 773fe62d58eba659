import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule, key_hash
from millrace.operators.resolve import fk_violations, resolve_keys

UNKNOWN = date(1900, 1, 1)
ON = [("who", "name"), ("born", "birth")]
RULE = KeyRule({"birth": "1900-01-01"})


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "ann", date(1990, 1, 1)), (2, "ben", None), (3, "cy", UNKNOWN), (4, None, UNKNOWN)],
        "id bigint, name string, birth date",
    )


@pytest.fixture
def visits(spark):
    return spark.createDataFrame(
        [
            (0, "ann", date(1990, 1, 1)), (1, "ann", None), (2, "ben", None), (3, "ben", UNKNOWN),
            (4, "cy", None), (5, "zoe", None), (6, None, None), (7, "ann", date(1990, 1, 1)),
            (8, "ANN", date(1990, 1, 1)),
        ],
        "n bigint, who string, born date",
    )


def test_left_keeps_unresolved_rows(visits, people, rows):
    got = resolve_keys(visits, people, ON, "id", rule=RULE)
    assert got.columns == ["n", "who", "born", "id"]
    assert rows(got, "n", "id") == [
        (0, 1), (1, None), (2, 2), (3, 2), (4, 3), (5, None), (6, None), (7, 1), (8, None),
    ]


def test_inner_drops_them(visits, people, rows):
    assert rows(resolve_keys(visits, people, ON, "id", "inner", RULE), "n", "id") == [
        (0, 1), (2, 2), (3, 2), (4, 3), (7, 1),
    ]


def test_without_sentinel_null_matches_nothing(visits, people, rows):
    got = resolve_keys(visits, people, ON, "id", "inner")
    assert rows(got, "n", "id") == [(0, 1), (7, 1)]


def test_case_is_folded_on_request(visits, people, rows):
    got = resolve_keys(visits, people, ON, "id", "inner", KeyRule(RULE.null_sentinels, fold_case=True))
    assert (8, 1) in rows(got, "n", "id")


def test_other_join_types_are_refused(visits, people):
    with pytest.raises(ValueError):
        resolve_keys(visits, people, ON, "id", "full")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_path_gives_the_same_rows(spark, rows, how):
    """A third of the rows has one key, another part a NULL key, another an unknown one."""
    pick = random.Random(5)
    kinds = ["hot"] * 4 + [None] * 2 + ["missing"] * 2 + [f"k{i}" for i in range(40)]
    fact = spark.createDataFrame(
        [(i, pick.choice(kinds), 7) for i in range(600)], "n bigint, who string, same int"
    )
    dim = spark.createDataFrame([(1, "hot")] + [(i + 2, f"k{i}") for i in range(0, 40, 2)], "id bigint, name string")
    on = [("who", "name")]
    hashes = [
        r[0]
        for r in fact.filter("who in ('hot', 'missing', 'k2') or who is null")
        .select(key_hash([F.col("who")])).distinct().collect()
    ]
    want = resolve_keys(fact, dim, on, "id", how)
    got = resolve_keys(fact, dim, on, "id", how, hot=hashes, spread_by=F.col("n"))
    assert rows(got) == rows(want)


def test_hot_rows_are_spread_over_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fact = spark.range(3000).select("id", F.when(F.col("id") >= 0, "hot").alias("who"))
        dim = spark.createDataFrame([(1, "hot"), (2, "cold")], "key bigint, name string")
        hot = [r[0] for r in dim.filter("key = 1").select(key_hash([F.col("name")])).collect()]

        def largest(df):
            sizes = df.groupBy(F.spark_partition_id()).count().collect()
            return max(r["count"] for r in sizes)

        on = [("who", "name")]
        assert largest(resolve_keys(fact, dim, on, "key")) == 3000
        spread = resolve_keys(fact, dim, on, "key", hot=hot, spread_by=F.col("id"))
        assert largest(spread) < 1500
        assert spread.filter("key = 1").count() == 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_hot_keys_need_a_spread(visits, people):
    with pytest.raises(ValueError, match="spread_by"):
        resolve_keys(visits, people, ON, "id", hot=[1])


def test_foreign_keys(spark, people, rows):
    fact = spark.createDataFrame([(1,), (9,), (9,), (None,), (8,)], "ref bigint")
    assert rows(fk_violations(fact, people, "ref", "id")) == [(8, 1), (9, 2)]
