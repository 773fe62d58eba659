from datetime import date

from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule
from millrace.operators.keyfilter import LEAST_BITS, MOST_BITS, KeyColumns, filter_bits, key_filters, prune_dimension

BY_NAME = KeyColumns(("who", "born"), ("name", "birth"), KeyRule({"birth": "1900-01-01"}))
BY_PLACE = KeyColumns(("place",), ("town",))


def test_filters_lose_no_key_and_drop_most_others(spark):
    batch = spark.range(3000).select(
        F.concat(F.lit("n"), F.col("id") * 7).alias("who"),
        F.when(F.col("id") % 3 > 0, F.lit(date(1990, 1, 1))).alias("born"),
        F.when(F.col("id") % 2 > 0, F.concat(F.lit("p"), F.col("id") % 40)).alias("place"),
    )
    filters = key_filters(batch, {"name": BY_NAME, "place": BY_PLACE}, 3000)
    people = spark.range(60_000).select(
        F.concat(F.lit("n"), F.col("id")).alias("name"),
        F.when(F.col("id") % 21 > 0, F.lit(date(1990, 1, 1)))
        .when(F.col("id") % 42 > 0, F.lit(date(1900, 1, 1))).alias("birth"),
    )
    kept = prune_dimension(people, filters["name"], BY_NAME)
    assert 3000 <= kept.count() < 4500
    rule = BY_NAME.rule
    wanted = batch.select(*[k.alias(n) for k, n in zip(rule.columns(batch, ["who", "born"], ["name", "birth"]), "ab")])
    met = kept.select(*[k.alias(n) for k, n in zip(rule.columns(kept, ["name", "birth"]), "ab")])
    assert wanted.join(met, ["a", "b"], "left_anti").count() == 0
    towns = spark.range(5000).select(F.concat(F.lit("p"), F.col("id")).alias("town"))
    found = {r[0] for r in prune_dimension(towns, filters["place"], BY_PLACE).collect()}
    assert {f"p{i}" for i in range(1, 40, 2)} <= found and len(found) < 100


def test_an_empty_batch_keeps_nothing(spark):
    batch = spark.createDataFrame([], "who string, born date, place string")
    found = key_filters(batch, {"place": BY_PLACE}, 0)["place"]
    assert prune_dimension(spark.createDataFrame([("x",)], "town string"), found, BY_PLACE).count() == 0


def test_size_is_bounded():
    assert filter_bits(0) == LEAST_BITS and filter_bits(10**12) == MOST_BITS and filter_bits(10_000) == 18


def test_a_full_filter_loses_nothing(spark):
    batch = spark.range(200_000).select(F.col("id").cast("string").alias("place"))
    few = key_filters(batch, {"place": BY_PLACE}, 1)["place"]
    towns = spark.range(0, 200_000, 997).select(F.col("id").cast("string").alias("town"))
    assert prune_dimension(towns, few, BY_PLACE).count() == towns.count()
