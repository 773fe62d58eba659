from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions.coerce import coerce_types, to_date, to_decimal, vote_date_patterns
from millrace.functions.text import WHITESPACE, strip_text


def coerce(spark, values, target, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    out = coerce_types(df, {"v": target, "absent": "str"}, **options).orderBy("i")
    return [r["v"] for r in out.collect()]


def test_dates_need_the_whole_text_to_match(spark):
    cases = {
        "2025-10-02": date(2025, 10, 2),
        "2025-1-6": date(2025, 1, 6),
        "2025-10-02 (late)": None,
        "2025": None,
        "2025-10-05 13:00:00": None,
        " 2025-10-06": None,
        "2025-10-06 ": None,
        "2025-02-30": None,
        "2025/10/02": None,
        "20251002": None,
        "": None,
        "1600-01-01": date(1600, 1, 1),
        "9999-12-31": date(9999, 12, 31),
    }
    assert coerce(spark, [*cases, None], "date") == [*cases.values(), None]


def test_nanosecond_dates_on_request(spark):
    cases = {
        "1500-01-01": None,
        "1677-09-21": None,
        "1677-09-22": date(1677, 9, 22),
        "2262-04-11": date(2262, 4, 11),
        "2262-04-12": None,
    }
    assert coerce(spark, list(cases), "date", nanoseconds=True) == list(cases.values())


def test_date_pattern_and_timestamps(spark):
    assert coerce(spark, ["05.10.2025"], "date", date_pattern="dd.MM.yyyy") == [date(2025, 10, 5)]
    assert coerce(spark, ["2025-1-6", "x"], "datetime64[ns]") == [datetime(2025, 1, 6), None]


def test_money(spark):
    cases = {
        "250.00": Decimal("250.00"), "1e3": Decimal("1000.00"), " 12 ": Decimal("12.00"),
        "\t7": Decimal("7.00"), "-3.5": Decimal("-3.50"), "+5": Decimal("5.00"), ".5": Decimal("0.50"),
        "5.": Decimal("5.00"), "0.005": Decimal("0.01"), "2.675": Decimal("2.68"),
        "1,000": None, "abc": None, "$5": None, "": None, "1.5d": None, "1_000": None, "0x10": None,
        "inf": None, "nan": None, "1e400": None,
    }
    assert coerce(spark, [*cases, None], "decimal(18,2)") == [*cases.values(), None]


def test_money_out_of_range_stops_the_load(spark):
    with pytest.raises(Exception, match="out of range"):
        coerce(spark, ["99999999999999999999"], "decimal(18,2)")


def test_floats(spark):
    cases = {"1.5": 1.5, "1e3": 1000.0, " 2 ": 2.0, "inf": float("inf"), "-Infinity": float("-inf"),
             "1.5d": None, "1.5f": None, "nan": None, "x": None, "1e400": None}
    assert coerce(spark, [*cases, None], "float") == [*cases.values(), None]


def test_whole_numbers(spark):
    cases = {"3": 3, "3.0": 3, "1e3": 1000, " 4 ": 4, "x": None, "": None,
             "9223372036854775807": 9223372036854775807}
    assert coerce(spark, [*cases, None], "int") == [*cases.values(), None]


@pytest.mark.parametrize("text", ["3.7", "9223372036854775808", "inf"])
def test_numbers_that_are_not_whole_stop_the_load(spark, text):
    with pytest.raises(Exception, match="whole number"):
        coerce(spark, [text], "int")


def test_text(spark):
    values = [" a b ", "\t\nx\r\n", "  y　", "", None]
    assert coerce(spark, values, "str") == ["a b", "x", "y", "", None]
    assert coerce(spark, values, "anything else") == ["a b", "x", "y", "", None]
    assert coerce(spark, [None, "a"], "str", null_text="nan") == ["nan", "a"]


def test_strip_removes_what_python_strips(spark):
    padded = f"{WHITESPACE}mid {WHITESPACE}dle{WHITESPACE}"
    got = spark.range(1).select(strip_text(F.lit(padded))).first()[0]
    assert got == padded.strip()
    assert all(c.isspace() for c in WHITESPACE)


def test_all_columns_in_one_projection(spark):
    df = spark.createDataFrame([("1", " a ", "2025-01-01", "z")], "n string, t string, d string, o string")
    out = coerce_types(df, {"n": "int", "t": "str", "d": "date"})
    assert out.columns == df.columns
    assert tuple(out.first()) == (1, "a", date(2025, 1, 1), "z")
    assert [f.dataType.simpleString() for f in out.schema] == ["bigint", "string", "date", "string"]


def test_patterns_are_voted_on(spark):
    raw = [("1.2.2024", "2/1/2024", "x"), ("13.2.2024", "2024-01-02", None), ("2024-02-14", "2024-01-03", ""), (None, None, "y")]
    df = spark.createDataFrame(raw, "a string, b string, c string")
    patterns = ["yyyy-M-d", "d.M.yyyy", "M/d/yyyy"]
    found = vote_date_patterns(df, ["a", "b", "c"], patterns)
    assert found == {"a": "d.M.yyyy", "b": "yyyy-M-d", "c": "yyyy-M-d"}
    got = coerce_types(df, {"a": "date", "b": "datetime64[ns]"}, date_pattern=found)
    assert sum(r["a"] is not None for r in got.collect()) == 2
    assert got.schema["b"].dataType.typeName() == "timestamp"
    assert vote_date_patterns(df.limit(0), ["a"], patterns) == {"a": "yyyy-M-d"}


def test_common_spellings_read_like_the_others(spark):
    """The short way for what a cast spells the same gives what the patterns give."""
    dates = ["2023-02-28", "2023-02-30", "2024-2-9", " 2023-02-28", "2023-02-28 ", "0000-01-01", "0001-01-01",
             "9999-12-31", "+10000-01-01", "-0001-01-01", "2023-02", "2023", "", "x", "2023-02-28T10", None]
    df = spark.createDataFrame([(d,) for d in dates], "d string")
    found = df.select(to_date(F.col("d")).alias("a"), F.try_to_date("d", "yyyy-M-d").alias("b"))
    assert found.filter(~F.col("a").eqNullSafe(F.col("b"))).count() == 0
    numbers = ["1.50", "-1.50", "1.5", "1.505", "+1.50", " 1.50", "1e2", "1.50d", "00.50", ".50", "", "abc", "NaN", "0.00", None]
    df = spark.createDataFrame([(n,) for n in numbers], "n string")
    got = [r[0] for r in df.select(to_decimal(F.col("n"), 18, 2).cast("string")).collect()]
    assert got == ["1.50", "-1.50", "1.50", "1.51", "1.50", "1.50", "100.00", None, "0.50", "0.50", None, None, None, "0.00", None]
    assert "CAST" in df.select(to_decimal(F.col("n"), 18, 2))._jdf.queryExecution().toString().upper()


def test_common_dates_do_not_go_through_the_pattern(spark):
    """A pattern that fails on everything else shows which way a date took."""
    plan = spark.range(1).select(F.col("id").cast("string").alias("d")).select(to_date(F.col("d")))
    assert "as date) as string) = " in plan._jdf.queryExecution().optimizedPlan().toString().lower()
