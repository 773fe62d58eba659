from datetime import date
from decimal import Decimal
from functools import reduce

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.quality import Rule, evaluate_rules, reject_rows, valid_rows
from millrace.plans import claims as c

SCHEMA = (
    "n bigint, PatientID bigint, ProviderID bigint, AmountBilled decimal(18,2), "
    "AmountPaid decimal(18,2), Status string, DateSubmitted date, DatePaid date"
)
DAY = date(2025, 10, 3)


def row(n, patient=1, provider=1, billed="100.00", paid="50.00", status="Paid", sent=DAY, settled=DAY):
    def money(x):
        return None if x is None else Decimal(x)

    return (n, patient, provider, money(billed), money(paid), status, sent, settled)


def rejects(df):
    gate, rules = c.unresolved_rule(), c.claim_rules()
    return reject_rows(evaluate_rules(df, gate, rules), gate, rules)


def codes(spark, *data):
    got = rejects(spark.createDataFrame(list(data), SCHEMA)).select("n", "RuleCode").collect()
    return sorted((r[0], r[1]) for r in got)


def test_each_rule(spark):
    assert codes(
        spark,
        row(0),
        row(1, billed="-1.00", paid=None),
        row(2, paid="-0.01"),
        row(3, paid="100.01"),
        row(4, settled=date(2025, 9, 28)),
        row(5, status="Complete"),
        row(6, status="sUbMiTtEd", paid=None, settled=None),
        row(7, billed="0.00", paid="0.00"),
    ) == [(1, "NEGATIVE_AMOUNT"), (2, "NEGATIVE_AMOUNT"), (3, "OVERPAID"), (4, "DATE_ORDER"), (5, "BAD_STATUS")]


def test_a_row_can_break_several_rules(spark):
    bad = row(1, billed="-250.00", paid="0.00", status="?", settled=date(2000, 1, 1))
    assert [code for _, code in codes(spark, bad)] == [
        "BAD_STATUS", "DATE_ORDER", "NEGATIVE_AMOUNT", "OVERPAID",
    ]


def test_unresolved_rows_meet_no_other_rule(spark, rows):
    data = [row(1, patient=None, status="?"), row(2, provider=None), row(3, None, None, billed="-1.00")]
    got = rejects(spark.createDataFrame(data, SCHEMA))
    assert rows(got, "n", "RuleCode", "Reason") == [
        (1, "FK_NOT_FOUND", "Could not resolve Patient from natural keys."),
        (2, "FK_NOT_FOUND", "Could not resolve Provider from natural keys."),
        (3, "FK_NOT_FOUND", "Could not resolve Patient Provider from natural keys."),
    ]


def test_nulls_neither_reject_nor_accept(spark):
    data = [
        row(1, billed=None), row(2, status=None), row(3, sent=None), row(4, paid=None), row(5, settled=None),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rejects(df).count() == 0
    evaluated = c.evaluate_claims(df)
    assert sorted(r["n"] for r in valid_rows(evaluated, ["AmountBilled", "Status", "DateSubmitted"]).collect()) == [4, 5]


def test_copies_of_rejects_are_kept(spark):
    assert codes(spark, row(1, status="x"), row(1, status="x")) == [(1, "BAD_STATUS")] * 2


def test_rules_without_gate(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (None,)], "n bigint")
    rules = [Rule("BIG", F.col("n") > 1, F.lit("big")), Rule("ANY", F.col("n") > 0, F.lit("any"))]
    out = evaluate_rules(df, None, rules)
    assert rows(reject_rows(out, None, rules), "n", "RuleCode") == [(1, "ANY"), (2, "ANY"), (2, "BIG")]
    assert rows(valid_rows(out)) == [(None,)]


amounts = st.sampled_from([None, "-1.00", "0.00", "5.00", "7.50"])
days = st.sampled_from([None, date(2025, 1, 1), date(2025, 1, 2)])
ids = st.sampled_from([None, 1, 2])
claims = st.lists(
    st.tuples(ids, ids, amounts.filter(bool), amounts, st.sampled_from(["PAID", "paid", "x"]),
              days.filter(bool), days),
    min_size=1, max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(claims)
def test_one_pass_equals_one_scan_per_rule(spark, data):
    df = spark.createDataFrame([row(i, *values) for i, values in enumerate(data)], SCHEMA)
    gate, rules = c.unresolved_rule(), c.claim_rules()
    found = df.filter("PatientID IS NOT NULL AND ProviderID IS NOT NULL")
    scans = [df.filter(gate.broken).select("n", F.lit(gate.code).alias("RuleCode"))] + [
        found.filter(r.broken).select("n", F.lit(r.code).alias("RuleCode")) for r in rules
    ]
    want = sorted(map(tuple, reduce(DataFrame.unionAll, scans).collect()))
    evaluated = c.evaluate_claims(df)
    got = sorted(map(tuple, reject_rows(evaluated, gate, rules).select("n", "RuleCode").collect()))
    assert got == want
    valid = {r["n"] for r in valid_rows(evaluated).collect()}
    assert valid.isdisjoint(n for n, _ in want)
    assert valid | {n for n, _ in want} == set(range(len(data)))
