"""Shapes of physical plans that results do not show."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.keyfilter import key_filters
from millrace.operators.upsert import apply_changes, key_fingerprints, one_row_per_key, plan_changes
from millrace.plans import claims as c
from millrace.plans import reports
from millrace.session import Scratch
from verification import inputs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled(spark):
    """No broadcasts and no re-planning: the plan for tables that are all large."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.enabled")


@pytest.fixture
def tables(spark, tmp_path):
    def stored(spec):
        path = str(tmp_path / spec.name)
        spark.createDataFrame([], spec.schema).write.mode("ignore").parquet(path)
        return spark.read.schema(spec.schema).parquet(path)

    return stored


class Recorded(Scratch):
    """A scratch folder that keeps the plans of what is written to it."""

    def __init__(self, spark):
        super().__init__(spark)
        self.plans = []

    def write(self, df, metrics=None):
        self.plans.append(plan(df))
        return super().write(df, metrics)


def test_a_merge_moves_batch_and_target_once(spark, shuffled, tables):
    scratch = Recorded(spark)
    month = c.submit_month(F.col("DateSubmitted"))
    changes = plan_changes(
        tables(c.CLAIM), tables(c.STG_CLAIM).selectExpr(
            "1L as PatientID", "2L as ProviderID", "AmountBilled", "AmountPaid", "Status", "DateSubmitted", "DatePaid"
        ), c.CLAIM_MERGE, datetime(2024, 1, 1), scratch, 1, month,
    )
    merged = scratch.plans[0]
    assert len(re.findall(r"FileScan", merged)) == 2 and "FullOuter" in merged
    assert len(re.findall(r"Exchange", merged)) == 2 and "Aggregate" not in merged
    # The new content comes from the written merge alone.
    assert "Join" not in plan(apply_changes(changes)) and "Exchange" not in plan(apply_changes(changes))


def test_batches_are_checked_without_a_sort(shuffled, tables):
    merge = c.patient_merge()
    staged = tables(c.STG_PATIENT)
    for df in (key_fingerprints(staged, merge), one_row_per_key(staged, merge, copies=1)):
        text = plan(df)
        assert len(re.findall(r"HashAggregate", text)) == 2 and len(re.findall(r"Exchange", text)) == 1
        assert "Sort" not in text
    assert "Gender" not in re.search(r"Exchange hashpartitioning.*", plan(key_fingerprints(staged, merge)))[0]
    assert "Aggregate" not in plan(one_row_per_key(staged, merge, copies=0))


def test_dimensions_are_cut_down_before_they_move(spark, shuffled, tables):
    staged = tables(c.STG_CLAIM)
    filters = key_filters(staged, c.key_probes(), 0)
    text = plan(c.resolve_claims(staged, tables(c.PATIENT), tables(c.PROVIDER), filters=filters))
    assert len(re.findall(r"FileScan", text)) == 3 and len(re.findall(r"Exchange", text)) == 4
    # Read upwards from each scan: the filter comes before the first exchange.
    scans = re.split(r"FileScan", text)[:-1]
    assert sum("getbit" in scan[scan.rindex("Exchange"):] for scan in scans) == 2


def test_rules_need_one_pass_and_rejects_no_shuffle(shuffled, tables):
    resolved = c.resolve_claims(tables(c.STG_CLAIM), tables(c.PATIENT), tables(c.PROVIDER))
    text = plan(c.evaluate_claims(resolved))
    assert len(re.findall(r"SortMergeJoin", text)) == 2
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4
    assert len(re.findall(r"FileScan", text)) == 3
    evaluated = tables(c.STG_CLAIM).withColumns(
        {"PatientID": F.col("AmountBilled").cast("bigint"), "ProviderID": F.col("AmountPaid").cast("bigint")}
    )
    assert "Exchange" not in plan(c.rejected_claims(c.evaluate_claims(evaluated)))


def test_lookups_read_keys_and_id_only(shuffled, tables):
    text = plan(c.resolve_claims(tables(c.STG_CLAIM), tables(c.PATIENT), tables(c.PROVIDER)))
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*)", text)
    assert any("FirstName" in s and "Gender" not in s and "CreatedAt" not in s for s in schemas)
    assert all("Specialty" not in s for s in schemas)


def test_hot_rows_are_routed_by_row(shuffled, tables):
    claims = tables(c.STG_CLAIM).withColumn("n", F.monotonically_increasing_id())
    resolved = c.resolve_claims(
        claims, tables(c.PATIENT), tables(c.PROVIDER), hot={"patient": [1], "provider": [2, 3]},
        spread_by=F.col("n"),
    )
    text = plan(resolved)
    assert len(re.findall(r"Exchange hashpartitioning\([^)]*_route", text)) >= 2
    assert len(re.findall(r"BroadcastExchange", text)) == 2


def test_reports_combine_before_the_shuffle(shuffled, tables):
    rejects = tables(c.REJECT_CLAIM)
    for report in (reports.rejects_by_date_and_rule, reports.rejects_by_run_and_rule):
        text = plan(report(rejects))
        assert len(re.findall(r"Exchange", text)) == 1 and "partial_count" in text
        assert "Reason" not in re.search(r"ReadSchema: ([^\n]*)", text)[1]


def test_claims_are_shuffled_without_text_and_providers_have_a_size(shuffled, tmp_path, spark):
    kinds = {
        "lineitem": "l_orderkey bigint, l_suppkey bigint, l_extendedprice double, l_discount double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp",
        "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
        "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
        "nation": "n_nationkey int, n_name string, n_regionkey int",
        "region": "r_regionkey int, r_name string",
    }
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    text = plan(inputs.claims(spark, str(tmp_path)))
    moved = re.search(r"Exchange hashpartitioning\(l_orderkey[^\n]*\n[^\n]*Project \[([^\n]*)\]", text)[1]
    assert "AmountBilled" in moved and "l_returnflag" not in moved.split(" AS ")[-1]
    assert len(re.findall(r"Exchange hashpartitioning\(o_custkey", text)) == 1
    assert "Join" not in plan(inputs.providers(spark, str(tmp_path)))
