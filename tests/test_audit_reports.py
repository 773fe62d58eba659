from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

import pytest

from millrace.plans import reports
from millrace.plans.audit import COUNT_COLUMNS, RunAudit


@pytest.fixture
def audit(spark, tmp_path):
    return RunAudit(spark, str(tmp_path / "runs"))


def run(audit, run_id):
    return audit.runs().filter(f"RunID = {run_id}").first().asDict()


def test_a_run(audit):
    run_id = audit.start_run()
    assert run_id == 1
    opened = run(audit, 1)
    assert opened["StartedAt"] and opened["EndedAt"] is None and opened["Status"] is None
    assert all(opened[c] is None for c in COUNT_COLUMNS)
    audit.update_run_counts(1, {"provider": 8, "claim": 13}, {"patient": 10}, 6)
    audit.finish_run(1, "SUCCESS")
    closed = run(audit, 1)
    assert [closed[c] for c in COUNT_COLUMNS] == [8, 0, 13, 0, 10, 0, 6]
    assert closed["Status"] == "SUCCESS" and closed["EndedAt"] >= closed["StartedAt"]
    assert audit.start_run() == 2


def test_failed_run_has_no_counts_and_a_retry_starts_afresh(audit):
    audit.start_run(7)
    audit.finish_run(7, "FAILED")
    failed = run(audit, 7)
    assert failed["Status"] == "FAILED" and failed["EndedAt"] and failed["ClaimCount"] is None
    audit.start_run(7)
    assert run(audit, 7)["Status"] is None
    audit.finish_run(7, "PARTIAL")
    assert run(audit, 7)["Status"] == "PARTIAL"
    assert audit.runs().count() == 1
    assert audit.start_run() == 8


def test_starters_at_the_same_time_get_ids_of_their_own(spark, audit, tmp_path):
    def start(_):
        return RunAudit(spark, str(tmp_path / "runs")).start_run()

    with ThreadPoolExecutor(4) as threads:
        ids = list(threads.map(start, range(8)))
    assert len(set(ids)) == 8 and audit.runs().count() == 8
    assert audit.start_run() > max(ids)


def test_the_highest_id_comes_from_names(audit, monkeypatch):
    audit.start_run(41)
    monkeypatch.setattr(audit, "path", "/nowhere")
    assert audit._highest_id() == 41


def test_unknown_status(audit):
    with pytest.raises(ValueError):
        audit.finish_run(1, "DONE")


@pytest.fixture
def rejects(spark):
    t = datetime(2025, 1, 2, 12, tzinfo=timezone.utc)
    return spark.createDataFrame(
        [(1, t, "A"), (1, t - timedelta(hours=24), "A"), (2, t - timedelta(hours=25), "A"), (2, t, "B"),
         (2, t + timedelta(seconds=1), "B")],
        "RunID bigint, IngestedAt timestamp, RuleCode string",
    )


def test_reject_reports(rejects, rows):
    assert rows(reports.rejects_by_date_and_rule(rejects)) == [
        (date(2025, 1, 1), "A", 2), (date(2025, 1, 2), "A", 1), (date(2025, 1, 2), "B", 2),
    ]
    assert rows(reports.rejects_by_run_and_rule(rejects)) == [(1, "A", 2), (2, "A", 1), (2, "B", 2)]
    assert reports.rejects_of_run(rejects, 2).count() == 3
    day = reports.rejects_in_last_day(rejects, datetime(2025, 1, 2, 12, tzinfo=timezone.utc))
    assert [tuple(r) for r in day.collect()] == [("A", 2), ("B", 1)]


def test_ingest_date_is_utc_in_any_session(spark, rejects, rows):
    want = rows(reports.rejects_by_date_and_rule(rejects))
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
    try:
        assert rows(reports.rejects_by_date_and_rule(rejects)) == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_latest_runs_is_a_top_k(spark):
    runs = spark.range(60).withColumnRenamed("id", "RunID")
    latest = reports.latest_runs(runs)
    assert [r[0] for r in latest.collect()] == list(range(59, 9, -1))
    assert "TakeOrderedAndProject" in latest._jdf.queryExecution().executedPlan().toString()
