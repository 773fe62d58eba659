"""Whole runs over small feeds in the wrapped form: every value of a line in one quoted field."""

import re
from datetime import date
from decimal import Decimal

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.plans import claims as c
from millrace.plans import pipeline, reports
from millrace.plans.audit import COUNT_COLUMNS
from millrace.plans.pipeline import ClaimsWarehouse, Options

# Each claim is here for one reason, named beside it.
PROVIDERS = ["Ulm Dental,South,Teeth", "Kiel Eyes,North,Eyes", "Jena Bones,East,Bones", "Ulm Dental,East,Teeth"]
PATIENTS = [
    "Nils,Arp,1961-12-31,M", "Vera,Bock,2010-03-01,F", "Nils,Bock,1961-12-31,X", "Ute,Cron,1945-05-08,F",
    "Tom,Dorn,1999-02-28,M",
]
CLAIMS = [
    "Vera,Bock,2010-03-01,Kiel Eyes,North,12.50,,submitted,2024-02-29,",  # valid, not paid, other case
    "Vera,Bock,2010-03-01,Kiel Eyes,North,12.51,12.51,PAID,2024-02-29,2024-02-29",  # valid, paid that day
    "Ute,Cron,1945-05-08,Jena Bones,East,0.00,0.00,Rejected,2023-12-31,",  # valid, nothing billed
    "Nils,Arp,1961-12-31,Ulm Dental,East,99.90,45.00,Paid,2024-01-15,2024-04-01",  # valid, paid in part
    "Nils,Bock,1961-12-31,Ulm Dental,South,99.90,45.00,Paid,2024-01-15,2024-04-01",  # valid, other people
    "Tom,Dorn,1999-02-28,Kiel Eyes,South,70.00,0.00,Paid,2024-03-03,2024-03-04",  # no such provider
    "Tim,Dorn,1999-02-28,Kiel Eyes,North,71.00,0.00,Paid,2024-03-03,2024-03-04",  # no such patient
    "Tom,Dorn,1999-02-28,Jena Bones,East,-1.00,-5.00,Paid,2024-03-05,2024-03-06",  # negative
    "Ute,Cron,1945-05-08,Ulm Dental,South,20.00,20.01,Paid,2024-02-02,2024-02-01",  # overpaid, before it was sent
    "Ute,Cron,1945-05-08,Ulm Dental,South,21.00,21.00,Closed,2024-02-02,2024-02-03",  # status
    "Nils,Arp,1961-12-31,Jena Bones,East,30.00,10.00,Paid,2024-02-02,2024-02-30",  # valid, a day that is none
]
GOOD, NO_PROVIDER, NO_PATIENT, NEGATIVE, BAD_STATUS = CLAIMS[0], CLAIMS[5], CLAIMS[6], CLAIMS[7], CLAIMS[9]
HEADERS = {
    "providers": c.STG_PROVIDER.columns, "patients": c.STG_PATIENT.columns, "claims": c.STG_CLAIM.columns,
}


@pytest.fixture
def write(tmp_path):
    def to_files(claims=CLAIMS, patients=PATIENTS, providers=PROVIDERS):
        feeds = {}
        for name, lines in (("providers", providers), ("patients", patients), ("claims", claims)):
            path = tmp_path / f"{name}.csv"
            quoted = [f'"{line}"' for line in [",".join(HEADERS[name]), *lines]]
            path.write_bytes("\r\n".join(quoted).encode() + b"\r\n")
            feeds[name] = str(path)
        return feeds

    return to_files


@pytest.fixture
def house(spark, tmp_path):
    return ClaimsWarehouse(spark, str(tmp_path / "warehouse"))


def by_rule(house, run_id):
    found = house.rejects().filter(f"RunID = {run_id}").groupBy("RuleCode").count().collect()
    return {r["RuleCode"]: r["count"] for r in found}


def counts(house, run_id):
    row = house.audit.runs().filter(f"RunID = {run_id}").first()
    return (
        row["Status"], row["StgProviderCount"], row["StgPatientCount"], row["StgClaimCount"],
        row["ProviderCount"], row["PatientCount"], row["ClaimCount"], row["RejectTotal"],
    )


EXPECTED = {"FK_NOT_FOUND": 2, "NEGATIVE_AMOUNT": 1, "OVERPAID": 1, "DATE_ORDER": 1, "BAD_STATUS": 1}
LOADED = (4, 5, 11, 4, 5, 6, 6)


def test_first_and_second_run(house, write, rows, capsys):
    result = house.run(write()).first()
    message = "Run 1 complete. Final Claim rows: 6. Rejects this run: 6"
    assert tuple(result) == (1, "SUCCESS", 6, 6, message) and message in capsys.readouterr().out
    assert counts(house, 1) == ("SUCCESS", *LOADED)
    assert by_rule(house, 1) == EXPECTED
    assert house.providers().count() == 4 and house.patients().count() == 5
    claims, patients = rows(house.claims()), rows(house.patients())
    assert len(claims) == 6
    reasons = {r["Reason"]: r for r in house.rejects().filter("RuleCode = 'FK_NOT_FOUND'").collect()}
    assert reasons.keys() == {f"Could not resolve {who} from natural keys." for who in ("Patient", "Provider")}
    fk = reasons["Could not resolve Provider from natural keys."]
    assert fk["ResolvedPatientID"] is not None and fk["ResolvedProviderID"] is None
    assert fk["DatePaid"] == date(2024, 3, 4) and fk["AmountBilled"] == Decimal("70.00")
    started, ended = house.audit.runs().select("StartedAt", "EndedAt").first()
    assert started <= ended

    house.run(write())
    assert counts(house, 2) == ("SUCCESS", *LOADED)
    assert rows(house.claims()) == claims and rows(house.patients()) == patients
    assert by_rule(house, 2) == EXPECTED and house.rejects().count() == 12
    assert house.rejects().select("RejectID").distinct().count() == 12
    assert {r["RunID"] for r in house.rejects_of_run(2).collect()} == {2}
    assert house.rejects_of_run(2).count() == 6 and house.rejects_of_run(3).count() == 0
    # An unchanged batch writes no new version of a table.
    assert set(house.tables.state(c.CLAIM).versions.values()) == {1}
    assert set(house.tables.state(c.PROVIDER).versions.values()) == {1}


def test_updates_and_late_dimensions(house, write, spark):
    house.run(write())
    before = {r["ClaimID"]: r for r in house.claims().collect()}
    changed = [GOOD.replace("12.50,,submitted,2024-02-29,", "12.50,12.00,Paid,2024-02-29,2024-03-20"), *CLAIMS[1:]]
    extra = "Tom,Dorn,1999-02-28,Kiel Eyes,North,5.00,4.00,Paid,2024-02-10,2024-02-09"
    house.run(write([*changed, extra], providers=[*PROVIDERS, "Kiel Eyes,South,New"]))
    after = {r["ClaimID"]: r for r in house.claims().collect()}
    assert len(after) == 7 and set(before) < set(after)
    assert by_rule(house, 2) == {**EXPECTED, "FK_NOT_FOUND": 1, "DATE_ORDER": 2}
    assert all(after[i]["CreatedAt"] == before[i]["CreatedAt"] for i in before)
    differing = [i for i in before if after[i] != before[i]]
    assert len(differing) == 1
    row = after[differing[0]]
    assert (row["AmountPaid"], row["Status"], row["DatePaid"]) == (Decimal("12.00"), "Paid", date(2024, 3, 20))
    assert house.providers().filter("ProviderID = 5").first()["Region"] == "South"
    # Months without a change keep their files.
    assert house.tables.state(c.CLAIM).versions == {"2023-12": 1, "2024-01": 1, "2024-02": 2, "2024-03": 2}


def test_a_changed_patient_rewrites_one_bucket(house, write, spark, tmp_path):
    house.run(write())
    before = dict(house.tables.state(c.PATIENT).versions)
    assert len(before) > 1 and set(before.values()) == {1}
    people = {r["PatientID"]: r for r in house.patients().collect()}
    house.run(write(patients=[*PATIENTS[:3], PATIENTS[3].replace(",F", ",X"), PATIENTS[4]]))
    after = house.tables.state(c.PATIENT).versions
    assert sorted(after.values()) == [1] * (len(before) - 1) + [2]
    changed = [i for i, r in people.items() if r not in house.patients().collect()]
    assert len(changed) == 1 and people[changed[0]]["FirstName"] == "Ute"
    assert set(house.tables.state(c.PROVIDER).versions.values()) == {1}
    # The number of buckets stays what it was, and a smaller batch reads its own buckets only.
    again = ClaimsWarehouse(spark, house.tables.root, buckets=3)
    assert again.buckets == house.buckets
    again.run(write(patients=PATIENTS[:1], claims=CLAIMS[3:4]))
    assert again.patients().count() == 5 and sorted(again.tables.state(c.PATIENT).versions.values()) == sorted(after.values())


def test_retry_of_a_run_replaces_its_rejects(house, write):
    house.run(write(), run_id=5)
    house.run(write(), run_id=5)
    assert house.rejects().count() == 6
    house.run(write(CLAIMS[:5]), run_id=5)
    assert house.rejects().count() == 0
    assert house.audit.runs().count() == 1 and counts(house, 5)[-1] == 0


def test_duplicate_claims_and_duplicate_rejects(house, write):
    house.run(write([*CLAIMS, GOOD, BAD_STATUS]))
    assert counts(house, 1)[6:] == (6, 7)


@pytest.mark.parametrize(
    "feeds, error",
    [
        ({"claims": []}, "empty"),
        ({"patients": [*PATIENTS, PATIENTS[0].replace(",M", ",F")]}, "different source rows"),
        ({"claims": [*CLAIMS, GOOD.replace("12.50,,", "12.50,1.00,")]}, "different source rows"),
        ({"claims": [GOOD.replace("12.50", "n/a")]}, "AmountBilled is missing in 1"),
        ({"providers": ["x" * 201 + ",North,Eyes"]}, "longer than 200"),
        ({"claims": [*CLAIMS, GOOD + ",more"]}, "widest row"),
    ],
)
def test_failed_runs(house, write, feeds, error):
    with pytest.raises(ValueError, match=error):
        house.run(write(**feeds))
    assert counts(house, 1) == ("FAILED", *[None] * 7)
    assert house.audit.runs().first()["EndedAt"] is not None
    assert house.tables.state(c.CLAIM).versions == {} and house.rejects().count() == 0


def test_missing_file_fails_the_run_but_not_the_next(house, write):
    feeds = {**write(), "claims": "/nowhere/claims.csv"}
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        house.run(feeds)
    assert counts(house, 1)[0] == "FAILED"
    house.run(write())
    assert counts(house, 2)[0] == "SUCCESS" and house.claims().count() == 6


def test_failed_claims_leave_dimensions_updated(house, write, monkeypatch):
    def broken(*_args, **_kw):
        raise RuntimeError("lost")

    apply = pipeline.apply_changes
    monkeypatch.setattr(
        pipeline, "apply_changes", lambda ch: broken() if "ClaimID" in ch.rows.columns else apply(ch)
    )
    with pytest.raises(RuntimeError, match="lost"):
        house.run(write())
    assert house.providers().count() == 4 and house.patients().count() == 5
    assert house.claims().count() == 0 and house.rejects().count() == 0


def test_missing_text_in_both_forms(house, write, tmp_path):
    feeds = write()
    plain = tmp_path / "plain.csv"
    plain.write_text("Name,Region,Specialty\nUlm Dental,East,\nKiel Eyes,North,NA\n")
    options = Options(null_text_plain="nan", null_text_repaired="None")
    house.run({**feeds, "providers": str(plain)}, options=options)
    assert {r["Specialty"] for r in house.providers().collect()} == {"nan"}
    house.run({**feeds, "providers": str(plain)})
    assert {r["Specialty"] for r in house.providers().collect()} == {None}


def test_case_insensitive_keys(house, write):
    louder = [line.replace("Kiel Eyes", "KIEL eyes") for line in CLAIMS]
    house.run(write(louder), options=Options(fold_case=True))
    assert counts(house, 1)[6:] == (6, 6)


def test_missing_references_stop_a_run(house, write, monkeypatch):
    house.run(write())
    resolve = c.resolve_claims

    def astray(*args, **kw):
        return resolve(*args, **kw).withColumn("ProviderID", F.when(F.col("AmountBilled") > 99, 77).otherwise(F.col("ProviderID")))

    monkeypatch.setattr(c, "resolve_claims", astray)
    with pytest.raises(ValueError, match="2 references to 1 missing rows, such as Provider 77"):
        house.run(write())
    assert counts(house, 2)[0] == "FAILED" and house.claims().count() == 6 and house.rejects().count() == 6
    assert house.missing_references(house.claims()).count() == 0


def test_date_patterns_are_chosen_by_most_values(house, write):
    turned = [re.sub(r"(\d{4})-(\d\d)-(\d\d)", r"\3.\2.\1", line) for line in CLAIMS]
    house.run(write(turned), options=Options(date_patterns=("yyyy-M-d", "M/d/yyyy", "d.M.yyyy")))
    assert counts(house, 1) == ("SUCCESS", *LOADED) and by_rule(house, 1) == EXPECTED


def test_unknown_birth_dates(house, write):
    patients = [line.replace("2010-03-01", "") for line in PATIENTS]
    claims = [GOOD.replace("2010-03-01", "1900-01-01"), *CLAIMS[1:]]
    house.run(write(claims, patients))
    # The first claim resolves; the second still names the birth date.
    assert by_rule(house, 1) == {**EXPECTED, "FK_NOT_FOUND": 3}
    assert house.claims().count() == 5
    assert house.patients().filter("BirthDate IS NULL").count() == 1


def test_far_dates_are_kept_or_dropped_on_request(house, write):
    patients = [line.replace("1945-05-08", "1600-01-01") for line in PATIENTS]
    house.run(write(patients=patients))
    assert house.patients().filter("BirthDate = DATE '1600-01-01'").count() == 1
    house.run(write(patients=patients), options=Options(nanosecond_dates=True))
    assert house.patients().filter("BirthDate IS NULL").count() == 1


def test_other_separator_and_encoding(house, write, tmp_path):
    feeds = write()
    lines = ["Name;Region;Specialty", '"Köln; West";North;Ohren']
    (tmp_path / "semicolons.csv").write_bytes("\n".join(lines).encode("latin-1"))
    options = Options(separator=";", encoding="ISO-8859-1")
    with pytest.raises(ValueError, match="widest row has 4 fields, the header has 3"):
        house.run({**feeds, "providers": str(tmp_path / "semicolons.csv")})
    house.run({**feeds, "providers": str(tmp_path / "semicolons.csv")}, options=options)
    assert house.providers().select("Name").first()[0] == "Köln; West"


def test_views_follow_the_runs(house, write, spark):
    house.run(write())
    house.register_views()
    house.run(write())
    assert spark.sql("SELECT SUM(RejectCount) FROM vw_DQ_Claim_Summary").first()[0] == 12
    assert [r[0] for r in spark.sql("SELECT RunID FROM vw_ETL_Run_Summary").collect()] == [2, 1]
    assert spark.sql("SELECT * FROM vw_ETL_Run_DQ_Breakdown").count() == 10
    assert spark.table("vw_ETL_Run_Summary").columns == ["RunID", "StartedAt", "EndedAt", "Status", *COUNT_COLUMNS]


def test_runs_share_the_folders_of_their_months(house, write, tmp_path):
    house.run(write())
    house.run(write())
    house.run(write(CLAIMS[:5]))
    house.run(write(), run_id=1)
    folder = tmp_path / "warehouse" / "Reject_Claim"
    months = [p for p in folder.iterdir() if p.is_dir() and "=" in p.name]
    assert len(months) == len({p.name for p in months}) <= 2
    for path in folder.glob("*/*.parquet"):
        stats = pq.ParquetFile(path).metadata.row_group(0)
        columns = {stats.column(i).path_in_schema: stats.column(i).statistics for i in range(stats.num_columns)}
        assert columns["RunID"].min == columns["RunID"].max
        assert columns["table_attempt"].min == columns["table_attempt"].max
    own = house.rejects_of_run(2)
    text = own._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(RunID,2)" in text and "Join" not in text
    assert "PartitionFilters: [isnotnull(IngestMonth" in text or "PartitionFilters: [IngestMonth" in text
    assert own.count() == 6 and house.rejects_of_run(3).count() == 0
    assert house.rejects_of_run(1).count() == 6 and house.rejects().count() == 12
    # The driver holds nothing per run.
    assert house.tables.state(c.REJECT_CLAIM).versions == {}


def test_reports_come_from_stored_counts(house, write, rows, spark):
    house.run(write())
    house.run(write([*CLAIMS, BAD_STATUS]))
    house.run(write(CLAIMS[:5]), run_id=1)
    counts = house.reject_counts()
    assert "Reject_Claim" not in " ".join(counts.inputFiles())
    by_date = reports.summaries_by_date_and_rule(counts)
    assert rows(by_date, "IngestDate", "RuleCode", "RejectCount") == rows(
        reports.rejects_by_date_and_rule(house.rejects()), "IngestDate", "RuleCode", "RejectCount"
    )
    assert rows(reports.summaries_by_run_and_rule(counts)) == rows(reports.rejects_by_run_and_rule(house.rejects()))


def test_all_claims_rejected_then_none(house, write):
    house.run(write([NO_PROVIDER, NO_PATIENT, BAD_STATUS]))
    assert counts(house, 1)[6:] == (0, 3)
    assert house.claims().count() == 0
    house.run(write(CLAIMS[:2]))
    assert counts(house, 2)[6:] == (2, 0)
    house.run(write([NEGATIVE]))
    assert counts(house, 3)[6:] == (2, 1)
