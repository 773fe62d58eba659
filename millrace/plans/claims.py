"""Providers, patients and claims: contracts, rules and the three upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import KeyRule, key_hash
from millrace.operators.ids import unordered_ids
from millrace.operators.keyfilter import KeyColumns, KeyFilter, prune_dimension
from millrace.operators.quality import Rule, evaluate_rules, reject_rows, valid_rows
from millrace.operators.resolve import resolve_keys
from millrace.operators.upsert import Merge
from millrace.schemas import Field, TableSpec, text

MONEY = "decimal(18,2)"

# A missing birth date is compared as this day.
UNKNOWN_BIRTH = "1900-01-01"

# The accepted statuses, compared in upper case.
STATUSES = ("SUBMITTED", "REJECTED", "PAID")

_CLAIM_FEED = (
    text("PatientFirstName", 100, required=True),
    text("PatientLastName", 100, required=True),
    Field("PatientBirthDate", "date"),
    text("ProviderName", 200, required=True),
    text("ProviderRegion", 100, required=True),
    Field("AmountBilled", MONEY, required=True),
    Field("AmountPaid", MONEY),
    text("Status", 30, required=True),
    Field("DateSubmitted", "date", required=True),
    Field("DatePaid", "date"),
)

STG_PROVIDER = TableSpec(
    "StgProvider",
    (text("Name", 200, required=True), text("Region", 100, required=True), text("Specialty", 100)),
)
STG_PATIENT = TableSpec(
    "StgPatient",
    (
        text("FirstName", 100, required=True),
        text("LastName", 100, required=True),
        Field("BirthDate", "date"),
        text("Gender", 20),
    ),
)
STG_CLAIM = TableSpec("StgClaim", _CLAIM_FEED)

# The bucket follows from the natural key: a row and its later versions are in the same bucket,
# so an upsert reads only the buckets of its batch and rewrites only those that change.
BUCKET = "KeyBucket"

PROVIDER = TableSpec(
    "Provider",
    (
        Field("ProviderID", "bigint", True),
        *STG_PROVIDER.fields,
        Field("CreatedAt", "timestamp", True),
        Field(BUCKET, "string", True),
    ),
    id_col="ProviderID",
    created_col="CreatedAt",
    partition_col=BUCKET,
)
PATIENT = TableSpec(
    "Patient",
    (
        Field("PatientID", "bigint", True),
        *STG_PATIENT.fields,
        Field("CreatedAt", "timestamp", True),
        Field(BUCKET, "string", True),
    ),
    id_col="PatientID",
    created_col="CreatedAt",
    partition_col=BUCKET,
)
# The month follows from DateSubmitted, a key column: a claim and its later versions are in
# the same month, so an upsert reads and rewrites only the months of its batch.
CLAIM = TableSpec(
    "Claim",
    (
        Field("ClaimID", "bigint", True),
        Field("PatientID", "bigint", True),
        Field("ProviderID", "bigint", True),
        Field("AmountBilled", MONEY, True),
        Field("AmountPaid", MONEY),
        text("Status", 30, required=True),
        Field("DateSubmitted", "date", True),
        Field("DatePaid", "date"),
        Field("CreatedAt", "timestamp", True),
        Field("SubmitMonth", "string", True),
    ),
    id_col="ClaimID",
    created_col="CreatedAt",
    partition_col="SubmitMonth",
)
REJECT_CLAIM = TableSpec(
    "Reject_Claim",
    (
        Field("RejectID", "bigint", True),
        Field("IngestedAt", "timestamp", True),
        text("RuleCode", 50, required=True),
        text("Reason", 4000),
        *_CLAIM_FEED,
        Field("ResolvedPatientID", "bigint"),
        Field("ResolvedProviderID", "bigint"),
        Field("RunID", "bigint"),
        Field("IngestMonth", "string", True),
    ),
    id_col="RejectID",
    created_col="IngestedAt",
    partition_col="IngestMonth",
    batch_col="RunID",
)

# Text of the feeds to typed columns.
TYPES = {
    spec.name: {f.name: "str" if f.type == "string" else f.type for f in spec.fields}
    for spec in (STG_PROVIDER, STG_PATIENT, STG_CLAIM)
}

_PATIENT_ON = (
    ("PatientFirstName", "FirstName"),
    ("PatientLastName", "LastName"),
    ("PatientBirthDate", "BirthDate"),
)
_PROVIDER_ON = (("ProviderName", "Name"), ("ProviderRegion", "Region"))

VALID_COLUMNS = [
    "PatientID", "ProviderID", "AmountBilled", "AmountPaid", "Status", "DateSubmitted", "DatePaid",
]


def key_rule(fold_case: bool = False) -> KeyRule:
    return KeyRule({"BirthDate": UNKNOWN_BIRTH}, fold_case)


def provider_merge(fold_case: bool = False) -> Merge:
    return Merge(("Name", "Region"), ("Specialty",), "ProviderID", "CreatedAt", key_rule(fold_case))


def patient_merge(fold_case: bool = False) -> Merge:
    return Merge(
        ("FirstName", "LastName", "BirthDate"), ("Gender",), "PatientID", "CreatedAt", key_rule(fold_case)
    )


CLAIM_MERGE = Merge(
    ("PatientID", "ProviderID", "DateSubmitted", "AmountBilled"),
    ("AmountPaid", "Status", "DatePaid"),
    "ClaimID",
    "CreatedAt",
)


def key_bucket(df: DataFrame, merge: Merge, buckets: int) -> Column:
    """The bucket of a row's natural key, the same for keys that any comparison takes as equal."""
    folded = KeyRule(merge.rule.null_sentinels, fold_case=True).columns(df, list(merge.keys))
    return F.pmod(key_hash(folded), F.lit(buckets)).cast("string")


def key_probes(fold_case: bool = False) -> dict[str, KeyColumns]:
    """The lookups of a claim, for its frequent keys and for the filters of the dimensions."""
    return {
        name: KeyColumns(tuple(f for f, _ in on), tuple(d for _, d in on), key_rule(fold_case))
        for name, on in (("patient", _PATIENT_ON), ("provider", _PROVIDER_ON))
    }


def resolve_claims(
    claims: DataFrame,
    patients: DataFrame,
    providers: DataFrame,
    how: str = "left",
    fold_case: bool = False,
    hot: Mapping[str, Sequence[int]] | None = None,
    spread_by: Column | None = None,
    filters: Mapping[str, KeyFilter] | None = None,
) -> DataFrame:
    """Claims with PatientID and ProviderID, NULL (or, if ``inner``, absent) if unknown.

    ``filters`` of the keys of ``claims`` cut the dimensions down before the joins.
    """
    hot = hot or {}
    rule = key_rule(fold_case)
    if filters:
        lookups = key_probes(fold_case)
        patients = prune_dimension(patients, filters["patient"], lookups["patient"])
        providers = prune_dimension(providers, filters["provider"], lookups["provider"])
    # The smaller dimension first: its names need not be carried through the shuffle by patient
    # unless someone reads them afterwards.
    found = resolve_keys(
        claims, providers, _PROVIDER_ON, "ProviderID", how, rule, hot.get("provider", ()), spread_by
    )
    found = resolve_keys(
        found, patients, _PATIENT_ON, "PatientID", how, rule, hot.get("patient", ()), spread_by
    )
    return found.select(*[F.col(f"`{name}`") for name in claims.columns], "PatientID", "ProviderID")


def unresolved_rule() -> Rule:
    no_patient, no_provider = F.col("PatientID").isNull(), F.col("ProviderID").isNull()
    reason = F.concat(
        F.lit("Could not resolve "),
        F.when(no_patient, F.lit("Patient ")).otherwise(F.lit("")),
        F.when(no_provider, F.lit("Provider ")).otherwise(F.lit("")),
        F.lit("from natural keys."),
    )
    return Rule("FK_NOT_FOUND", no_patient | no_provider, reason)


def claim_rules() -> list[Rule]:
    """Rules for resolved claims; a claim can break several."""
    billed, paid = F.col("AmountBilled"), F.col("AmountPaid")
    return [
        Rule(
            "NEGATIVE_AMOUNT",
            (billed < 0) | (paid < 0),
            F.lit("AmountBilled and/or AmountPaid is negative."),
        ),
        Rule("OVERPAID", paid > billed, F.lit("AmountPaid exceeds AmountBilled.")),
        Rule(
            "DATE_ORDER",
            F.col("DatePaid") < F.col("DateSubmitted"),
            F.lit("DatePaid is earlier than DateSubmitted."),
        ),
        Rule(
            "BAD_STATUS",
            ~F.upper("Status").isin(*STATUSES),
            F.lit("Status not in (Submitted, Rejected, Paid)."),
        ),
    ]


def evaluate_claims(resolved: DataFrame) -> DataFrame:
    return evaluate_rules(resolved, unresolved_rule(), claim_rules())


def rejected_claims(evaluated: DataFrame) -> DataFrame:
    """One row per claim and broken rule, with the ids that were found."""
    return with_resolved_names(reject_rows(evaluated, unresolved_rule(), claim_rules()))


def with_resolved_names(rejects: DataFrame) -> DataFrame:
    return rejects.withColumnsRenamed(
        {"PatientID": "ResolvedPatientID", "ProviderID": "ResolvedProviderID"}
    )


def valid_claims(evaluated: DataFrame) -> DataFrame:
    """Claims that pass everything; copies are still present."""
    required = ["PatientID", "ProviderID", "AmountBilled", "Status", "DateSubmitted"]
    return valid_rows(evaluated, required).select(*VALID_COLUMNS)


def submit_month(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def reject_counts() -> dict[str, Column]:
    """Rejects by rule, as metrics of the pass that writes them."""
    codes = [unresolved_rule().code, *[rule.code for rule in claim_rules()]]
    return {code: F.count_if(F.col("RuleCode") == code) for code in codes}


def stamp_rejects(
    rejects: DataFrame, run_id: int, ingested_at: datetime, sequence: Column, partitions: int, next_id: int
) -> DataFrame:
    """Reject rows with run, time and an id made of the staged row's number and the rule."""
    rule_count = len(claim_rules()) + 1
    row_id = unordered_ids(sequence, partitions, 0)
    return rejects.withColumns(
        {
            "RejectID": F.lit(next_id) + row_id * rule_count + F.col("RulePosition"),
            "IngestedAt": F.lit(ingested_at).cast("timestamp"),
            "RunID": F.lit(run_id).cast("bigint"),
            "IngestMonth": F.lit(ingested_at.strftime("%Y-%m")),
        }
    ).select(*REJECT_CLAIM.columns)
