"""The registered queries: each operator over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.coerce import coerce_types, vote_date_patterns
from millrace.functions.keys import KeyRule
from millrace.functions.text import na_to_null, strip_text
from millrace.operators.ids import assign_ids
from millrace.operators.quality import evaluate_rules, reject_rows
from millrace.operators.resolve import fk_violations, resolve_keys
from millrace.operators.upsert import Merge, ambiguous_keys, upsert
from millrace.plans import audit, reports
from millrace.plans import claims as c
from millrace.plans.pipeline import ClaimsWarehouse
from millrace.schemas import Field, TableSpec
from millrace.session import Scratch
from millrace.sinks.staging import ROW_SEQUENCE, ContractError, contract_violations, load_staging
from millrace.sinks.warehouse import Warehouse, Written
from millrace.sources.feeds import read_feed, shape_feed
from verification import inputs
from verification.inputs import portable, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST_LOAD = datetime(2024, 1, 1, tzinfo=timezone.utc)
SECOND_LOAD = datetime(2024, 2, 1, tzinfo=timezone.utc)
AS_OF = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)

GIVEN_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)


#: Lines of a compressed file of a feed.
FEED_FILE_ROWS = 1_000_000

COVERS: dict[str, tuple[str, ...]] = {}


def query(name: str, *operators: str) -> Callable[[Query], Query]:
    """Register a query and the operators of the survey it exercises."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The tables' times have no zone; the SQL twins read them as UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf_dir))

        QUERIES[name] = run
        COVERS[name] = operators
        return fn

    return register


# -- key resolution -----------------------------------------------------------------------


@query("resolve_inner", "J1", "J3", "F6")
def resolve_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.resolved_claims(spark, sf_dir, "inner")


@query("resolve_left", "J2", "J3", "P1")
def resolve_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.resolved_claims(spark, sf_dir)


@query("resolve_hot_keys", "J2", "J3", "K2", "A4")
def resolve_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent keys found while staging, then given the path of their own."""
    staged = load_staging(
        inputs.claims(spark, sf_dir),
        c.STG_CLAIM,
        f"{Scratch(spark).path}/staging",
        c.key_probes(),
    )
    return c.resolve_claims(
        staged.df,
        inputs.patients(spark, sf_dir),
        inputs.providers(spark, sf_dir),
        hot=staged.hot,
        spread_by=F.col(ROW_SEQUENCE),
    ).drop(ROW_SEQUENCE)


@query("null_sentinel_join", "J3", "F6", "F8")
def null_sentinel_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates against customer dates, where NULL and 1900-01-01 are the same."""
    sentinel = F.lit(c.UNKNOWN_BIRTH).cast("date")
    visits = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate"))
        .when(F.col("o_orderstatus") == "O", sentinel)
        .alias("visit"),
    )
    segment = F.col("c_mktsegment")
    known = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(segment == "BUILDING", sentinel)
        .when(segment != "MACHINERY", F.lit("1998-05-01").cast("date"))
        .alias("since"),
        F.col("c_custkey").alias("found_id"),
    )
    return resolve_keys(
        visits,
        known,
        [("o_custkey", "c_custkey"), ("visit", "since")],
        "found_id",
        rule=KeyRule({"since": c.UNKNOWN_BIRTH}),
    ).select("o_orderkey", "visit", "found_id")


@query("fk_violations", "J5")
def fk_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fk_violations(
        table(spark, sf_dir, "lineitem"), inputs.providers(spark, sf_dir), "l_suppkey", "ProviderID"
    )


# -- quality rules ------------------------------------------------------------------------


def _register_rule(code: str, operator: str, *functions: str) -> None:
    def one_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
        resolved = inputs.resolved_claims(spark, sf_dir)
        gate = c.unresolved_rule()
        rules = [r for r in c.claim_rules() if r.code == code]
        rejected = c.with_resolved_names(reject_rows(evaluate_rules(resolved, gate, rules), gate, rules))
        return rejected.filter(F.col("RuleCode") == code).drop("RulePosition")

    query(f"rule_{code.lower()}", operator, *functions)(one_rule)


_register_rule("FK_NOT_FOUND", "Q1", "P3", "F7", "F8")
_register_rule("NEGATIVE_AMOUNT", "Q2", "P4", "P7")
_register_rule("OVERPAID", "Q3", "P4", "P7")
_register_rule("DATE_ORDER", "Q4", "P4", "P7")
_register_rule("BAD_STATUS", "Q5", "P4", "F9", "F10")


@query("rejects_all", "Q6", "M9", "U1", "P2", "P3", "P4", "P7", "F7", "F8", "F13")
def rejects_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.rejected_claims(inputs.evaluated_claims(spark, sf_dir)).drop("RulePosition")


@query("rejects_by_rule", "R2", "G4")
def rejects_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: stage, resolve, evaluate, and count the rejects of the run by rule."""
    rejects = c.rejected_claims(inputs.evaluated_claims(spark, sf_dir))
    return reports.rejects_by_run_and_rule(rejects.withColumn("RunID", F.lit(1).cast("bigint")))


@query("multi_rule_rows", "Q6", "F13")
def multi_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        inputs.evaluated_claims(spark, sf_dir)
        .withColumn("broken_count", F.bit_count("_broken_rules").cast("bigint"))
        .filter("broken_count >= 2")
        .drop("_broken_rules")
    )


@query("valid_claims", "Q7", "P5", "P7", "G1")
def valid_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return c.valid_claims(inputs.evaluated_claims(spark, sf_dir)).distinct()


# -- upserts ------------------------------------------------------------------------------


def _numbered(df: DataFrame, merge: Merge, scratch: Scratch) -> DataFrame:
    """A target as a first load leaves it."""
    order = [k.asc_nulls_first() for k in merge.rule.columns(df, list(merge.keys))]
    return assign_ids(df, order, merge.id_col, 1, scratch).withColumn(
        merge.created_col, F.lit(FIRST_LOAD).cast("timestamp")
    )


@query("upsert_dim", "M1", "M5", "M7", "M8", "J4")
def upsert_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, merge = Scratch(spark), c.provider_merge()
    rows = inputs.suppliers(spark, sf_dir)
    target = _numbered(
        rows.filter("s_acctbal < 6000").select("Name", "Region", "Specialty"), merge, scratch
    )
    source = rows.filter("s_acctbal >= 2000").select(
        "Name", "Region", F.concat(F.col("Specialty"), F.lit(" II")).alias("Specialty")
    )
    return upsert(target, source, merge, SECOND_LOAD, scratch)


def _patient_loads(spark: SparkSession, sf_dir: str, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    rows = inputs.customers(spark, sf_dir)
    columns = ["FirstName", "LastName", "BirthDate"]
    target = _numbered(
        rows.filter("c_acctbal < 6000").select(*columns, "Gender"), c.patient_merge(), scratch
    )
    source = rows.filter("c_acctbal >= 2000").select(
        *columns, F.when(F.col("Gender") != "BUILDING", F.lower("Gender")).alias("Gender")
    )
    return target, source


@query("upsert_dim_null_key", "M2", "M5", "M7", "M8", "J3", "J4")
def upsert_patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    target, source = _patient_loads(spark, sf_dir, scratch)
    return upsert(target, source, c.patient_merge(), SECOND_LOAD, scratch)


@query("upsert_twice", "M10")
def upsert_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    target, source = _patient_loads(spark, sf_dir, scratch)
    once, _ = scratch.write(upsert(target, source, c.patient_merge(), SECOND_LOAD, scratch))
    return upsert(once, source, c.patient_merge(), datetime.now(timezone.utc), scratch)


def _upsert_claims(spark: SparkSession, sf_dir: str, resolved: DataFrame) -> DataFrame:
    """A target of the claims before 1999, unpaid then; a batch of those from 1997 on."""
    scratch = Scratch(spark)
    rows, _ = scratch.write(resolved.select(*c.VALID_COLUMNS))
    first = rows.filter("DateSubmitted < '1999-01-01'").withColumns(
        {
            "AmountPaid": F.lit(None).cast(c.MONEY),
            "Status": F.lit("Submitted"),
            "DatePaid": F.lit(None).cast("date"),
        }
    )
    target = _numbered(first.distinct(), c.CLAIM_MERGE, scratch)
    source = rows.filter("DateSubmitted >= '1997-01-01'")
    return upsert(target, source, c.CLAIM_MERGE, SECOND_LOAD, scratch)


@query("upsert_fact_basic", "M3", "M5", "J1", "J4")
def upsert_claim_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_claims(spark, sf_dir, inputs.resolved_claims(spark, sf_dir, "inner"))


@query("upsert_fact_dq", "M4", "M5", "Q7", "J4")
def upsert_claim_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upsert_claims(spark, sf_dir, c.valid_claims(inputs.evaluated_claims(spark, sf_dir)))


@query("ambiguous_keys", "M6")
def ambiguous_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that stop an upsert, found as runs find them."""
    lines = table(spark, sf_dir, "lineitem")
    keys = ("l_orderkey", "l_linenumber")
    merge = Merge(keys, tuple(n for n in lines.columns if n not in keys), "line_id", "created_at")
    return ambiguous_keys(lines, merge)


@query("assign_ids", "M7")
def assign_line_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct()
    order = [F.col("l_orderkey"), F.col("l_linenumber")]
    return assign_ids(keys, order, "line_id", 1001, Scratch(spark))


@query("distinct_rows", "G1")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_suppkey", "l_returnflag", "l_linestatus", F.to_date("l_shipdate").alias("ship_date"))
        .distinct()
    )


# -- types and text -----------------------------------------------------------------------


@query("coerce_numbers", "F1", "F3", "F4")
def coerce_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as feeds spell them: plain, with blanks, exponents, or not numbers at all."""
    amount = F.col("value").cast("decimal(18,2)").cast("string")
    kind = F.col("event_type")
    text = (
        F.when(kind == "signup", F.concat(F.lit("  "), amount, F.lit(" ")))
        .when(kind == "view", F.concat(F.lit("$"), amount))
        .when(kind == "click", F.concat(F.lit("-"), amount, F.lit("e1")))
        .when(kind == "error", F.lit("n/a"))
        .otherwise(amount)
    )
    whole = F.when(kind == "view", F.concat(F.col("user_id").cast("string"), F.lit(".0"))).otherwise(
        F.when(kind != "error", F.col("user_id").cast("string"))
    )
    raw = table(spark, sf_dir, "events").select(
        "event_id", text.alias("money"), text.alias("number"), whole.alias("whole")
    )
    return coerce_types(raw, {"money": c.MONEY, "number": "float", "whole": "int", "absent": "str"})


@query("coerce_dates", "F1", "F5")
def coerce_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates with single digits, blanks, times or remarks."""
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    text = (
        F.when(priority == "1-URGENT", F.date_format("o_orderdate", "yyyy-M-d"))
        .when((priority == "2-HIGH") & (status == "O"), F.concat(iso, F.lit("   <-- remark")))
        .when((priority == "2-HIGH") & (status == "F"), F.concat(F.lit(" "), iso))
        .when(priority == "3-MEDIUM", F.concat(iso, F.lit(" 13:00:00")))
        .when(priority == "5-LOW", F.date_format("o_orderdate", "yyyy"))
        .when(status == "P", F.when(F.col("o_orderkey") % 2 == 0, "9999-12-31").otherwise("1600-01-01"))
        .otherwise(iso)
    )
    raw = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("day"))
    return coerce_types(raw, {"day": "date"})


@query("coerce_datetimes", "F1", "F5")
def coerce_datetimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times in two spellings: the pattern that fits most of them is the one they are read by."""
    minute = F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")
    clock = F.concat((F.col("o_orderkey") % 24).cast("string"), F.lit(":"), minute)
    spelled = F.concat(F.date_format("o_orderdate", "d.M.yyyy"), F.lit(" "), clock)
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(spelled)
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey", text.alias("at"), F.date_format("o_orderdate", "M/d/yyyy").alias("day")
    )
    candidates = ["yyyy-M-d", "M/d/yyyy", "d.M.yyyy H:mm"]
    patterns = vote_date_patterns(raw, ["at", "day"], candidates)
    return coerce_types(raw, {"at": "datetime64[ns]", "day": "date"}, date_pattern=patterns)


@query("trim_text", "F2", "F14")
def trim_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit("\u00a0\u3000\r\n"))
    return table(spark, sf_dir, "documents").select("doc_id", strip_text(padded).alias("text"))


@query("na_tokens", "S3")
def na_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    cell = (
        F.when(kind == "signup", "NA")
        .when(kind == "view", "null")
        .when(kind == "click", " NA ")
        .when(kind == "error", "")
        .otherwise(F.col("props"))
    )
    return table(spark, sf_dir, "events").select("event_id", na_to_null(cell).alias("cell"))


@query("split_single_column", "S4", "S5", "S5a", "S5b", "S7", "F14")
def split_single_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as text of one column, cut at the delimiter named by the header."""
    line = F.concat_ws(
        "|",
        F.col("l_orderkey").cast("string"),
        F.concat(F.col("l_returnflag"), F.lit(","), F.col("l_linestatus")),
        F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_linenumber").cast("string")),
    )
    lines = table(spark, sf_dir, "lineitem").select(line.alias(" order | flags|line "))
    return shape_feed(lines, ["line", "order"], ["line_text", "order_text"]).checked()


def _written_feed(df: DataFrame, columns: list[str], path: str, delimiter: str = ",") -> str:
    """A feed whose rows are one quoted field each, missing values left blank.

    It comes as compressed files, a task for each: none is larger than a task may read.
    """
    line = F.concat_ws(delimiter, *[F.coalesce(F.col(n).cast("string"), F.lit("")) for n in columns])
    writer = df.select(line.alias(delimiter.join(columns))).write.option("header", True).option("quoteAll", True)
    writer.option("compression", "gzip").option("maxRecordsPerFile", FEED_FILE_ROWS).csv(path)
    return path


@query("read_wrapped_feed", "S1", "S5", "S5a", "S5b", "F1")
def read_wrapped_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark).path}/feed"
    _written_feed(inputs.claims(spark, sf_dir), c.STG_CLAIM.columns, path, ";")
    feed = read_feed(spark, path, c.STG_CLAIM.columns)
    return coerce_types(feed.checked(), c.TYPES["StgClaim"])


@query("read_plain_feed", "S1", "S3", "S4", "S7", "F1")
def read_plain_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comma-separated feed with a superfluous column and missing values."""
    path = f"{Scratch(spark).path}/feed"
    rows = inputs.claims(spark, sf_dir).select(F.lit("x").alias("Extra"), "*")
    rows.write.option("header", True).option("escape", '"').csv(path)
    feed = read_feed(spark, path, c.STG_CLAIM.columns)
    return coerce_types(feed.checked(), c.TYPES["StgClaim"])


@query("read_bom_feed", "S1", "S2")
def read_bom_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that each begin with a byte order mark, before the name of the first column."""
    path = f"{Scratch(spark).path}/feed"
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("\ufeffo_orderkey"), "o_orderpriority"
    )
    rows.repartition(3).write.option("header", True).csv(path)
    return read_feed(spark, path, ["o_orderkey", "o_orderpriority"]).checked()


@query("read_many_files", "S1", "S7")
def read_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of files in a character set of one byte, the columns picked and renamed."""
    root = Scratch(spark).path
    rows = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"), F.concat("event_type", F.lit(" \u20ac")).alias("kind"), "props"
    )
    paths = [f"{root}/even", f"{root}/odd"]
    for rest, path in enumerate(paths):
        # Spark writes no windows-1252; its euro sign is this control character of ISO-8859-1.
        coded = rows.filter(F.col("id").cast("bigint") % 2 == rest).withColumn(
            "kind", F.translate("kind", "\u20ac", "\x80")
        )
        writer = coded.repartition(4).write.option("header", True).option("escape", '"')
        writer.option("encoding", "ISO-8859-1").csv(path)
    feed = read_feed(spark, paths, ["kind", "id"], ["event_kind", "event_number"], encoding="windows-1252")
    return feed.checked()


@query("read_delimited_feed", "S1", "S3")
def read_delimited_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields parted by bars, with inch marks that are no quotes, and missing values."""
    path = f"{Scratch(spark).path}/feed"
    size = F.concat((F.col("o_orderkey") % 90).cast("string"), F.lit('" x '), F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("key"),
        size.alias("size"),
        F.when(F.col("o_orderstatus") == "F", "NA").otherwise(F.col("o_orderstatus")).alias("status"),
    )
    rows.write.option("header", True).option("sep", "|").option("quote", "").csv(path)
    return read_feed(spark, path, ["key", "size", "status"], separator="|").checked()


@query("read_multiline_feed", "S1")
def read_multiline_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with line breaks, quotes and separators in them."""
    path = f"{Scratch(spark).path}/feed"
    rows = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("doc"), "text")
    writer = rows.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_feed(spark, path, ["doc", "text"], multi_line=True).checked()


@query("contract_violations", "K4")
def contract_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims from texts that are too long or missing, counted per rule of the contract."""
    rows = inputs.claims(spark, sf_dir).withColumns(
        {
            "ProviderName": F.when(F.col("Status") != "paid", F.col("ProviderName")),
            "Status": F.when(F.col("AmountPaid").isNull(), F.repeat("Status", 5)).otherwise(
                F.col("Status")
            ),
            "AmountBilled": F.when(F.col("AmountBilled") > 0, F.col("AmountBilled")),
        }
    )
    return contract_violations(rows, c.STG_CLAIM)


# -- counts, reports, history -------------------------------------------------------------


@query("table_counts", "G2", "A4", "A5")
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, name).agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name in GIVEN_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


@query("rejects_by_date_rule", "R1", "G4", "F11")
def rejects_by_date_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejects_by_date_and_rule(inputs.event_rejects(spark, sf_dir))


@query("rejects_by_run_rule", "R2", "G4")
def rejects_by_run_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejects_by_run_and_rule(inputs.event_rejects(spark, sf_dir))


@query("rejects_last_24h", "R5")
def rejects_last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rejects_in_last_day(inputs.event_rejects(spark, sf_dir), AS_OF)


@query("run_rejects", "P6", "R4", "G3")
def run_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    run_id = int(AS_OF.timestamp()) // 3600
    return reports.rejects_of_run(inputs.event_rejects(spark, sf_dir), run_id).drop("IngestedAt")


@query("audit_counters", "A1", "A2", "A3")
def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.fold_runs(inputs.event_run_log(spark, sf_dir))


@query("latest_runs", "R3", "L1")
def latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.latest_runs(audit.fold_runs(inputs.event_run_log(spark, sf_dir)))


# -- whole runs ---------------------------------------------------------------------------


def _new_house(spark: SparkSession, sf_dir: str) -> tuple[ClaimsWarehouse, dict[str, str]]:
    """An empty warehouse, and feeds written from the tables."""
    scratch = Scratch(spark)
    providers = inputs.providers(spark, sf_dir)
    patients = inputs.patients(spark, sf_dir)
    feeds = {
        "providers": _written_feed(providers, c.STG_PROVIDER.columns, f"{scratch.path}/providers"),
        "patients": _written_feed(patients, c.STG_PATIENT.columns, f"{scratch.path}/patients"),
        "claims": _written_feed(
            inputs.claims(spark, sf_dir), c.STG_CLAIM.columns, f"{scratch.path}/claims"
        ),
    }
    return ClaimsWarehouse(spark, f"{scratch.path}/warehouse"), feeds


def _loaded(spark: SparkSession, sf_dir: str, runs: int = 1) -> ClaimsWarehouse:
    warehouse, feeds = _new_house(spark, sf_dir)
    for _ in range(runs):
        warehouse.run(feeds)
    return warehouse


@query("run_claims", "X1", "X2", "K1", "K2", "K5", "M1", "M2", "M4")
def run_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim table after a run over feeds written from the tables."""
    return _loaded(spark, sf_dir).claims().drop("CreatedAt", "SubmitMonth")


@query("run_rejects_table", "X1", "K6", "M9", "Q1", "Q2", "Q3", "Q4", "Q5")
def run_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reject table after a run."""
    return _loaded(spark, sf_dir).rejects().drop("RejectID", "IngestedAt")


@query("run_counts", "A1", "A2", "A3", "A4", "A5", "A6", "M10")
def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run history after the same feeds were loaded twice."""
    return _loaded(spark, sf_dir, runs=2).audit.runs().drop("StartedAt", "EndedAt")


@query("run_result", "A8", "X1")
def run_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row and the line that a run ends with."""
    warehouse, feeds = _new_house(spark, sf_dir)
    return warehouse.run(feeds)


@query("run_failed", "A7", "X3", "F12", "K4", "A1")
def run_failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that stops at its claims, and the next: history, times, and what each left behind."""
    warehouse, feeds = _new_house(spark, sf_dir)
    begun = datetime.now(timezone.utc)
    claims = inputs.claims(spark, sf_dir).withColumn("Status", F.repeat("Status", 9))
    bad = _written_feed(claims, c.STG_CLAIM.columns, f"{Scratch(spark).path}/claims")
    try:
        warehouse.run({**feeds, "claims": bad})
    except ContractError:
        left = [warehouse.claims().count(), warehouse.rejects().count()]
    warehouse.run(feeds)
    timely = (F.col("StartedAt") >= F.lit(begun)) & (F.col("EndedAt") >= F.col("StartedAt"))
    return warehouse.audit.runs().select(
        "RunID", "Status", timely.alias("Timely"), "StgClaimCount", "ClaimCount", "RejectTotal",
        F.when(F.col("RunID") == 1, F.lit(sum(left)).cast("bigint")).alias("LeftByFailure"),
    )


@query("run_reject_summary", "R1", "R2", "G4")
def run_reject_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by run and rule after two runs, from the counts stored with them."""
    warehouse = _loaded(spark, sf_dir, runs=2)
    warehouse.register_views()
    return spark.table("vw_ETL_Run_DQ_Breakdown")


@query("run_fk_check", "J5")
def run_fk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run's check of references finds once some providers are lost."""
    warehouse = _loaded(spark, sf_dir)
    tables = warehouse.tables
    kept = tables.snapshot(c.PROVIDER).filter("ProviderID % 7 <> 0")
    parts = sorted(tables.state(c.PROVIDER).versions)
    version, rows, _ = tables.write(c.PROVIDER, kept, parts)
    tables.commit([Written(c.PROVIDER.name, version, parts, rows)])
    return warehouse.missing_references(warehouse.claims())


@query("added_column", "K7")
def added_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that got a column after its first months were written."""
    rows = inputs.event_rejects(spark, sf_dir).withColumn("Day", F.date_format("IngestedAt", "yyyy-MM-dd"))
    fields = (Field("RejectID", "bigint"), Field("RuleCode", "string"), Field("Day", "string"))
    before = TableSpec("Reject", fields, id_col="RejectID", partition_col="Day")
    after = TableSpec("Reject", (*fields, Field("RunID", "bigint")), id_col="RejectID", partition_col="Day")
    tables = Warehouse(spark, f"{Scratch(spark).path}/warehouse")
    later = F.col("Day") >= "2024-01-15"
    for spec, half in ((before, rows.filter(~later)), (after, rows.filter(later))):
        parts = sorted(r["Day"] for r in half.select("Day").distinct().collect())
        version, count, max_id = tables.write(spec, half, parts)
        tables.commit([Written(spec.name, version, parts, count, max_id)])
    return tables.snapshot(after)
