"""A whole run: read three feeds, stage, upsert dimensions, then validate and upsert claims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.coerce import DATE_PATTERN, coerce_types, vote_date_patterns
from millrace.operators.keyfilter import key_filters
from millrace.operators.quality import BROKEN_RULES
from millrace.operators.resolve import fk_violations
from millrace.operators.upsert import Changes, Merge, apply_changes, plan_changes
from millrace.plans import claims as c
from millrace.plans import reports
from millrace.plans.audit import RunAudit, now
from millrace.schemas import TableSpec
from millrace.session import Scratch
from millrace.sinks.staging import ROW_SEQUENCE, Staged, load_staging
from millrace.sinks.warehouse import Warehouse, Written
from millrace.sources.feeds import WIDTH, Feed, read_feed


class MissingReferenceError(ValueError):
    """Claims name patients or providers that are not there."""


#: Parts of a dimension table in a new warehouse.
DIMENSION_BUCKETS = 16

_FEEDS = {"providers": c.STG_PROVIDER, "patients": c.STG_PATIENT, "claims": c.STG_CLAIM}


@dataclass(frozen=True)
class Options:
    """``null_text_*`` replace missing text in plain and in repaired feeds; NULL if not set.

    ``nanosecond_dates`` turns dates outside 1677-09-22 to 2262-04-11 into NULL. With
    ``date_patterns`` each date column is read by the one that fits most of its values, which
    takes a scan of the feed of its own; without it ``date_pattern`` holds for all.
    """

    fold_case: bool = False
    multi_line: bool = False
    date_pattern: str = DATE_PATTERN
    date_patterns: Sequence[str] = ()
    nanosecond_dates: bool = False
    separator: str = ","
    encoding: str = "UTF-8"
    null_text_plain: str | None = None
    null_text_repaired: str | None = None


class ClaimsWarehouse:
    """The final tables, reject table, run history and reports under one root folder.

    ``buckets`` divides each dimension by natural key. It is fixed when the folder is made; a
    bucket of some hundred MB is rewritten quickly and costs few files.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = DIMENSION_BUCKETS):
        self.spark = spark
        self.tables = Warehouse(spark, root, {"buckets": buckets})
        self.buckets = int(self.tables.settings["buckets"])
        self.audit = RunAudit(spark, self.tables.path("runs"))
        self._views = False

    def table(self, spec: TableSpec) -> DataFrame:
        """The rows of a table as of now."""
        self.tables.refresh()
        return self.tables.snapshot(spec)

    def providers(self) -> DataFrame:
        return self.table(c.PROVIDER).drop(c.BUCKET)

    def patients(self) -> DataFrame:
        return self.table(c.PATIENT).drop(c.BUCKET)

    def claims(self) -> DataFrame:
        return self.table(c.CLAIM)

    def rejects(self) -> DataFrame:
        return self.tables.added(c.REJECT_CLAIM).drop("IngestMonth")

    def rejects_of_run(self, run_id: int) -> DataFrame:
        """The rejects of one run; files of other runs and folders of other months are skipped."""
        return self.tables.added_by(c.REJECT_CLAIM, run_id).drop("IngestMonth")

    def reject_counts(self) -> DataFrame:
        """``RunID, IngestDate, RuleCode, RejectCount``, counted when the rejects were written."""
        return self.tables.batches(c.REJECT_CLAIM).select(
            F.col("batch").alias("RunID"),
            F.col("day").alias("IngestDate"),
            F.explode("counts").alias("RuleCode", "RejectCount"),
        )

    def register_views(self) -> None:
        """The three reports as temporary views for SQL, renewed at the end of every run."""
        self._views = True
        counts = self.reject_counts()
        reports.summaries_by_date_and_rule(counts).createOrReplaceTempView("vw_DQ_Claim_Summary")
        reports.latest_runs(self.audit.runs()).createOrReplaceTempView("vw_ETL_Run_Summary")
        reports.summaries_by_run_and_rule(counts).createOrReplaceTempView("vw_ETL_Run_DQ_Breakdown")

    # -- steps of a run ---------------------------------------------------------------

    def stage(self, spec: TableSpec, path: str | list[str], options: Options) -> Staged:
        feed = read_feed(
            self.spark,
            path,
            spec.columns,
            multi_line=options.multi_line,
            separator=options.separator,
            encoding=options.encoding,
        )
        null_text = options.null_text_repaired if feed.repaired else options.null_text_plain
        types, pattern = c.TYPES[spec.name], options.date_pattern
        dates = [name for name, kind in types.items() if kind == "date"]
        if options.date_patterns and dates:
            pattern = vote_date_patterns(feed.df, dates, options.date_patterns)
        typed = coerce_types(feed.df, types, null_text, pattern, options.nanosecond_dates)
        feed = Feed(typed.select(*spec.columns, WIDTH), feed.header_width, feed.repaired)
        path = self.tables.path("staging", spec.name)
        if spec is c.STG_CLAIM:
            return load_staging(feed, spec, path, c.key_probes(options.fold_case))
        merge = c.provider_merge() if spec is c.STG_PROVIDER else c.patient_merge()
        return load_staging(feed, spec, path, part=c.key_bucket(feed.df, merge, self.buckets))

    def upsert_dimension(
        self, spec: TableSpec, staged: Staged, merge: Merge, created_at: datetime, scratch: Scratch
    ) -> None:
        """Merge staged rows with the buckets they belong to; rewrite the buckets that change."""
        target = self.tables.snapshot(spec, staged.parts)
        bucket = c.key_bucket(staged.df, merge, self.buckets)
        changes = plan_changes(
            target, staged.df, merge, created_at, scratch, self.tables.next_id(spec), bucket
        )
        merged = apply_changes(changes).withColumn(c.BUCKET, bucket)
        self.tables.commit(self._write_changes(spec, changes, merged))

    def _write_changes(self, spec: TableSpec, changes: Changes, merged: DataFrame) -> list[Written]:
        """Write what a merge changed, which may be nothing."""
        if not changes.parts:
            return []
        version, _, _ = self.tables.write(spec, merged, changes.parts)
        rows = self.tables.row_count(spec) + changes.inserted_rows
        last_id = self.tables.next_id(spec) - 1 + changes.inserted_rows
        return [Written(spec.name, version, changes.parts, rows, last_id)]

    def upsert_claims(
        self, staged: Staged, run_id: int, at: datetime, options: Options, scratch: Scratch
    ) -> int:
        """Divert broken claims, upsert the others, publish both together; returns rejects."""
        resolved = c.resolve_claims(
            staged.df,
            self.tables.snapshot(c.PATIENT),
            self.tables.snapshot(c.PROVIDER),
            fold_case=options.fold_case,
            hot=staged.hot,
            spread_by=F.col(ROW_SEQUENCE),
            filters=key_filters(staged.df, c.key_probes(options.fold_case), staged.rows),
        )
        # Joined once, read twice: by the rejects and by the upsert.
        month = c.submit_month(F.col("DateSubmitted"))
        evaluated, found = scratch.write(
            c.evaluate_claims(resolved),
            {"months": F.collect_set(F.when(F.col(BROKEN_RULES) == 0, month))},
        )
        reject_table, rejects = self._write_rejects(evaluated, staged.partitions, run_id, at)
        target = self.tables.snapshot(c.CLAIM, found["months"])
        changes = plan_changes(
            target,
            c.valid_claims(evaluated),
            c.CLAIM_MERGE,
            at,
            scratch,
            self.tables.next_id(c.CLAIM),
            month,
        )
        self._check_references(changes.changed)
        merged = apply_changes(changes).withColumn("SubmitMonth", month)
        self.tables.commit([*reject_table, *self._write_changes(c.CLAIM, changes, merged)])
        return rejects

    def missing_references(self, claims: DataFrame) -> DataFrame:
        """``Reference, MissingID, row_count``: ids in claims that the dimensions do not have."""
        missing = [
            fk_violations(claims, self.tables.snapshot(spec), spec.id_col, spec.id_col).select(
                F.lit(spec.name).alias("Reference"), F.col(spec.id_col).alias("MissingID"), "row_count"
            )
            for spec in (c.PATIENT, c.PROVIDER)
        ]
        return missing[0].unionByName(missing[1])

    def _check_references(self, changed: DataFrame) -> None:
        """Updated and new claims must name rows that exist; the others were checked before."""
        missing = self.missing_references(changed)
        found = missing.agg(F.sum("row_count").alias("rows"), F.count("*").alias("ids")).first()
        if found["ids"]:
            sample = "; ".join(f"{r['Reference']} {r['MissingID']}" for r in missing.limit(20).collect())
            raise MissingReferenceError(f"{found['rows']} references to {found['ids']} missing rows, such as {sample}")

    def _write_rejects(
        self, evaluated: DataFrame, partitions: int, run_id: int, at: datetime
    ) -> tuple[list[Written], int]:
        """Rejects of this run, in place of those an earlier try of the run left behind."""
        rejects = c.stamp_rejects(
            c.rejected_claims(evaluated),
            run_id,
            at,
            F.col(ROW_SEQUENCE),
            partitions,
            self.tables.next_id(c.REJECT_CLAIM),
        )
        attempt, found = self.tables.append(c.REJECT_CLAIM, rejects, c.reject_counts())
        counts = {code: found[code] for code in c.reject_counts() if found[code]}
        written = Written(
            c.REJECT_CLAIM.name, attempt, found["parts"], max_id=found["max_id"], batch=run_id, day=at.date(), counts=counts
        )
        return [written], found["rows"]

    # -- the run ----------------------------------------------------------------------

    def run(
        self,
        feeds: Mapping[str, str | list[str]],
        run_id: int | None = None,
        options: Options = Options(),
    ) -> DataFrame:
        """Load the ``providers``, ``patients`` and ``claims`` feeds; one result row.

        Dimensions come first, each published by itself; rejects and claims are published
        together. After an error the run is recorded as FAILED and the error raised again.
        """
        self.tables.refresh()
        run_id = self.audit.start_run(run_id)
        scratch = Scratch(self.spark)
        try:
            at = now()
            # The feeds do not depend on each other; small ones use what a large one leaves idle.
            with ThreadPoolExecutor(len(_FEEDS)) as threads:
                providers, patients, claims = threads.map(
                    lambda name: self.stage(_FEEDS[name], feeds[name], options), _FEEDS
                )
            # Nor do the dimensions.
            dimensions = (
                (c.PROVIDER, providers, c.provider_merge(options.fold_case)),
                (c.PATIENT, patients, c.patient_merge(options.fold_case)),
            )
            with ThreadPoolExecutor(len(dimensions)) as threads:
                list(threads.map(lambda d: self.upsert_dimension(*d, at, scratch), dimensions))
            rejects = self.upsert_claims(claims, run_id, at, options, scratch)
            staged = {"provider": providers.rows, "patient": patients.rows, "claim": claims.rows}
            final = {
                "provider": self.tables.row_count(c.PROVIDER),
                "patient": self.tables.row_count(c.PATIENT),
                "claim": self.tables.row_count(c.CLAIM),
            }
            self.audit.update_run_counts(run_id, staged, final, rejects)
            self.audit.finish_run(run_id, "SUCCESS")
        except BaseException as error:
            try:
                self.audit.finish_run(run_id, "FAILED")
            except Exception as e:  # noqa: BLE001 - the first error is the one to raise
                error.add_note(f"the failure of run {run_id} could not be recorded: {e}")
            raise
        finally:
            scratch.drop()
            if self._views:
                self.register_views()
        # Fixed text.
        message = (
            f"Run {run_id} complete. Final Claim rows: {final['claim']}. Rejects this run: {rejects}"
        )
        print(message)
        return self.spark.createDataFrame(
            [(run_id, "SUCCESS", final["claim"], rejects, message)],
            "RunID bigint, Status string, ClaimCount bigint, RejectTotal bigint, Message string",
        )
