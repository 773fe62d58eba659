"""Reporting views over rejects and run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LATEST_RUNS = 50


def utc_date(at: Column) -> Column:
    """The day of a timestamp in UTC, whatever the session's time zone."""
    return F.to_date(F.to_utc_timestamp(at, F.current_timezone()))


def rejects_by_date_and_rule(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy(utc_date(F.col("IngestedAt")).alias("IngestDate"), "RuleCode").agg(
        F.count("*").alias("RejectCount")
    )


def rejects_by_run_and_rule(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("RunID", "RuleCode").agg(F.count("*").alias("RejectCount"))


def summaries_by_date_and_rule(counts: DataFrame) -> DataFrame:
    """The same from the counts stored with each run: reads a row per run and rule, no rejects."""
    return counts.groupBy("IngestDate", "RuleCode").agg(F.sum("RejectCount").alias("RejectCount"))


def summaries_by_run_and_rule(counts: DataFrame) -> DataFrame:
    return counts.select("RunID", "RuleCode", "RejectCount")


def latest_runs(runs: DataFrame, count: int = LATEST_RUNS) -> DataFrame:
    """The newest runs, newest first; planned as a top-k, not as a sort of all runs."""
    return runs.orderBy(F.desc("RunID")).limit(count)


def rejects_of_run(rejects: DataFrame, run_id: int) -> DataFrame:
    """Rejects of one run; only that run's partition is read."""
    return rejects.filter(F.col("RunID") == run_id)


def rejects_in_last_day(rejects: DataFrame, as_of: datetime) -> DataFrame:
    """Rejects per rule in the 24 hours up to ``as_of``, in rule order."""
    at = F.lit(as_of).cast("timestamp")
    recent = (F.col("IngestedAt") >= at - F.expr("interval 24 hours")) & (F.col("IngestedAt") <= at)
    return (
        rejects.filter(recent).groupBy("RuleCode").agg(F.count("*").alias("RejectCount")).orderBy("RuleCode")
    )
