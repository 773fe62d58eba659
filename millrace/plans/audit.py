"""Run history: an append-only log of starts, counts and ends, folded to a row per run."""

from __future__ import annotations

import random
import time
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import append_row, appended_rows

COUNT_COLUMNS = [
    "StgProviderCount", "StgPatientCount", "StgClaimCount",
    "ProviderCount", "PatientCount", "ClaimCount", "RejectTotal",
]

STATUSES = ("SUCCESS", "FAILED", "PARTIAL")

_COLUMNS = {
    "RunID": "bigint",
    "Event": "string",
    "Sequence": "bigint",
    "At": "timestamp",
    "Status": "string",
    **{c: "bigint" for c in COUNT_COLUMNS},
}
_LOG = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


def now() -> datetime:
    return datetime.now(timezone.utc)


def fold_runs(log: DataFrame) -> DataFrame:
    """One row per run. An end or counts older than the last start belong to an earlier try."""
    at_event = {
        event: F.max(F.when(F.col("Event") == event, F.col("Sequence"))).alias(f"_{event}")
        for event in ("START", "COUNTS", "FINISH")
    }

    def latest(column: str, event: str) -> Column:
        return F.max_by(
            F.when(F.col("Event") == event, F.col(column)),
            F.when(F.col("Event") == event, F.col("Sequence")),
        )

    folded = log.groupBy("RunID").agg(
        *at_event.values(),
        latest("At", "START").alias("StartedAt"),
        latest("At", "FINISH").alias("EndedAt"),
        latest("Status", "FINISH").alias("Status"),
        *[latest(c, "COUNTS").alias(c) for c in COUNT_COLUMNS],
    )
    ended, counted = F.col("_FINISH") > F.col("_START"), F.col("_COUNTS") > F.col("_START")
    return folded.filter(F.col("_START").isNotNull()).select(
        "RunID",
        "StartedAt",
        F.when(ended, F.col("EndedAt")).alias("EndedAt"),
        F.when(ended, F.col("Status")).alias("Status"),
        *[F.when(counted, F.col(c)).alias(c) for c in COUNT_COLUMNS],
    )


class RunAudit:
    """The run log under one path. Each call appends one file; nothing is rewritten.

    Ids are claimed by folders ``RunID=n/<token>`` beside the log. A starter puts its own there and
    then looks who else did. Of two starters the one that looks later sees the other's, so at most
    one finds itself alone and has the id; the others take a higher one.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = f"{path}/events"
        self._claims = f"{path}/ids"
        spark.createDataFrame([], _LOG).write.mode("ignore").json(self.path)
        spark.createDataFrame([], "token string").write.mode("ignore").json(self._claims)

    def runs(self) -> DataFrame:
        return fold_runs(appended_rows(self.spark, _LOG, self.path))

    def _append(self, run_id: int, event: str, **values: object) -> None:
        row = {"RunID": run_id, "Event": event, "Sequence": time.time_ns(), "At": now(), **values}
        columns = [F.lit(row.get(n)).cast(kind).alias(n) for n, kind in _COLUMNS.items()]
        append_row(self.spark, columns, self.path)

    def start_run(self, run_id: int | None = None) -> int:
        """Open a run under an id of its own, or again under its own id for a retry."""
        if run_id is None:
            while not self._claim(run_id := self._highest_id() + 1):
                time.sleep(random.uniform(0, 1))
        else:
            self._claim(run_id)
        self._append(run_id, "START")
        return run_id

    def _claimed(self, path: str) -> DataFrame:
        """Ids and tokens from the names of files below ``path``; none is opened."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        name = r"/RunID=(\d+)/([0-9a-f]+)/"
        return files.select(
            F.regexp_extract("path", name, 1).try_cast("bigint").alias("RunID"),
            F.regexp_extract("path", name, 2).alias("token"),
        )

    def _highest_id(self) -> int:
        return self._claimed(self._claims).agg(F.max("RunID")).first()[0] or 0

    def _claim(self, run_id: int) -> bool:
        """Whether the id is this starter's alone."""
        token, path = uuid.uuid4().hex, f"{self._claims}/RunID={run_id}"
        self.spark.range(0, 1, 1, 1).select(F.lit(token).alias("token")).write.json(f"{path}/{token}")
        return {row["token"] for row in self._claimed(path).distinct().collect()} == {token}

    def update_run_counts(
        self, run_id: int, staged: Mapping[str, int], final: Mapping[str, int], rejects: int
    ) -> None:
        """Record the seven counters; a count that is not given is 0."""
        feeds = ("provider", "patient", "claim")
        counts = [*[staged.get(f, 0) for f in feeds], *[final.get(f, 0) for f in feeds], rejects]
        self._append(run_id, "COUNTS", **dict(zip(COUNT_COLUMNS, counts)))

    def finish_run(self, run_id: int, status: str) -> None:
        if status not in STATUSES:
            raise ValueError(f"unknown run status: {status}")
        self._append(run_id, "FINISH", Status=status)
