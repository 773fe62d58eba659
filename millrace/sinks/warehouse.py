"""Keyed parquet tables whose new files become visible by one appended log file."""

from __future__ import annotations

import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from millrace.schemas import TableSpec
from millrace.session import COMPACT, append_row, appended_rows, write_observed

_VERSION = "table_version"  # directory level, kept out of the rows
WHOLE = ""  # the one partition of a table that has no partition column

_ATTEMPT = "table_attempt"  # column of added rows, kept out of the rows
_ENTRY = {
    "table": "string", "version": "bigint", "parts": "array<string>", "row_count": "bigint",
    "max_id": "bigint", "empty": "boolean", "batch": "bigint", "day": "date", "counts": "map<string, bigint>",
}
_LOG = f"entries array<struct<{', '.join(f'{n}: {kind}' for n, kind in _ENTRY.items())}>>"


@dataclass(frozen=True)
class Written:
    """New content of some partitions, not visible before it is committed.

    ``row_count`` is that of the whole table afterwards, ``max_id`` the highest new id.
    ``empty`` says that the partitions have no rows, and so no files, from now on. For rows that
    are only added, ``batch`` names them, ``version`` the attempt that wrote them, which replaces
    earlier ones of the batch, and ``counts`` sums them up: rows by a code, on a ``day``.
    """

    table: str
    version: int
    parts: Sequence[str]
    row_count: int | None = None
    max_id: int | None = None
    empty: bool = False
    batch: int | None = None
    day: date | None = None
    counts: Mapping[str, int] = field(default_factory=dict)


@dataclass
class TableState:
    """What the log says about a table: a version per partition, a count, the last id."""

    versions: dict[str, int] = field(default_factory=dict)
    empty: set[str] = field(default_factory=set)
    row_count: int = 0
    max_id: int = 0

    @property
    def last_version(self) -> int:
        return max(self.versions.values(), default=0)


class Warehouse:
    """Tables under one root, with a single writer at a time.

    A write puts the new content of the touched partitions beside the old files. ``commit``
    appends one small file to the log that names, for all tables changed together, the
    version to read from then on. Before that readers see nothing of it, and a failed write
    leaves nothing but unread files that the next attempt overwrites.
    """

    def __init__(self, spark: SparkSession, root: str, settings: Mapping[str, object] | None = None):
        """``settings`` are stored when the folder is new; an older folder keeps its own."""
        self.spark = spark
        self.root = root.rstrip("/")
        self._log_path = f"{self.root}/log"
        self.settings = self._stored(settings or {})
        spark.createDataFrame([], _LOG).write.mode("ignore").json(self._log_path)
        self._state: dict[str, TableState] = {}
        self.refresh()

    def _stored(self, settings: Mapping[str, object]) -> dict[str, str]:
        path = self.path("settings")
        names, values = F.lit(list(settings)), F.lit([str(v) for v in settings.values()])
        pairs = [F.map_from_arrays(names.cast("array<string>"), values.cast("array<string>")).alias("settings")]
        self.spark.range(0, 1, 1, 1).select(*pairs).write.mode("ignore").json(path)
        return self.spark.read.schema("settings map<string, string>").json(path).first()["settings"] or {}

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def log(self) -> DataFrame:
        """One row per commit and table."""
        return appended_rows(self.spark, _LOG, self._log_path).select(F.inline("entries"))

    def refresh(self) -> None:
        """Read the state of all tables: a version per partition, as many as there are.

        Batches of added rows are no partitions; of them the log alone keeps a row each.
        """
        log = self.log()
        latest = (
            log.filter("batch is null")
            .select("table", "version", "empty", F.explode("parts").alias("part"))
            .groupBy("table", "part")
            .agg(F.max("version").alias("version"), F.max_by("empty", "version").alias("empty"))
        )
        totals = log.groupBy("table").agg(
            F.max_by("row_count", "version").alias("row_count"), F.max("max_id").alias("max_id")
        )
        self._state = {}
        for row in totals.join(latest, "table", "left").collect():
            state = self._state.setdefault(row["table"], TableState())
            state.row_count, state.max_id = row["row_count"] or 0, row["max_id"] or 0
            if row["part"] is None:
                continue
            state.versions[row["part"]] = row["version"]
            if row["empty"]:
                state.empty.add(row["part"])

    def state(self, spec: TableSpec) -> TableState:
        return self._state.setdefault(spec.name, TableState())

    def snapshot(self, spec: TableSpec, parts: Sequence[str] | None = None) -> DataFrame:
        """The visible rows of a table, or of some of its partitions.

        Columns added to the specification later are NULL in older files.
        """
        state = self.state(spec)
        versions, wanted = state.versions, set(state.versions if parts is None else parts)
        current = [p for p in versions if p in wanted and p not in state.empty]
        if not current:
            return self.spark.createDataFrame([], spec.schema)
        base = self.path(spec.name)
        paths = [
            f"{base}/{_VERSION}={versions[p]}" + (f"/{spec.partition_col}={p}" if spec.partition_col else "")
            for p in sorted(current)
        ]
        schema = StructType([*spec.schema.fields, StructField(_VERSION, IntegerType())])
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths).drop(_VERSION)

    # -- rows that are only added -----------------------------------------------------

    def append(
        self, spec: TableSpec, df: DataFrame, metrics: Mapping[str, Column] | None = None
    ) -> tuple[int, dict[str, object]]:
        """Add the rows of a batch to the folders of their partitions; returns the attempt.

        All batches share these folders, so there are as many as there are partitions. Each file
        has rows of one batch and attempt, by which readers skip the others. The rows are written
        where they are: a batch has few partitions, so few files come of a task.
        """
        attempt = time.time_ns()
        rows = df.select(*spec.columns, F.lit(attempt).alias(_ATTEMPT))
        observation = Observation()
        observed = {"rows": F.count(F.lit(1)), "max_id": F.max(spec.id_col), **(metrics or {})}
        observed["parts"] = F.collect_set(spec.partition_col)
        rows = rows.observe(observation, *[c.alias(n) for n, c in observed.items()])
        writer = rows.write.mode("append").option("compression", COMPACT)
        writer.partitionBy(spec.partition_col).parquet(self.path(spec.name))
        return attempt, dict(observation.get)

    def batches(self, spec: TableSpec) -> DataFrame:
        """One row per batch: the attempt that counts, its partitions, its day and its counts."""
        newest = F.max_by(F.struct("version", "parts", "day", "counts"), "version").alias("newest")
        own = self.log().filter((F.col("table") == spec.name) & F.col("batch").isNotNull())
        return own.groupBy("batch").agg(newest).select("batch", "newest.*")

    def added(self, spec: TableSpec) -> DataFrame:
        """The rows of all committed batches."""
        batches = self.batches(spec).select(F.col("batch").alias("_batch"), F.col("version").alias("_version"))
        visible = (F.col(spec.batch_col) == F.col("_batch")) & (F.col(_ATTEMPT) == F.col("_version"))
        return self._files(spec).join(batches, visible, "left_semi").drop(_ATTEMPT)

    def added_by(self, spec: TableSpec, batch: int) -> DataFrame:
        """The rows of one batch, from the folders and files that have some."""
        found = self.batches(spec).filter(F.col("batch") == batch).first()
        if found is None or not found["parts"]:
            return self._files(spec).filter(F.lit(False)).drop(_ATTEMPT)
        own = (F.col(spec.batch_col) == batch) & (F.col(_ATTEMPT) == found["version"])
        parts = F.col(spec.partition_col).isin(found["parts"])
        return self._files(spec).filter(parts & own).drop(_ATTEMPT)

    def _files(self, spec: TableSpec) -> DataFrame:
        schema = StructType([*spec.schema.fields, StructField(_ATTEMPT, LongType())])
        self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(spec.name))
        return self.spark.read.schema(schema).parquet(self.path(spec.name))

    # -- counts, ids, commits ---------------------------------------------------------

    def row_count(self, spec: TableSpec) -> int:
        """Rows of a table, known without a scan."""
        return self.state(spec).row_count

    def next_id(self, spec: TableSpec) -> int:
        """One more than any id ever given out."""
        return self.state(spec).max_id + 1

    def write(
        self, spec: TableSpec, df: DataFrame, parts: Sequence[str] = (WHOLE,)
    ) -> tuple[int, int, int | None]:
        """Write the whole new content of ``parts``; returns version, rows and highest id.

        The rows are gathered by partition first, a large one over several tasks: that keeps
        the files few, and a partition that has most of the rows from being one task.
        """
        version = self.state(spec).last_version + 1
        rows = df.select(*spec.columns)
        if spec.partition_col:
            rows = rows.hint("rebalance", spec.partition_col)
        _, found = write_observed(
            rows,
            self.path(spec.name, f"{_VERSION}={version}"),
            {"rows": F.count(F.lit(1)), "max_id": F.max(spec.id_col)},
            partition_col=spec.partition_col,
        )
        return version, found["rows"], found["max_id"]

    def commit(self, written: Iterable[Written]) -> None:
        """Make written files of any number of tables visible at once."""
        written = list(written)
        if not written:
            return
        entries = F.array(
            *[F.struct(*[_literal(getattr(w, n), kind).alias(n) for n, kind in _ENTRY.items()]) for w in written]
        )
        append_row(self.spark, [entries.alias("entries")], self._log_path)
        for w in written:
            state = self._state.setdefault(w.table, TableState())
            if w.batch is None:
                state.versions.update({part: w.version for part in w.parts})
                state.empty = state.empty - set(w.parts) | (set(w.parts) if w.empty else set())
            state.row_count = w.row_count or 0
            state.max_id = max(state.max_id, w.max_id or 0)


def _literal(value: object, kind: str) -> Column:
    if isinstance(value, Mapping):
        pairs = [F.lit(x) for pair in value.items() for x in pair]
        return F.create_map(*pairs).cast(kind) if pairs else F.lit(None).cast(kind)
    return F.lit(list(value) if isinstance(value, Sequence) and not isinstance(value, str) else value).cast(kind)
