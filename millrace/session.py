"""Session settings and the shared scratch area used to cut lineage."""

from __future__ import annotations

import itertools
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Codec of intermediate and reject tables, which are most of what a run writes. Dimensions keep
#: Spark's own: by the size of their files Spark decides what to broadcast.
COMPACT = "zstd"

_local_scratch: dict[str, str] = {}
#: Folders of scratch tables that this process has made and not dropped.
_kept: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("millrace")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a ``local`` master, where every task sees the same disk, gets a temporary
    folder when the setting is absent.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="millrace-")
    return _local_scratch[context.applicationId]


class Scratch:
    """Intermediate tables in the shared folder.

    A written table survives the loss of any executor and is read back column-pruned,
    unlike a cached frame. ``drop`` removes the tables once nothing reads them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{scratch_root(spark)}/millrace-{uuid.uuid4().hex}"
        self._numbers = itertools.count()
        _kept.add(self.path)

    def write(
        self, df: DataFrame, metrics: dict[str, Column] | None = None, codec: str | None = COMPACT
    ) -> tuple[DataFrame, dict[str, object]]:
        """Write ``df`` once, returning the written table and metrics of that same pass."""
        # Steps that do not depend on each other write at the same time: taking a number is atomic.
        path = f"{self.path}/t{next(self._numbers)}"
        return write_observed(df, path, metrics, codec=codec)

    def drop(self) -> None:
        """Remove the tables. Nothing that reads them may be used afterwards."""
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        hadoop_path.getFileSystem(conf).delete(hadoop_path, True)
        _kept.discard(self.path)


def drop_scratch(spark: SparkSession) -> int:
    """Remove the scratch tables of all results computed so far; returns the number of folders.

    Operators whose result is read from such tables cannot know when it has been used.
    """
    paths = sorted(_kept)
    for path in paths:
        scratch = Scratch(spark)
        _kept.discard(scratch.path)
        scratch.path = path
        scratch.drop()
    return len(paths)


def write_observed(
    df: DataFrame,
    path: str,
    metrics: dict[str, Column] | None = None,
    partition_col: str | None = None,
    codec: str | None = None,
) -> tuple[DataFrame, dict[str, object]]:
    """Overwrite ``path`` with ``df``; aggregate ``metrics`` while the rows stream past."""
    spark = df.sparkSession
    observation = Observation()
    rows = df.observe(observation, *[c.alias(n) for n, c in metrics.items()]) if metrics else df
    writer = rows.write.mode("overwrite")
    writer = writer.option("compression", codec) if codec else writer
    (writer.partitionBy(partition_col) if partition_col else writer).parquet(path)
    found = dict(observation.get) if metrics else {}
    return spark.read.schema(df.schema).parquet(path), found


def append_row(spark: SparkSession, columns: list[Column], path: str) -> None:
    """Append one row of literals as one file, which appears whole or not at all.

    It gets a folder of its own: writers that share one remove each other's unfinished files.
    """
    own = f"{path}/{time.time_ns()}-{uuid.uuid4().hex}"
    spark.range(0, 1, 1, 1).select(*columns).write.json(own)


def appended_rows(spark: SparkSession, schema: str, path: str) -> DataFrame:
    """The rows that ``append_row`` put below ``path``."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).json(path)
