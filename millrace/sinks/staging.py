"""Staging: overwrite, contract checks and counts in the pass that writes the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.keyfilter import KeyColumns
from millrace.operators.resolve import hot_hashes, hot_key_metric, hot_share
from millrace.schemas import TableSpec
from millrace.session import COMPACT, write_observed
from millrace.sources.feeds import WIDTH, Feed

ROW_SEQUENCE = "_row_sequence"
_BROKEN = "_breaks_contract"


class ContractError(ValueError):
    """Rows that the staging table must not hold."""


@dataclass(frozen=True)
class Staged:
    """A written staging table; ``ROW_SEQUENCE`` numbers its rows, with gaps.

    ``parts`` are the partitions of the final table that its rows belong to, if asked for.
    """

    df: DataFrame
    rows: int
    partitions: int
    hot: Mapping[str, list[int]] = field(default_factory=dict)
    parts: Sequence[str] = ()


def contract_metrics(spec: TableSpec) -> dict[str, Column]:
    """Per rule of the contract, how far the rows break it; NULL or 0 when they do not."""
    metrics: dict[str, Column] = {}
    for f in spec.fields:
        if f.required:
            metrics[f"{f.name} is missing"] = F.count_if(F.col(f.name).isNull())
        if f.max_length is not None:
            metrics[f"{f.name} is longer than {f.max_length}"] = F.count_if(
                F.char_length(f.name) > f.max_length
            )
    return metrics


def breaks_contract(spec: TableSpec) -> Column:
    """Whether a row breaks any rule of the contract."""
    broken = [F.col(f.name).isNull() for f in spec.fields if f.required]
    broken += [
        F.coalesce(F.char_length(f.name) > f.max_length, F.lit(False))
        for f in spec.fields
        if f.max_length is not None
    ]
    return reduce(lambda a, b: a | b, broken, F.lit(False))


def check_contract(df: DataFrame, spec: TableSpec) -> None:
    """Which rules of the contract the rows of a table break, as an error."""
    broken = [row for row in contract_violations(df, spec).collect() if row["row_count"]]
    if broken:
        rows = ", ".join(f"{row['rule']} in {row['row_count']} rows" for row in broken)
        raise ContractError(f"{spec.name}: {rows}")


def contract_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per rule of the contract with the number of rows that break it."""
    metrics = contract_metrics(spec)
    counted = df.agg(*[c.alias(f"m{i}") for i, c in enumerate(metrics.values())])
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"m{i}").alias("row_count"))
            for i, name in enumerate(metrics)
        ]
    )
    return counted.select(F.inline(pairs))


def load_staging(
    feed: Feed | DataFrame,
    spec: TableSpec,
    path: str,
    probes: Mapping[str, KeyColumns] | None = None,
    part: Column | None = None,
) -> Staged:
    """Replace the staging table at ``path`` by typed rows and check them.

    One job reads, converts, counts, checks and writes. An empty feed, a row of the wrong
    width, a missing required value or too long a text is an error. ``part`` computes the
    partition of the final table, of which there are few, from a row.
    """
    df = feed.df if isinstance(feed, Feed) else feed
    probes = probes or {}
    # One flag per row, made in generated code; metrics are not, so there are few of them.
    metrics: dict[str, Column] = {"rows": F.count(F.lit(1)), "broken": F.count_if(_BROKEN)}
    metrics["last_sequence"] = F.max(F.shiftrightunsigned(ROW_SEQUENCE, 33))
    if isinstance(feed, Feed):
        metrics["widest"] = feed.width_metric()
    for name, probe in probes.items():
        metrics[f"hot {name}"] = hot_key_metric(
            df, list(probe.columns), probe.rule, list(probe.dim_columns)
        )
    if part is not None:
        metrics["parts"] = F.collect_set(part)
    width = [WIDTH] if WIDTH in df.columns else []
    rows = df.select(*spec.columns, *width).withColumns(
        {ROW_SEQUENCE: F.monotonically_increasing_id(), _BROKEN: breaks_contract(spec)}
    )
    written, found = write_observed(rows, path, metrics, codec=COMPACT)
    if not found["rows"]:
        raise ValueError(f"{spec.name}: refusing to load an empty feed")
    if isinstance(feed, Feed):
        feed.check_width(found["widest"])
    if found["broken"]:
        check_contract(written, spec)
    share = hot_share(df.sparkSession)
    hot = {name: hot_hashes(found[f"hot {name}"], found["rows"], share) for name in probes}
    parts = sorted(found.get("parts") or [])
    return Staged(written.drop(WIDTH, _BROKEN), found["rows"], found["last_sequence"] + 1, hot, parts)


def export_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    batch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
    columns: Sequence[str] | None = None,
) -> None:
    """Write to a table of a relational database; ``overwrite`` truncates and refills it."""
    (
        df.select(*(columns or df.columns))
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=batch_rows, truncate=True, **(properties or {}))
        .mode(mode)
        .save()
    )
