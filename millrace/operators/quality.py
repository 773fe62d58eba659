"""Row-level rules evaluated in one pass, and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROKEN_RULES = "_broken_rules"


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when ``broken`` is true; NULL, as in SQL, does not count."""

    code: str
    broken: Column
    reason: Column


def _bit(position: int) -> int:
    return 1 << position


def evaluate_rules(df: DataFrame, gate: Rule | None, rules: Sequence[Rule]) -> DataFrame:
    """Add ``BROKEN_RULES``, a bit per broken rule; bit 0 is the gate.

    A row that breaks the gate is not tested against the other rules. The bits stay
    within generated code, which an array of codes would not.
    """
    bits = [
        F.when(rule.broken, F.lit(_bit(i))).otherwise(F.lit(0)) for i, rule in enumerate(rules, start=1)
    ]
    broken = reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0))
    if gate is not None:
        broken = F.when(gate.broken, F.lit(_bit(0))).otherwise(broken)
    return df.withColumn(BROKEN_RULES, broken.cast("bigint"))


def reject_rows(df: DataFrame, gate: Rule | None, rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule, with ``RuleCode``, ``Reason`` and the rule's position.

    Copies of a row are all kept. Only rows that break a rule are expanded.
    """
    numbered = [*([(0, gate)] if gate is not None else []), *enumerate(rules, start=1)]
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("RulePosition"), F.lit(r.code).alias("RuleCode"), r.reason.alias("Reason")
            )
            for i, r in numbered
        ]
    )
    broken = F.col(BROKEN_RULES)
    return (
        df.filter(broken != 0)
        .withColumn("_rule", F.explode(entries))
        .filter(F.getbit(broken, F.col("_rule.RulePosition")) == 1)
        .select(*[c for c in df.columns if c != BROKEN_RULES], "_rule.*")
    )


def valid_rows(df: DataFrame, required: Sequence[str] = ()) -> DataFrame:
    """Rows that break no rule and have every required value."""
    present = [F.col(c).isNotNull() for c in required]
    return df.filter(reduce(lambda a, b: a & b, present, F.col(BROKEN_RULES) == 0)).drop(BROKEN_RULES)
