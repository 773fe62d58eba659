"""Names for columns that operators add for themselves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fresh(taken: Sequence[str], *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from those taken.

    Case does not tell names apart, as by default in Spark.
    """
    used = {t.lower() for t in taken}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")
