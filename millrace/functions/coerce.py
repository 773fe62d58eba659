"""Type coercion: bad text becomes NULL, impossible values stop the load."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip_text

DATE_PATTERN = "yyyy-M-d"

# Patterns that read a date of four, two and two digits as a cast does.
_ISO_PATTERNS = ("yyyy-M-d", "yyyy-MM-dd")

# The whole days a nanosecond timestamp can hold.
FIRST_DATE = "1677-09-22"
LAST_DATE = "2262-04-11"

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INFINITY = r"(?i)^\s*[+-]?inf(inity)?\s*$"
_DECIMAL = re.compile(r"decimal\((\d+),\s*(\d+)\)")


def to_text(c: Column, null_text: str | None = None) -> Column:
    """Stripped text; a missing value stays NULL unless ``null_text`` replaces it."""
    text = strip_text(c.cast("string"))
    return text if null_text is None else F.coalesce(text, F.lit(null_text))


def _finite(c: Column) -> Column:
    """True for text that is a plain number within the range of a double."""
    return c.rlike(_NUMBER) & (F.abs(c.try_cast("double")) < F.lit(float("inf")))


def to_double(c: Column) -> Column:
    c = c.cast("string")
    return F.when(_finite(c) | c.rlike(_INFINITY), c.try_cast("double"))


def to_decimal(c: Column, precision: int, scale: int) -> Column:
    """Exact decimal, rounded half up; a number too large for the type is an error."""
    c = c.cast("string")
    kind = f"decimal({precision},{scale})"
    too_large = F.raise_error(F.concat(F.lit(f"number out of range for {kind}: "), c)).cast(kind)
    exact = c.try_cast(kind)
    # Most amounts are spelled as the type spells them, which is quicker to see than to match.
    return F.when(exact.cast("string") == c, exact).when(_finite(c), F.coalesce(exact, too_large))


def to_bigint(c: Column) -> Column:
    """Whole number; text that is no number is NULL, a number that is not whole an error."""
    c = c.cast("string")
    exact = c.try_cast("decimal(38,18)")
    not_whole = F.raise_error(F.concat(F.lit("not a 64-bit whole number: "), c)).cast("bigint")
    whole = F.when(exact == F.floor(exact), exact.try_cast("bigint"))
    return F.when(_finite(c) | c.rlike(_INFINITY), F.coalesce(whole, not_whole))


def _in_nanoseconds(value: Column, nanoseconds: bool) -> Column:
    if not nanoseconds:
        return value
    first, last = F.lit(FIRST_DATE).cast("date"), F.lit(LAST_DATE).cast("date")
    return F.when(value.cast("date").between(first, last), value)


def to_date(c: Column, pattern: str = DATE_PATTERN, nanoseconds: bool = False) -> Column:
    """Date when the whole text, blanks included, has exactly the pattern.

    ``nanoseconds`` turns dates that a nanosecond timestamp cannot hold into NULL.
    """
    c = c.cast("string")
    value = F.try_to_date(c, pattern)
    if pattern in _ISO_PATTERNS:
        # Most dates are spelled as a cast spells them, which is quicker than the pattern.
        iso = c.try_cast("date")
        common = (iso.cast("string") == c) & iso.between(F.lit("0001-01-01").cast("date"), F.lit("9999-12-31").cast("date"))
        value = F.when(common, iso).when(c != "", value)
    return _in_nanoseconds(value, nanoseconds)


def to_timestamp(c: Column, pattern: str = DATE_PATTERN, nanoseconds: bool = False) -> Column:
    return _in_nanoseconds(F.try_to_timestamp(c.cast("string"), F.lit(pattern)), nanoseconds)


def vote_date_patterns(df: DataFrame, columns: Sequence[str], patterns: Sequence[str]) -> dict[str, str]:
    """For each column of text the pattern that fits most of its values, in one aggregate.

    All values vote, so neither their order nor a stray first value decides. Of patterns that fit
    equally many the first one listed is taken, also if none fits anything.
    """
    votes = [
        F.count_if(F.try_to_timestamp(F.col(f"`{c}`").cast("string"), F.lit(p)).isNotNull()).alias(f"v{i}_{j}")
        for i, c in enumerate(columns)
        for j, p in enumerate(patterns)
    ]
    found = df.agg(*votes).first()
    return {
        c: max(enumerate(patterns), key=lambda jp: (found[f"v{i}_{jp[0]}"], -jp[0]))[1]
        for i, c in enumerate(columns)
    }


def coerce_column(
    c: Column,
    target: str,
    null_text: str | None = None,
    date_pattern: str = DATE_PATTERN,
    nanoseconds: bool = False,
) -> Column:
    decimal = _DECIMAL.fullmatch(target)
    if decimal:
        return to_decimal(c, int(decimal[1]), int(decimal[2]))
    if target == "date":
        return to_date(c, date_pattern, nanoseconds)
    if target.startswith("datetime"):
        return to_timestamp(c, date_pattern, nanoseconds)
    if target == "float":
        return to_double(c)
    if target == "int":
        return to_bigint(c)
    return to_text(c, null_text)


def coerce_types(
    df: DataFrame,
    mapping: dict[str, str],
    null_text: str | None = None,
    date_pattern: str | Mapping[str, str] = DATE_PATTERN,
    nanoseconds: bool = False,
) -> DataFrame:
    """Coerce the mapped columns in one projection; columns that are absent are skipped.

    Targets: ``str``, ``float``, ``int``, ``decimal(p,s)``, ``date``, ``datetime...``;
    anything else is read as ``str``. ``date_pattern`` may differ by column, see
    ``vote_date_patterns``.
    """
    patterns = {c: date_pattern if isinstance(date_pattern, str) else date_pattern.get(c, DATE_PATTERN) for c in mapping}
    return df.select(
        *[
            coerce_column(F.col(f"`{c}`"), mapping[c], null_text, patterns[c], nanoseconds).alias(c)
            if c in mapping
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )
