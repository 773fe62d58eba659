"""Text clean-up expressed with built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The cell texts pandas.read_csv treats as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip_text(c: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only removes blanks)."""
    return F.btrim(c, F.lit(WHITESPACE))


def na_to_null(c: Column, tokens: tuple[str, ...] = NA_TOKENS) -> Column:
    """NULL for a cell whose whole text is one of the missing-value tokens."""
    return F.when(~c.isin(*tokens), c) if tokens else c
