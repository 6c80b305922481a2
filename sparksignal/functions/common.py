"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip and \s treat as white space, as characters and as a Java pattern.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
SPACE_CLASS = r"[\s\x1c-\x1f]"

_SPACE_RUN = rf"(?U){SPACE_CLASS}+"
_VISIBLE = r"(?U)[^\s\x1c-\x1f]"


def strip(col: Column) -> Column:
    """Trim all Unicode white space at both ends, line breaks included."""
    return F.trim(col, F.lit(SPACES))


def squeeze(col: Column) -> Column:
    """Replace every run of Unicode white space by one blank."""
    return F.regexp_replace(col, _SPACE_RUN, " ")


def collapse(col: Column) -> Column:
    """``squeeze`` and trim: words joined by single blanks."""
    return F.trim(squeeze(col))


def is_blank(col: Column) -> Column:
    """NULL, empty or only white space; looks no further than the first other character."""
    return col.isNull() | ~col.rlike(_VISIBLE)


def fail_if(condition: Column, message: str, value: Column) -> Column:
    """``value``, or an error for the rows where ``condition`` holds.

    The check sits inside the value, so it runs whenever the value is used.
    """
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(value)


def rows_where(value: Column, keep) -> Column:
    """Generator of one row with ``value`` if ``keep`` accepts it, else of none.

    Unlike a filter on a computed column, ``value`` is computed once per row:
    a filter would be pushed below the projection and compute it again.
    """
    return F.explode(F.filter(F.array(value), keep))
