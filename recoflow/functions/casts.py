"""String -> typed column functions (P5-P10).

All casts are ``try_cast``: with ANSI mode on (the Spark 4 default) a plain cast
raises on the first bad string, so a single malformed review would fail a whole
job. ``try_cast`` returns NULL and the row is routed by the NULL filters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_int_id(col: Column | str) -> Column:
    """P5: ID string -> int; bad, empty, fractional or out-of-range -> NULL."""
    return _c(col).try_cast("int")


def to_label(col: Column | str) -> Column:
    """Label string -> 1.0 / 0.0 via boolean; unknown spellings -> NULL.

    Accepts true/t/yes/y/1 and false/f/no/n/0, any case, trimmed.
    """
    return _c(col).try_cast("boolean").cast("double")


def label_to_int(col: Column | str) -> Column:
    """Boolean label -> 0/1 int."""
    return to_label(col).cast("int")


def to_double(col: Column | str) -> Column:
    """Numeric string -> double; bad -> NULL."""
    return _c(col).try_cast("double")


def to_hours_or_zero(col: Column | str) -> Column:
    """P10: coerce to a number, anything unparseable (NULL or NaN) -> 0.0."""
    # The cast also takes Java's type suffixes ('5d', '5f'), which are no numbers here.
    plain = F.when(~_c(col).cast("string").rlike(r"[0-9.][dDfF]\s*$"), _c(col))
    parsed = F.coalesce(to_double(plain), F.lit(0.0))
    return F.nanvl(parsed, F.lit(0.0))
