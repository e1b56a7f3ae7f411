"""Casts that turn malformed values into NULL instead of failing the job.

Spark 4 runs with ANSI mode on, where ``cast('abc' as double)`` raises. The cleaning
rules expect a bad value to become NULL and the row to be filtered or kept, so every
cast here is a ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_int_score(c: Column | str) -> Column:
    """String or number -> int, truncating a fraction ('5.7' -> 5); junk -> NULL."""
    return _col(c).try_cast("double").try_cast("int")


def to_timestamp(c: Column | str) -> Column:
    """String -> timestamp without time zone; junk -> NULL. A UTC offset in the text is
    kept: the result is then the wall clock of the session's time zone (UTC by default)."""
    return _col(c).try_cast("timestamp").cast("timestamp_ntz")
