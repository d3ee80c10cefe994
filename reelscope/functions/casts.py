"""Safe conversions: bad input gives null, never an error (ANSI stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The catalog's date text looks like "September 9, 2019".
ADDED_DATE_PATTERN = "MMMM d, yyyy"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_long(c) -> Column:
    return _c(c).try_cast("bigint")


def safe_int(c) -> Column:
    return _c(c).try_cast("int")


def parse_added_date(c, trim: bool = True) -> Column:
    """English month-name date to DATE; unparseable → null."""
    v = F.trim(_c(c)) if trim else _c(c)
    return F.try_to_date(v, ADDED_DATE_PATTERN)


def epoch_to_timestamp(c) -> Column:
    """Epoch seconds (possibly fractional) to TIMESTAMP."""
    v = _c(c)
    return F.timestamp_micros((v * F.lit(1_000_000)).cast("bigint"))


def to_id(c) -> Column:
    """Number to string id (X11)."""
    return _c(c).cast("string")
