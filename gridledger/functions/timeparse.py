"""Timestamp and date helpers (all UTC; the session zone is pinned)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The load source's timestamp text layout.
US_DATETIME = "MM/dd/yyyy HH:mm:ss"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_datetime(col, fmt: str = US_DATETIME) -> Column:
    """Parse text as a UTC instant; unparseable text gives NULL, never an error."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))


def parse_iso_instant(col) -> Column:
    """ISO-8601 text with an offset (``2026-01-01T15:00:00+00:00``) to an instant."""
    return _c(col).try_cast("timestamp")


def parse_iso_date(col) -> Column:
    """Strict ``YYYY-MM-DD`` text to DATE: Spark's cast alone accepts looser text."""
    c = _c(col)
    return F.when(c.rlike(ISO_DATE_PATTERN), c.try_cast("date"))


def shift_hours(col, hours: int) -> Column:
    return _c(col) + F.expr(f"INTERVAL {int(hours)} HOURS")


def as_instant(col) -> Column:
    """Normalise ``timestamp_ntz`` (driver tables) and ``timestamp`` to one type.

    With the session zone pinned to UTC the cast is value preserving.
    """
    return _c(col).cast("timestamp")


def utc_day(col) -> Column:
    return F.to_date(_c(col))


def hour_bucket(col) -> Column:
    return F.date_trunc("hour", _c(col))
