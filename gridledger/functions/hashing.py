"""Content fingerprints and landing names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fingerprint length shown in landing names and messages.
SHA_PREFIX_LEN = 12
UNKNOWN_CAPTURE = "unknown"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def content_sha(col) -> Column:
    """Hex SHA-256 of text or binary content."""
    return F.sha2(_c(col), 256)


def sha_prefix(col, n: int = SHA_PREFIX_LEN) -> Column:
    return F.substring(_c(col), 1, n)


def capture_name(ts_text) -> Column:
    """Landing name derived from a capture-time string: drop ``:``, ``.`` and spaces.

    A missing capture time lands under ``unknown``.
    """
    return F.coalesce(F.regexp_replace(_c(ts_text), r"[:. ]", ""), F.lit(UNKNOWN_CAPTURE))
