"""Normalisation: interval shaping, in-batch dedup, station-day means."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_mean
from ..functions.timeparse import parse_datetime, shift_hours, US_DATETIME
from .keyed import latest_per_key


def interval_from_end(df: DataFrame, end_text_col: str, start_col: str = "interval_start_utc",
                      end_col: str = "interval_end_utc", hours: int = 1,
                      fmt: str = US_DATETIME) -> DataFrame:
    """Parse the UTC interval end and derive the start (end minus ``hours``).

    Only the UTC end is trusted, so there is no daylight-saving arithmetic.
    Unparseable text yields NULL ends, which the caller's contract rejects.
    """
    end = parse_datetime(end_text_col, fmt)
    return (df.withColumn(end_col, end)
              .withColumn(start_col, shift_hours(F.col(end_col), -hours)))


def dedup_keep_last(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """In-batch dedup on ``keys`` keeping the last row in ``order_cols`` order.

    For file input the order is ``(file_seq, line_no)`` captured at scan time.
    """
    return latest_per_key(df, keys, order_cols)


def station_day_mean(df: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                     first_col: str | None = None, order_col: str | None = None,
                     count_name: str = "readings", digits: int | None = None) -> DataFrame:
    """Group-level means that skip NULLs, a reading count and a deterministic ``first``.

    ``first_col`` is taken from the row with the smallest ``order_col``
    (``min_by``), not from whichever row a task happens to see first.
    ``digits`` switches the means to the exact, order-independent form.
    """
    mean = F.avg if digits is None else (lambda c: exact_mean(c, digits))
    aggs = [mean(c).alias(f"avg_{c}") for c in value_cols]
    aggs.append(F.count(F.lit(1)).alias(count_name))
    if first_col:
        aggs.append(F.min_by(F.col(first_col), F.col(order_col or first_col)).alias(f"first_{first_col}"))
    return df.groupBy(*keys).agg(*aggs)
