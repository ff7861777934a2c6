"""Reproducible sums and means.

A double ``avg`` depends on summation order, which depends on partitioning
(and AQE may repartition between runs), so the last bits of a mean can change
from run to run and differ from any other engine. Here each value is quantised
to integer units of ``10**-digits`` (``floor(x * 10**digits + 0.5)``), the
units are summed exactly, so order does not matter, and one fixed sequence of
double operations finishes. For data with at most ``digits`` decimals the
result is the true mean rounded; otherwise the quantisation error is below
``10**-digits`` per value, or the value's own last bit if that is more.

A unit count does not fit one BIGINT for large values, so it is split into two
limbs of ``2**31`` (both exact on the double: dividing by a power of two and
taking the remainder lose nothing), each with its own BIGINT sum. Over the
double range:

* values and sums below ``2**93`` units in size (9.9e27): right, with an error
  of two roundings of the total at most;
* NaN, or infinities of both signs: NaN; infinities of one sign: that infinity;
* finite values beyond, or more rows in a group than a limb's sum can hold: an
  error that names the function and its bound (``overflow="null"``: NULL).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LIMB = float(2 ** 31)
BOUND = float(2 ** 93)      # of a value, in units: its upper limb stays below 2**62


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _limbs(col: Column, digits: int) -> tuple[Column, Column]:
    """Upper and lower limb of the units; NULL for NULL and for values that are out of bounds."""
    scaled = col.cast("double") * F.lit(float(10 ** digits)) + F.lit(0.5)
    inside = F.when(F.abs(scaled) < F.lit(BOUND), scaled)       # NaN is greater than any number
    upper = F.floor(inside / F.lit(LIMB))
    return upper, F.floor(inside - upper.cast("double") * F.lit(LIMB))


def _finished(col: Column, digits: int, divide_by: Column | None, overflow: str) -> Column:
    upper, lower = (F.try_sum(limb) for limb in _limbs(col, digits))
    total = upper.cast("double") * F.lit(LIMB) + lower.cast("double")
    if divide_by is not None:
        total = total / divide_by
    least, most = F.min(col.cast("double")), F.max(col.cast("double"))
    up, down = most == F.lit(float("inf")), least == F.lit(float("-inf"))
    scaled = F.greatest(F.abs(least * F.lit(float(10 ** digits)) + F.lit(0.5)), F.abs(most * F.lit(float(10 ** digits)) + F.lit(0.5)))
    beyond = (scaled >= F.lit(BOUND)) | upper.isNull() | lower.isNull()
    if overflow == "error":
        too_large = F.raise_error(F.lit(f"exact sum: beyond 2^93 units of 10^-{digits}")).cast("double")
    elif overflow == "null":
        too_large = F.lit(None).cast("double")
    else:
        raise ValueError(f"overflow is 'error' or 'null', not {overflow!r}")
    return (F.when(F.count(col) == 0, F.lit(None).cast("double"))
             .when(F.isnan(most) | (up & down), F.lit(float("nan")))
             .when(up | down, F.when(up, most).otherwise(least))
             .when(beyond, too_large)
             .otherwise(total / F.lit(float(10 ** digits))))


def exact_sum(col, digits: int, overflow: str = "error") -> Column:
    """Order-independent sum, returned in the original scale as a double (NULL without values)."""
    return _finished(_c(col), digits, None, overflow)


def exact_mean(col, digits: int, overflow: str = "error") -> Column:
    """Order-independent mean over non-NULL values (NULL when there are none)."""
    return _finished(_c(col), digits, F.count(_c(col)).cast("double"), overflow)


def exact_mean_sql(expr: str, digits: int) -> str:
    """The mean of finite values as SQL text (used by the DuckDB oracles): one wide sum instead of two limbs.

    The wide sum is exact too; its two limbs are taken from it at the end, for the same roundings.
    """
    scale = f"{float(10 ** digits)!r}"
    total = f"sum(CAST(floor(({expr}) * {scale} + 0.5) AS HUGEINT))"
    lower = f"sum(CAST(floor(({expr}) * {scale} + 0.5) AS HUGEINT) & 2147483647)"
    upper = f"(({total}) - ({lower})) // 2147483648"
    return (f"CASE WHEN count({expr}) > 0 THEN (CAST({upper} AS DOUBLE) * 2147483648.0 + CAST({lower} AS DOUBLE)) "
            f"/ CAST(count({expr}) AS DOUBLE) / {scale} END")
