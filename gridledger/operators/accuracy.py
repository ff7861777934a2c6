"""Forecast-versus-actual accuracy.

``interval_accuracy`` is the per-series, per-UTC-day accuracy of interval
forecasts; ``latest_capture_accuracy`` pairs each actual with the most
recent forecast capture made for its date.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exact import exact_mean


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def interval_accuracy(df: DataFrame, keys: Sequence[str], ts_col: str, forecast_col: str,
                      actual_col: str, start=None, end=None, bucket: str = "day",
                      day_name: str = "day", digits: int | None = None,
                      ratio_digits: int = 9) -> DataFrame:
    """Per (keys, UTC ``bucket``): count, mean bias, MAE and MAPE (%) over rows with an actual.

    * bias  = mean(actual - forecast)
    * MAE   = mean(|actual - forecast|)
    * MAPE  = mean(|actual - forecast| / nullif(actual, 0)) * 100 (zero actuals skipped)

    ``start``/``end`` (half-open on ``ts_col``) are applied *before* the
    aggregation so they reach the Parquet scan; a filter on the derived day
    column would not push down.

    With ``digits`` the means are exact and reproducible (``functions.exact``):
    errors in units of ``10**-digits``, percentage ratios in units of
    ``10**-ratio_digits``; without it they are plain double averages.
    """
    rows = df.filter(_c(actual_col).isNotNull())
    if start is not None:
        rows = rows.filter(_c(ts_col) >= F.lit(start))
    if end is not None:
        rows = rows.filter(_c(ts_col) < F.lit(end))
    err = _c(actual_col) - _c(forecast_col)
    day = F.date_trunc(bucket, _c(ts_col))
    day = F.to_date(day) if bucket == "day" else day
    ratio = F.abs(err) / F.nullif(_c(actual_col), F.lit(0))
    if digits is None:
        means = [F.avg(err), F.avg(F.abs(err)), F.avg(ratio) * 100]
    else:
        means = [exact_mean(err, digits), exact_mean(F.abs(err), digits), exact_mean(ratio, ratio_digits) * 100]
    names = ["mean_bias", "mean_abs_error", "mean_abs_pct_error"]
    return (rows.groupBy(*keys, day.alias(day_name))
                .agg(F.count(F.lit(1)).alias("interval_count"), *[m.alias(n) for m, n in zip(means, names)]))


def latest_capture_accuracy(actual: DataFrame, forecast: DataFrame, actual_key: str,
                            forecast_key: str, capture_col: str, actual_col: str,
                            forecast_col: str, out_key: str | None = None) -> DataFrame:
    """Actual joined with the forecast whose capture time is the latest for that key.

    Ties on the latest capture keep every tied forecast row (as a correlated
    ``= (select max ...)`` does). There is deliberately no "captured before
    the target date" bound: the latest capture wins even in hindsight.

    Plan: a map-side-combined ``max`` per key, a semi join to keep only the
    latest captures, then the equi join to the actuals. No window sorts all
    captures of a key in one task.
    """
    latest = forecast.groupBy(forecast_key).agg(F.max(capture_col).alias("_max_capture"))
    # ``>=`` the key's maximum is the same rows as ``=`` (nothing exceeds the max), but keeps the key
    # as the only equi-join key: the forecasts are shuffled once, by key, and that partitioning is
    # reused by the join to the actuals instead of a second shuffle on (key, capture).
    kept = forecast.join(latest, (forecast[forecast_key] == latest[forecast_key])
                         & (forecast[capture_col] >= latest["_max_capture"]), "left_semi")
    out_key = out_key or actual_key
    a = actual.select(_c(actual_key).alias(out_key), _c(actual_col).alias("actual"))
    f = kept.select(_c(forecast_key).alias(out_key), _c(capture_col).alias("captured_at"),
                    _c(forecast_col).alias("forecast"))
    return (a.join(f, out_key)
             .withColumn("bias", F.col("actual") - F.col("forecast"))
             .withColumn("abs_error", F.abs(F.col("actual") - F.col("forecast"))))
