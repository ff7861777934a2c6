"""The four source datasets: read layout, contract, normaliser, keys.

Each dataset is data, not code paths: the generic ingest job
(``plans.ingest``) runs any of them. Every read is all-STRING; typing is a
``try_cast`` inside ``prepare`` so a malformed value becomes a quarantined
row with a reason, never a failed job.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules as R
from ..functions.timeparse import parse_datetime, parse_iso_instant, shift_hours
from ..operators.contracts import Contract
from ..operators.normalize import station_day_mean
from ..sources.files import FILE_NAME, string_schema

# Source column names, allowed values and bounds of the four sources.
LOAD_COLUMNS = ("Interval", "GMTIntervalEnd", "MTLF", "Averaged Actual", "BAA")
LOAD_SERIES = ("SPP", "SWPW")
DAILY_STATUS = ("complete", "partial", "missing")
TEMP_MIN_C, TEMP_MAX_C = -90, 60
PCT_MIN, PCT_MAX = 0, 100


@dataclass(frozen=True)
class Dataset:
    name: str
    fmt: str                                   # "csv" or "json"
    contract: Contract
    keys: tuple[str, ...]
    date_col: str                              # partition column (UTC event date) of the fact
    date_source: str                           # fact column the event date derives from
    fact_columns: tuple[str, ...]
    prepare: Callable[[DataFrame], DataFrame]  # raw scan -> typed rows the rules inspect
    finish: Callable[[DataFrame], DataFrame]   # accepted rows -> fact rows (dedup/aggregate)
    landing: str = "versioned"                 # "immutable" | "versioned" | "capture"
    watermark: str = "run"                     # "data": latest event date loaded; "run": run date
    json_schema: T.StructType | None = None
    explode: str | None = None                 # array column flattened after the scan
    parents: tuple[str, ...] = ()
    order_cols: tuple[str, ...] = ("_file_order", "_line_order")
    max_gap_seconds: int | None = None         # a grid: readings of a series (keys but the last) this far apart at most


# ---------------------------------------------------------------- load (CSV)

def _load_prepare(df: DataFrame) -> DataFrame:
    end = parse_datetime("GMTIntervalEnd")
    return (df.withColumn("interval_end_utc", end)
              .withColumn("interval_start_utc", shift_hours(F.col("interval_end_utc"), -1))
              .withColumn("load_forecast_mw", R.try_number("MTLF"))
              .withColumn("load_actual_mw", R.try_number("Averaged Actual"))
              .withColumn("baa", F.col("BAA")))


def _load_finish(df: DataFrame) -> DataFrame:
    from ..operators.normalize import dedup_keep_last
    return dedup_keep_last(df, ["baa", "interval_start_utc"], ["_file_order", "_line_order"])


LOAD = Dataset(
    name="spp_load",
    fmt="csv",
    contract=Contract(
        name="load_forecast_actual",
        columns=LOAD_COLUMNS,
        strict=True,
        rules=(
            R.not_null("Interval"),
            R.not_null("GMTIntervalEnd"),
            R.Rule("GMTIntervalEnd:ts_unparseable",
                   lambda: F.col("GMTIntervalEnd").isNotNull() & F.col("interval_end_utc").isNull()),
            R.not_null("MTLF"),
            R.coerced("MTLF", "load_forecast_mw", "double"),
            R.ge("load_forecast_mw", 0),
            R.coerced("Averaged Actual", "load_actual_mw", "double"),
            R.ge("load_actual_mw", 0),
            R.not_null("BAA"),
            R.isin("BAA", LOAD_SERIES),
        )),
    keys=("baa", "interval_start_utc"),
    date_col="event_date",
    date_source="interval_start_utc",
    fact_columns=("baa", "interval_start_utc", "interval_end_utc", "load_forecast_mw", "load_actual_mw"),
    prepare=_load_prepare,
    finish=_load_finish,
    landing="immutable",
    watermark="data",
    max_gap_seconds=3600,
)


# ---------------------------------------------------------------- daily production summary (JSON)

DAILY_SCHEMA = string_schema(["date", "system", "solar_production_kwh", "completeness_pct", "data_status",
                              "ingested_at", "source"])


def _daily_prepare(df: DataFrame) -> DataFrame:
    return (df.withColumn("day", F.col("date").try_cast("date"))
              .withColumn("solar_production_kwh_n", R.try_number("solar_production_kwh"))
              .withColumn("completeness_pct_n", R.try_number("completeness_pct")))


def _daily_finish(df: DataFrame) -> DataFrame:
    from ..operators.normalize import dedup_keep_last
    out = df.select(F.col("day").alias("date"), F.col("solar_production_kwh_n").alias("solar_production_kwh"),
                    F.col("completeness_pct_n").alias("completeness_pct"), "data_status",
                    FILE_NAME, "_file_order", "_line_order")
    return dedup_keep_last(out, ["date"], ["_file_order", "_line_order"])


DAILY = Dataset(
    name="household_solar",
    fmt="json",
    contract=Contract(
        name="daily_summary",
        columns=("date", "system", "solar_production_kwh", "ingested_at"),
        optional=("completeness_pct", "data_status", "source"),
        rules=(
            R.not_null("date"),
            R.Rule("date:not_a_date", lambda: F.col("date").isNotNull() & F.col("day").isNull()),
            R.not_null("system"),
            R.not_null(FILE_NAME),
            R.not_null("ingested_at"),
            R.not_missing("solar_production_kwh"),
            R.coerced_value("solar_production_kwh", "solar_production_kwh_n", "double"),
            R.ge("solar_production_kwh_n", 0),
            R.coerced_value("completeness_pct", "completeness_pct_n", "double"),
            R.in_range("completeness_pct_n", PCT_MIN, PCT_MAX),
            R.isin("data_status", DAILY_STATUS),
        )),
    keys=("date",),
    date_col="event_date",
    date_source="date",
    fact_columns=("date", "solar_production_kwh", "completeness_pct", "data_status"),
    prepare=_daily_prepare,
    finish=_daily_finish,
    json_schema=DAILY_SCHEMA,
)


# ---------------------------------------------------------------- weather readings (JSON, nested)

READING = T.StructType([T.StructField("timestamp_local", T.StringType()),
                        T.StructField("sky_cover_pct", T.StringType()),
                        T.StructField("temperature_c", T.StringType())])
WEATHER_SCHEMA = T.StructType([T.StructField("date", T.StringType()), T.StructField("station", T.StringType()),
                               T.StructField("readings", T.ArrayType(READING)),
                               T.StructField("recorded_at_utc", T.StringType())])


def _weather_prepare(df: DataFrame) -> DataFrame:
    return (df.withColumn("day", F.col("date").try_cast("date"))
              .withColumn("sky_cover_pct_n", R.try_number("sky_cover_pct"))
              .withColumn("temperature_c_n", R.try_number("temperature_c")))


def _weather_finish(df: DataFrame) -> DataFrame:
    ordered = df.withColumnRenamed("day", "date_d").withColumn("_row_order", F.struct("_file_order", "_line_order"))
    m = station_day_mean(ordered, ["date_d", "station"],
                         ["temperature_c_n", "sky_cover_pct_n"], first_col=FILE_NAME, order_col="_row_order")
    return m.select(F.col("date_d").alias("date"), "station",
                    F.col("avg_temperature_c_n").alias("avg_temperature_c"),
                    F.col("avg_sky_cover_pct_n").alias("avg_sky_cover_pct"),
                    F.col("readings"), F.col(f"first_{FILE_NAME}").alias(FILE_NAME))


WEATHER = Dataset(
    name="weather_actual",
    fmt="json",
    contract=Contract(
        name="weather_reading",
        columns=("date", "station", "timestamp_local"),
        rules=(
            R.not_null("date"),
            R.Rule("date:not_a_date", lambda: F.col("date").isNotNull() & F.col("day").isNull()),
            R.not_null("station"),
            R.not_null("timestamp_local"),
            R.not_null(FILE_NAME),
            R.coerced_value("sky_cover_pct", "sky_cover_pct_n", "double"),
            R.in_range("sky_cover_pct_n", PCT_MIN, PCT_MAX),
            R.coerced_value("temperature_c", "temperature_c_n", "double"),
            R.in_range("temperature_c_n", TEMP_MIN_C, TEMP_MAX_C),
        )),
    keys=("date", "station"),
    date_col="event_date",
    date_source="date",
    fact_columns=("date", "station", "avg_temperature_c", "avg_sky_cover_pct"),
    prepare=_weather_prepare,
    finish=_weather_finish,
    json_schema=WEATHER_SCHEMA,
    explode="readings",
    parents=("date", "station"),
)


# ---------------------------------------------------------------- production forecast (JSON document)

PROJECTION = T.StructType([T.StructField("date", T.StringType()),
                           T.StructField("expected_units_w_m2h", T.StringType()),
                           T.StructField("hours_in_forecast", T.StringType()),
                           T.StructField("projected_kwh", T.StringType())])
FORECAST_SCHEMA = T.StructType([T.StructField("generated_at_utc", T.StringType()),
                                T.StructField("model_version", T.StringType()),
                                T.StructField("projection_days", T.ArrayType(PROJECTION))])


def _forecast_prepare(df: DataFrame) -> DataFrame:
    return (df.withColumn("forecast_for_date", F.col("date").try_cast("date"))
              .withColumn("captured_at_utc", parse_iso_instant("generated_at_utc"))
              .withColumn("forecast_kwh", R.try_number("projected_kwh")))


def _forecast_finish(df: DataFrame) -> DataFrame:
    from ..operators.normalize import dedup_keep_last
    out = df.select("forecast_for_date", "captured_at_utc", "forecast_kwh", FILE_NAME, "_file_order", "_line_order")
    return dedup_keep_last(out, ["forecast_for_date", "captured_at_utc"], ["_file_order", "_line_order"])


FORECAST = Dataset(
    name="household_solar_forecast",
    fmt="json",
    contract=Contract(
        name="production_forecast",
        columns=("forecast_for_date", "captured_at_utc", "forecast_kwh"),
        rules=(
            R.not_null("forecast_for_date"),
            R.not_null("captured_at_utc"),
            R.not_null(FILE_NAME),
            R.not_null("forecast_kwh"),
            R.coerced_value("projected_kwh", "forecast_kwh", "double"),
            R.ge("forecast_kwh", 0),
        )),
    keys=("forecast_for_date", "captured_at_utc"),
    date_col="event_date",
    date_source="forecast_for_date",
    fact_columns=("forecast_for_date", "captured_at_utc", "forecast_kwh"),
    prepare=_forecast_prepare,
    finish=_forecast_finish,
    landing="capture",
    json_schema=FORECAST_SCHEMA,
    explode="projection_days",
    parents=("generated_at_utc",),
)


DATASETS = {d.name: d for d in (LOAD, DAILY, WEATHER, FORECAST)}

