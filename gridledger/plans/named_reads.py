"""Named reads over a store: a fixed query, checked parameters, a row cap and an envelope, in one call.

``answer`` takes a frame of requests (id, two dates as text and, for reads by series, the series) and gives two
frames: the records of all requests and one envelope row per request, the refused ones included with the reason.
``read`` is the case of one request. There is no way to pass a query: a read is one of ``READS``.

A store without facts answers every valid request with no records. Both frames are built on one state of the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import accuracy, quality, reads
from .datasets import DAILY, FORECAST, LOAD, LOAD_SERIES
from .ingest import Store
from .sweep import SWEEP_SOURCE

UNKNOWN_READ = "unknown read"


@dataclass(frozen=True)
class NamedRead:
    """``build`` gives the frame that the read answers from; ``series`` its key column, if requests name one."""
    source: str
    build: Callable[[Store], DataFrame | None]
    day: str
    order: Sequence[str]
    columns: Sequence[str]
    types: str                       # of the columns, for a store without facts
    series: str | None = None
    allowed: Sequence[str] = ()


def _household_accuracy(store: Store) -> DataFrame | None:
    actual, forecast = store.current_facts(DAILY), store.current_facts(FORECAST)
    if actual is None or forecast is None:
        return None
    return accuracy.latest_capture_accuracy(actual, forecast, "date", "forecast_for_date", "captured_at_utc",
                                            "solar_production_kwh", "forecast_kwh")


def _load_accuracy(store: Store) -> DataFrame | None:
    load = store.current_facts(LOAD)
    return None if load is None else accuracy.interval_accuracy(load, ["baa"], "interval_start_utc", "load_forecast_mw", "load_actual_mw")


READS = {
    "household_solar_history": NamedRead(
        "household_solar", lambda s: s.current_facts(DAILY), "date", ("date",),
        ("date", "solar_production_kwh", "completeness_pct", "data_status"),
        "date date, solar_production_kwh double, completeness_pct double, data_status string"),
    "household_solar_forecast": NamedRead(
        "household_solar_forecast", lambda s: s.current_facts(FORECAST), "forecast_for_date", ("forecast_for_date", "captured_at_utc"),
        ("forecast_for_date", "captured_at_utc", "forecast_kwh"), "forecast_for_date date, captured_at_utc timestamp, forecast_kwh double"),
    "household_forecast_accuracy": NamedRead(
        "household_forecast_accuracy", _household_accuracy, "date", ("date",), (), "date date"),
    "spp_load_conditions": NamedRead(
        "load_forecast_actual", lambda s: s.current_facts(LOAD), "interval_start_utc", ("interval_start_utc", "baa"),
        ("baa", "interval_start_utc", "interval_end_utc", "load_forecast_mw", "load_actual_mw"),
        "baa string, interval_start_utc timestamp, interval_end_utc timestamp, load_forecast_mw double, load_actual_mw double",
        "baa", LOAD_SERIES),
    "spp_load_forecast_accuracy": NamedRead(
        "load_forecast_accuracy", _load_accuracy, "day", ("day", "baa"), (), "baa string, day date", "baa", LOAD_SERIES),
}


def answer(store: Store, name: str, requests: DataFrame, as_of, cap: int = reads.MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """``(records, envelopes)`` for requests ``rid, start_text, end_text`` and, where the read has one, ``series``.

    Records carry ``rid`` and ``row_in_request``, at most ``cap`` per request in the read's order; an envelope has
    ``request_status``, the period, the counts and the limitations (see ``reads.read_envelope``).
    """
    if name not in READS:
        raise ValueError(f"{UNKNOWN_READ}: {name}")
    spec = READS[name]
    facts = spec.build(store.pinned())
    if facts is None:
        facts = store.spark.createDataFrame([], spec.types)
    columns = list(spec.columns) or facts.columns
    series = spec.series or "_all"
    if spec.series is None:
        facts, requests = facts.withColumn(series, F.lit("all")), requests.withColumn("series", F.lit("all"))
    asked = reads.guard_requests(requests, "start_text", "end_text", "series", spec.allowed or ("all",))
    facts = facts.select(*dict.fromkeys([*columns, series]))
    records = reads.bulk_read(asked, facts, "rid", "series", series, spec.day, list(spec.order), cap)
    envelopes = reads.read_envelope(asked, facts, "rid", "series", series, spec.day, cap, spec.source, as_of)
    return records.select("rid", "row_in_request", *columns), envelopes


def read(store: Store, name: str, start: str, end: str, as_of, series: str | None = None,
         cap: int = reads.MAX_ROWS) -> tuple[DataFrame, DataFrame]:
    """One request: its records in order, and its envelope row."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("rid", "start_text", "end_text", "series")])
    one = store.spark.createDataFrame([("1", start, end, series)], schema)
    records, envelope = answer(store, name, one, as_of, cap)
    return records.orderBy("row_in_request").drop("rid", "row_in_request"), envelope.drop("rid")


def read_health(store: Store) -> DataFrame:
    """One row per source: last success, last attempt, watermark and status (the sweep is no source)."""
    runs = store.runs().filter(F.col("source") != SWEEP_SOURCE)
    return quality.freshness_state(runs, seq_col="_batch_seq", watermark_col="watermark_after")


def read_quality(store: Store, cap: int = reads.MAX_ROWS) -> DataFrame | None:
    """The newest check results; None before the first check."""
    checks = store.read("ledger", "checks")
    return None if checks is None else reads.newest(checks, [F.col("checked_at").desc(), F.col("run_id").desc()], cap)
