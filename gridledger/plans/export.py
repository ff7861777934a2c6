"""Windowed snapshot exports, published as one set, and the read side over them.

Seven fixed outputs. One run writes all of them into a directory of its own and then points at it:

    sets/<id>/<name>/records     JSON lines, written by the executors
    sets/<id>/<name>/envelope    one JSON row: source, generated_at, record_count, limitations, schema of the records
    pointers/<n>                 the id of the n-th set that was finished; created last, by one run only

A reader follows the highest pointer, so it sees the outputs of one finished run: never the records of one run with
the envelope of another, nor a set whose run died. ``record_count`` is observed by the write that makes the records,
and all frames of a set are built on one state of the ledger. ``as_of`` is always passed in; nothing reads the clock.
Earlier sets stay where they are, so a reader that holds one can finish.
"""

from __future__ import annotations

import datetime as _dt
import json as _json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import accuracy, quality, reads
from ..operators.commits import create_if_absent, list_names, path_exists, read_text
from ..sources.files import read_snapshot
from .datasets import DAILY, FORECAST, LOAD
from .ingest import Store
from .sweep import SWEEP_SOURCE

# Export windows and names.
HISTORY_WINDOW_DAYS = 90
FORECAST_WINDOW_DAYS = 14
QUALITY_ROWS = 100
LIMITATIONS = reads.LIMITATION


ENVELOPE_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("generated_at", T.TimestampType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("known_limitations", T.ArrayType(T.StringType())),
    T.StructField("record_schema", T.StringType()),
])

# Instants as text with all their digits (the writer's own formats stop at milliseconds).
INSTANT_FORMATS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}

# Outcomes of reading an export.
AVAILABLE = "ok"
NOT_AVAILABLE = "export_not_available"
CORRUPT = "export_corrupt"


def _write_records(df: DataFrame, path: str) -> int:
    """Write the records; how many there were is observed by this very write."""
    seen = Observation(f"export-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.options(**INSTANT_FORMATS).json(path)
    return int(seen.get.get("n", 0))


def _write_envelope(spark: SparkSession, path: str, source: str, as_of, count: int, schema: T.StructType) -> None:
    row = spark.createDataFrame([(source, count, schema.json())], "source string, record_count bigint, record_schema string")
    row.select("source", F.lit(as_of).cast("timestamp").alias("generated_at"), "record_count",
               F.array(F.lit(LIMITATIONS)).alias("known_limitations"), "record_schema").coalesce(1).write.json(path)


def publish(spark: SparkSession, frames: dict[str, tuple[str, DataFrame]], out_dir: str, as_of) -> str:
    """Write ``name -> (source, frame)`` as one set and point at it; returns the set's id.

    A run that dies on the way leaves a directory that no pointer names. Of runs that finish at once each has a
    pointer number of its own, and the last to finish is what readers see.
    """
    root = out_dir.rstrip("/")
    export_id = uuid.uuid4().hex
    for name, (source, df) in frames.items():
        base = f"{root}/sets/{export_id}/{name}"
        count = _write_records(df, f"{base}/records")
        _write_envelope(spark, f"{base}/envelope", source, as_of, count, df.schema)
    number = max(_pointers(spark, root), default=0) + 1
    while not create_if_absent(spark, f"{root}/pointers/{number}", f"{export_id}\n"):
        number += 1
    return export_id


def _pointers(spark: SparkSession, root: str) -> list[int]:
    return [int(n) for n in list_names(spark, f"{root}/pointers") if n.isdigit()]


def latest_set(spark: SparkSession, out_dir: str) -> str | None:
    """The id of the set that was published last; None if there is none."""
    root = out_dir.rstrip("/")
    for number in sorted(_pointers(spark, root), reverse=True):
        text = read_text(spark, f"{root}/pointers/{number}")
        if text.endswith("\n"):             # a pointer being written counts from its last byte on
            return text.strip()
    return None


@dataclass
class Export:
    status: str
    envelope: Row | None
    records: DataFrame | None


def read_export(spark: SparkSession, out_dir: str, name: str, export_id: str | None = None) -> Export:
    """One export of the last published set, or of the set ``export_id`` (to read several of the same set).

    ``export_not_available`` when there is no set or it lacks the name, ``export_corrupt`` when a record or the
    envelope does not parse; both come without records.
    """
    export_id = export_id or latest_set(spark, out_dir)
    base = f"{out_dir.rstrip('/')}/sets/{export_id}/{name}"
    if export_id is None or not path_exists(spark, f"{base}/envelope"):
        return Export(NOT_AVAILABLE, None, None)
    envelope, status = read_snapshot(spark, f"{base}/envelope", ENVELOPE_SCHEMA)
    found = envelope.limit(2).collect() if status == AVAILABLE else []
    if len(found) != 1 or found[0]["record_schema"] is None:
        return Export(CORRUPT, None, None)
    records, status = read_snapshot(spark, f"{base}/records", T.StructType.fromJson(_json.loads(found[0]["record_schema"])))
    return Export(status, found[0] if status == AVAILABLE else None, records if status == AVAILABLE else None)


def export_frames(store: Store, as_of: _dt.date) -> dict[str, tuple[str, DataFrame]]:
    """The seven export frames (lazy), all on the ledger as it is now; a source without facts has no frame."""
    store = store.pinned()
    out: dict[str, tuple[str, DataFrame]] = {}
    daily = store.current_facts(DAILY)
    fc = store.current_facts(FORECAST)
    load = store.current_facts(LOAD)
    if daily is not None:
        hist = reads.trailing_window(daily, "date", as_of, HISTORY_WINDOW_DAYS)
        out["household_solar_history"] = ("household_solar", hist.select(
            "date", "solar_production_kwh", "completeness_pct", "data_status", "ingested_at").orderBy("date"))
    if fc is not None:
        win = reads.forward_window(fc, "forecast_for_date", as_of, FORECAST_WINDOW_DAYS)
        out["household_solar_forecast"] = ("household_solar_forecast", win.select(
            "forecast_for_date", "captured_at_utc", "forecast_kwh", "ingested_at").orderBy("forecast_for_date"))
    if daily is not None and fc is not None:
        acc = accuracy.latest_capture_accuracy(daily, fc, "date", "forecast_for_date", "captured_at_utc",
                                               "solar_production_kwh", "forecast_kwh")
        out["household_forecast_accuracy"] = ("household_forecast_accuracy", reads.trailing_window(
            acc, "date", as_of, HISTORY_WINDOW_DAYS).orderBy("date"))
    if load is not None:
        lo = F.date_sub(F.lit(as_of).cast("date"), HISTORY_WINDOW_DAYS).cast("timestamp")
        recent = load.filter(F.col("interval_start_utc") >= lo)
        out["spp_load_conditions"] = ("load_forecast_actual", recent.select(
            "baa", "interval_start_utc", "interval_end_utc", "load_forecast_mw", "load_actual_mw")
            .orderBy("baa", "interval_start_utc"))
        out["spp_load_forecast_accuracy"] = ("load_forecast_accuracy", accuracy.interval_accuracy(
            load, ["baa"], "interval_start_utc", "load_forecast_mw", "load_actual_mw", start=lo)
            .orderBy("baa", "day"))
    runs = store.runs().filter(F.col("source") != SWEEP_SOURCE)     # the sweep is no source
    out["source_health"] = ("source_freshness", quality.freshness_state(runs, seq_col="_batch_seq",
                                                                       watermark_col="watermark_after"))
    checks = store.read("ledger", "checks")
    if checks is not None:
        out["data_quality"] = ("data_quality_results", reads.newest(
            checks, [F.col("checked_at").desc(), F.col("run_id").desc()], QUALITY_ROWS))
    return out


def export_all(store: Store, out_dir: str, as_of: _dt.date) -> list[str]:
    """Publish every available export as one set; returns the names written."""
    frames = export_frames(store, as_of)
    publish(store.spark, frames, out_dir, as_of)
    return sorted(frames)
