"""The periodic quality sweep: full-table completeness + source freshness, recorded as a run.

Independent of ingest timing, it re-checks the *whole* current load fact for
gaps (not just the latest batch), derives every source's freshness from the
run ledger, writes both check results, and logs its own run with its real
status -- ``failed`` (and the error) when a check raises, never a blanket
``success``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.upsert import BATCH_SEQ, write_batch
from .datasets import LOAD, Dataset
from .ingest import Store

SWEEP_SOURCE = "quality_sweep"


def run_quality_sweep(store: Store, run_id: str, batch_seq: int, as_of: _dt.datetime,
                      interval_dataset: Dataset = LOAD, series_keys=("baa",), ts_col: str = "interval_start_utc",
                      max_gap_seconds: int = 3600,
                      max_age_hours: int = quality.STALE_AFTER_HOURS) -> DataFrame:
    """Run both checks, record them and the sweep's run row; returns the check rows."""
    spark = store.spark
    try:
        facts = store.current_facts(interval_dataset)
        if facts is None:
            gaps = spark.createDataFrame([], "k string")
        else:
            gaps = quality.detect_gaps(facts, list(series_keys), ts_col, max_gap_seconds)
        completeness = quality.completeness_result(gaps, run_id, as_of)
        runs = store.runs().filter(F.col("source") != SWEEP_SOURCE)
        state = quality.freshness_state(runs, seq_col=BATCH_SEQ, watermark_col="watermark_after")
        stale = quality.stale_sources(state, as_of, max_age_hours)
        freshness = quality.sweep_result(stale, run_id, as_of).drop("stale_count")
        checks = completeness.unionByName(freshness)
        write_batch(checks, store.path("ledger", "checks"), batch_seq, scope=SWEEP_SOURCE)
        status, error = quality.SUCCESS, None
    except Exception as exc:  # noqa: BLE001 -- recorded below, then re-raised
        status, error = quality.FAILED, str(exc)
        raise
    finally:
        store.record_run(run_id=run_id, source=SWEEP_SOURCE, **{BATCH_SEQ: int(batch_seq)}, started_at=as_of,
                         finished_at=as_of, status=status, error=error)
    return spark.read.parquet(store.path("ledger", "checks")).filter(
        (F.col("source") == SWEEP_SOURCE) & (F.col(BATCH_SEQ) == int(batch_seq)))
