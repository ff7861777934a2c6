"""Quality checks: interval gaps, completeness, freshness, run accounting, backfill status.

Gap detection is the one place a literal translation would not scale: the
natural ``lag(ts) over (partition by series order by ts)`` puts each series
in a single task, and the reference data has two series. Here it is exact
and shuffle-light instead:

1. Cut time into buckets exactly ``max_gap`` wide. Two timestamps in the
   same bucket are less than ``max_gap`` apart, so a gap (strictly greater
   than ``max_gap``) can only separate *different* buckets.
2. Aggregate each (series, bucket) to ``min(ts), max(ts)``. This is a hash
   aggregate with map-side combine: the rows never shuffle, only one small
   row per bucket per input partition does.
3. A gap is a pair of consecutive non-empty buckets whose ``min`` minus the
   previous bucket's ``max`` exceeds ``max_gap``. Pairs come from a two-level
   lag over the (already tiny) bucket frame: ``lag`` inside groups of
   ``fanout`` buckets, and ``lag`` over group summaries for the pairs that
   straddle two groups. No window partition holds more than ``fanout`` rows
   per series at the first level, and the second level has ``fanout`` times
   fewer rows than there are buckets; no join is needed.

The output equals the per-row ``lag`` form: one row per hole, however many
intervals are missing; edges (before the first / after the last reading)
are not checked; nothing is interpolated.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Check names, statuses and detail texts.
CHECK_COMPLETENESS = "missing_interval_completeness"
CHECK_FRESHNESS = "source_freshness_sweep"
PASS = "pass"
FAIL = "fail"
FRESH = "fresh"
STALE = "stale"
FAILING = "failing"
SUCCESS = "success"
FAILED = "failed"
STALE_AFTER_HOURS = 25


def _micros(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_micros(c.cast("timestamp"))


def detect_gaps(df: DataFrame, keys: Sequence[str], ts_col: str, max_gap_seconds: int = 3600,
                fanout: int = 1024, prev_name: str = "prev_ts", next_name: str = "next_ts") -> DataFrame:
    """Holes in each series: consecutive timestamps more than ``max_gap_seconds`` apart.

    Returns ``keys + [prev_ts, next_ts, gap_seconds]``.
    """
    keys = list(keys)
    gap_us = int(max_gap_seconds) * 1_000_000
    us = _micros(ts_col)
    buckets = (df.select(*keys, F.col(ts_col).alias("_ts"), F.floor(us / F.lit(gap_us)).alias("_bucket"))
                 .groupBy(*keys, "_bucket")
                 .agg(F.min("_ts").alias("_lo"), F.max("_ts").alias("_hi"))
                 .withColumn("_group", F.floor(F.col("_bucket") / F.lit(fanout))))
    # consecutive buckets inside a group of ``fanout`` buckets
    inner_w = Window.partitionBy(*keys, "_group").orderBy("_bucket")
    inner = buckets.select(*keys, F.lag("_hi").over(inner_w).alias(prev_name), F.col("_lo").alias(next_name))
    # consecutive groups: last reading of the previous non-empty group -> first of this one
    groups = buckets.groupBy(*keys, "_group").agg(F.min("_lo").alias("_glo"), F.max("_hi").alias("_ghi"))
    outer_w = Window.partitionBy(*keys).orderBy("_group")
    outer = groups.select(*keys, F.lag("_ghi").over(outer_w).alias(prev_name), F.col("_glo").alias(next_name))
    # both halves read min and max of the same bucket aggregate, so its shuffle is reused
    pairs = inner.unionByName(outer)
    diff_us = _micros(next_name) - _micros(prev_name)
    return (pairs.filter(F.col(prev_name).isNotNull() & (diff_us > F.lit(gap_us)))
                 .select(*keys, prev_name, next_name, (diff_us / F.lit(1_000_000)).alias("gap_seconds")))


def completeness_by_key(series_keys: DataFrame, gaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One check row per series: ``fail`` + "N gap(s) detected" or ``pass`` + "no gaps detected".

    ``series_keys`` is the distinct key frame (series with no gaps still get a row).
    """
    keys = list(keys)
    counts = gaps.groupBy(*keys).agg(F.count(F.lit(1)).alias("gap_count"))
    j = series_keys.join(counts, keys, "left").fillna(0, ["gap_count"])
    return j.select(*keys, F.col("gap_count").cast("bigint").alias("gap_count"),
                    *_check_columns(F.col("gap_count")))


def completeness_result(gaps: DataFrame, run_id: str, checked_at) -> DataFrame:
    """One table-wide check row for a run (all series together)."""
    n = gaps.agg(F.count(F.lit(1)).alias("gap_count"))
    return n.select(F.lit(run_id).alias("run_id"), F.lit(CHECK_COMPLETENESS).alias("check_name"),
                    *_check_columns(F.col("gap_count")), F.lit(checked_at).cast("timestamp").alias("checked_at"))


def _check_columns(n: Column):
    status = F.when(n > 0, F.lit(FAIL)).otherwise(F.lit(PASS))
    detail = F.when(n > 0, F.concat(n.cast("string"), F.lit(" gap(s) detected"))) \
              .otherwise(F.lit("no gaps detected"))
    return [status.alias("status"), detail.alias("detail")]


def freshness_state(ledger: DataFrame, source_col: str = "source", ts_col: str = "finished_at",
                    status_col: str = "status", seq_col: str | None = None,
                    watermark_col: str | None = None, success_value: str = SUCCESS,
                    parity_null_on_failure: bool = False) -> DataFrame:
    """Current freshness per source, derived from the append-only run ledger.

    * ``last_success_at``: latest successful run (kept when a later run fails,
      unless ``parity_null_on_failure``)
    * ``last_attempt_at``: latest run of any status
    * ``status``: ``fresh`` when the latest run succeeded, else ``failing``
    * ``current_watermark``: watermark of the latest successful run

    All parts are aggregates (``max``/``max_by``), combined map-side.
    """
    order = F.struct(F.col(ts_col), F.col(seq_col)) if seq_col else F.col(ts_col)
    ok = F.col(status_col) == F.lit(success_value)
    aggs = [F.max(F.when(ok, F.col(ts_col))).alias("last_success_at"),
            F.max(ts_col).alias("last_attempt_at"),
            F.max_by(F.col(status_col), order).alias("_last_status")]
    if watermark_col:
        aggs.append(F.max_by(F.when(ok, F.col(watermark_col)), F.when(ok, order)).alias("current_watermark"))
    st = ledger.groupBy(source_col).agg(*aggs)
    status = F.when(F.col("_last_status") == F.lit(success_value), F.lit(FRESH)).otherwise(F.lit(FAILING))
    st = st.withColumn("status", status).drop("_last_status")
    if parity_null_on_failure:
        st = st.withColumn("last_success_at",
                           F.when(F.col("status") == FRESH, F.col("last_success_at")))
    return st


def stale_sources(state: DataFrame, as_of, max_age_hours: int = STALE_AFTER_HOURS) -> DataFrame:
    """Sources not fresh, never successful, or last successful before ``as_of - max_age``."""
    limit = F.lit(as_of).cast("timestamp") - F.expr(f"INTERVAL {int(max_age_hours)} HOURS")
    return state.filter((F.col("status") != F.lit(FRESH)) | F.col("last_success_at").isNull()
                        | (F.col("last_success_at").cast("timestamp") < limit))


def sweep_result(stale: DataFrame, run_id: str, checked_at) -> DataFrame:
    """One check row: ``fail`` + "N stale/failing source(s)" or ``pass`` + "all sources fresh".

    The list of stale sources stays a distributed frame (``stale_sources``);
    it is not gathered into the result row.
    """
    n = F.col("stale_count")
    return (stale.agg(F.count(F.lit(1)).alias("stale_count"))
                 .select(F.lit(run_id).alias("run_id"), F.lit(CHECK_FRESHNESS).alias("check_name"),
                         F.when(n > 0, F.lit(FAIL)).otherwise(F.lit(PASS)).alias("status"),
                         F.when(n > 0, F.concat(n.cast("string"), F.lit(" stale/failing source(s)")))
                          .otherwise(F.lit("all sources fresh")).alias("detail"),
                         n.cast("bigint").alias("stale_count"),
                         F.lit(checked_at).cast("timestamp").alias("checked_at")))


def run_accounting(flagged: DataFrame, group_cols: Sequence[str], reason_col: str,
                   dedup_keys: Sequence[str]) -> DataFrame:
    """Per group (e.g. UTC day or run): rows read, rejected, deduplicated, accepted.

    ``accepted`` counts distinct ``dedup_keys`` among passing rows (what the
    upsert writes); ``deduplicated`` = passing rows minus accepted, reported
    separately instead of being silently dropped from ``records_in``.
    """
    group_cols = list(group_cols)
    ok = F.col(reason_col).isNull()
    per_key = (flagged.groupBy(*group_cols, *dedup_keys)
                      .agg(F.count(F.lit(1)).alias("_n"),
                           F.count_if(ok).alias("_ok")))
    return (per_key.groupBy(*group_cols)
                   .agg(F.sum("_n").cast("bigint").alias("records_in"),
                        (F.sum("_n") - F.sum("_ok")).cast("bigint").alias("records_quarantined"),
                        F.count_if(F.col("_ok") > 0).cast("bigint").alias("records_accepted"),
                        F.sum(F.when(F.col("_ok") > 1, F.col("_ok") - 1).otherwise(0))
                         .cast("bigint").alias("records_deduplicated")))


def backfill_status(requested: DataFrame, outcomes: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """Per requested unit (day/file): ``success`` when it loaded rows, else ``failed`` with a reason.

    ``outcomes`` holds ``key_cols + [records_accepted, error]`` for every unit
    that was attempted and produced a result; requested units with no outcome
    are missing at the source. One unit failing never stops the others.
    """
    key_cols = list(key_cols)
    j = requested.join(outcomes, key_cols, "left")
    status = F.when(F.col("error").isNull() & (F.coalesce(F.col("records_accepted"), F.lit(0)) > 0),
                    F.lit(SUCCESS)).otherwise(F.lit(FAILED))
    error = F.coalesce(F.col("error"),
                       F.when(F.col("records_accepted").isNull(), F.lit("source file not available")),
                       F.when(F.col("records_accepted") == 0, F.lit("no rows accepted")))
    return j.select(*key_cols, F.coalesce(F.col("records_accepted"), F.lit(0)).cast("bigint").alias("records_accepted"),
                    status.alias("status"), F.when(status == FAILED, error).alias("error"))


def backfill_summary(status: DataFrame) -> DataFrame:
    return status.agg(F.count(F.lit(1)).alias("attempted"),
                      F.count_if(F.col("status") != F.lit(SUCCESS)).alias("failed"))
