"""Registered queries: every operator run over the driver's tables, plus DuckDB oracles.

Role mapping (whole tables, no subsets):

* ``events``   -- interval readings: ``event_type`` (or ``user_id``) is the series
  key, ``ts`` the reading time, ``value`` the measure, ``props`` a JSON payload;
  ``user_id`` doubles as a pipeline *source* and ``event_type = 'error'`` as a
  failed run when the operator needs a run ledger.
* ``lineitem`` -- interval forecasts: ``l_extendedprice`` is the forecast,
  ``l_extendedprice * (1 - l_discount)`` the actual, not yet published (NULL)
  while ``l_linestatus = 'O'``; ``l_returnflag`` is the series.
* ``orders`` ⋈ ``lineitem`` -- actuals (``o_totalprice``) against forecast
  captures (``l_extendedprice`` captured at ``l_shipdate``) for the same key.
* ``documents`` -- raw files: ``n_chars`` is the logical name, ``doc_id`` the
  arrival order, ``text`` the content.
* ``embeddings`` -- documents holding an array of readings.

Computed columns carry the same alias in the Spark form and the SQL form.
Means and sums of measures use the exact, order-independent form
(``functions.exact``), written identically in SQL, so both engines produce
bit-identical doubles; DuckDB integer sums/counts are cast to BIGINT.
"""

from __future__ import annotations

import datetime as _datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.exact import exact_mean_sql, exact_sum
from ..functions.hashing import capture_name, content_sha
from ..functions.timeparse import US_DATETIME, parse_iso_instant
from ..operators import accuracy, contracts, landing, normalize, quality, reads, reconcile, upsert
from ..operators.gap_state import GapState
from ..session import apply_sql_settings, materialize, scratch_path
from ..sources import files
from .datasets import Dataset

# Query parameters (dates inside the events table's January 2024 span).
EVENT_KEYS = ("click", "purchase", "signup", "view")
UPSERT_CURRENT_BEFORE = "2024-01-20"
UPSERT_INCOMING_FROM = "2024-01-15"
GAP_BATCHES = ("2024-01-11", "2024-01-21")
SWEEP_AS_OF = "2024-01-31 00:00:00"
EXPORT_AS_OF = "2024-01-25"
EXPORT_TRAILING_DAYS = 14
FORECAST_AS_OF = "2024-01-10"
FORECAST_FORWARD_DAYS = 14
OVERLAP_HOURS = 6
LATE_HOURS = 3
RECONCILE_TOLERANCE = 5.0
BULK_CAP = 100
BULK_SPAN_DAYS = 2
MICROJOULES_PER_KWH = 3.6e12
MONEY_DIGITS = 4          # prices and discounts carry 2 decimals each: errors are exact at 4
RATIO_DIGITS = 9
VALUE_DIGITS = 4
FILES_AS_OF = _datetime.datetime(2024, 2, 1)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- accuracy

def _lineitem_roles(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem")
    actual = F.when(F.col("l_linestatus") == "O", F.lit(None).cast("double")) \
              .otherwise(F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return li.select("l_returnflag", "l_shipdate", F.col("l_extendedprice").alias("forecast"),
                     actual.alias("actual"))


def _accuracy_out(df):
    return df.select("l_returnflag", "day", F.col("interval_count").cast("bigint").alias("interval_count"),
                     "mean_bias", "mean_abs_error", "mean_abs_pct_error")


def q_forecast_accuracy(spark, sf_dir):
    df = _lineitem_roles(spark, sf_dir)
    return _accuracy_out(accuracy.interval_accuracy(df, ["l_returnflag"], "l_shipdate", "forecast", "actual",
                                                    digits=MONEY_DIGITS, ratio_digits=RATIO_DIGITS))


ACCURACY_SQL_BODY = """
  SELECT l_returnflag, CAST(date_trunc('day', l_shipdate) AS DATE) AS day,
         CAST(count(*) AS BIGINT) AS interval_count,
         """ + exact_mean_sql("actual - forecast", 4) + """ AS mean_bias,
         """ + exact_mean_sql("abs(actual - forecast)", 4) + """ AS mean_abs_error,
         (""" + exact_mean_sql("abs(actual - forecast) / nullif(actual, 0)", 9) + """) * 100 AS mean_abs_pct_error
  FROM (SELECT l_returnflag, l_shipdate, l_extendedprice AS forecast,
               CASE WHEN l_linestatus = 'O' THEN NULL
                    ELSE l_extendedprice * (1 - l_discount) END AS actual
        FROM lineitem) t
  WHERE actual IS NOT NULL {extra}
  GROUP BY l_returnflag, CAST(date_trunc('day', l_shipdate) AS DATE)
"""


def q_read_accuracy(spark, sf_dir):
    df = _lineitem_roles(spark, sf_dir).filter(F.col("l_returnflag") == "R")
    lo = F.lit("1996-01-01").cast("date").cast("timestamp_ntz")
    hi = F.lit("1996-04-01").cast("date").cast("timestamp_ntz")
    return _accuracy_out(accuracy.interval_accuracy(df, ["l_returnflag"], "l_shipdate", "forecast", "actual",
                                                    start=lo, end=hi, digits=MONEY_DIGITS,
                                                    ratio_digits=RATIO_DIGITS))


def q_latest_capture_accuracy(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    li = _t(spark, sf_dir, "lineitem")
    return accuracy.latest_capture_accuracy(o, li, "o_orderkey", "l_orderkey", "l_shipdate",
                                            "o_totalprice", "l_extendedprice")


LATEST_CAPTURE_SQL = """
SELECT o.o_orderkey, l.l_shipdate AS captured_at, o.o_totalprice AS actual, l.l_extendedprice AS forecast,
       o.o_totalprice - l.l_extendedprice AS bias, abs(o.o_totalprice - l.l_extendedprice) AS abs_error
FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE l.l_shipdate = (SELECT max(l2.l_shipdate) FROM lineitem l2 WHERE l2.l_orderkey = o.o_orderkey)
"""


def q_read_capture_accuracy(spark, sf_dir):
    o = reads.day_range(_t(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1996-03-31")
    li = _t(spark, sf_dir, "lineitem")
    return accuracy.latest_capture_accuracy(o, li, "o_orderkey", "l_orderkey", "l_shipdate",
                                            "o_totalprice", "l_extendedprice")


# ---------------------------------------------------------------- contracts

def _event_contract():
    return contracts.Contract(
        name="events", columns=("event_id", "ts", "user_id", "event_type", "value", "props"),
        rules=(R.ge("value", 1), R.le("value", 100), R.isin("event_type", EVENT_KEYS)))


def _flagged_events(spark, sf_dir):
    return contracts.flag(_t(spark, sf_dir, "events"), _event_contract())


def q_contract_quarantine(spark, sf_dir):
    return contracts.rejected(_flagged_events(spark, sf_dir)).select(
        "event_id", "user_id", "event_type", "value", "rejection_reason")


def q_contract_accept(spark, sf_dir):
    return contracts.accepted(_flagged_events(spark, sf_dir)).select("event_id", "user_id", "event_type", "value")


EVENT_REASON_SQL = """concat_ws('; ',
      CASE WHEN value < 1 THEN 'value:ge(1)' END,
      CASE WHEN value > 100 THEN 'value:le(100)' END,
      CASE WHEN event_type NOT IN ('click', 'purchase', 'signup', 'view') THEN 'event_type:isin(click,purchase,signup,view)' END)"""


def q_coerce_quarantine(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    raw = ev.select("event_id",
                    F.when(F.col("event_type") == "error", F.lit("not-a-number"))
                     .otherwise(F.col("value").cast("string")).alias("raw_value"),
                    F.get_json_object("props", "$.k").alias("raw_k"))
    typed = raw.withColumn("value", R.try_number("raw_value", "double")) \
               .withColumn("k", R.try_number("raw_k", "bigint"))
    c = contracts.Contract("coerce", ("raw_value", "raw_k"),
                           (R.coerced("raw_value", "value", "double"), R.coerced("raw_k", "k", "bigint")))
    return contracts.rejected(contracts.flag(typed, c)).select("event_id", "raw_value", "value", "k",
                                                               "rejection_reason")


# ---------------------------------------------------------------- normalise

def q_interval_normalize(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    text = ev.select("event_id",
                     F.date_format("ts", US_DATETIME).alias("end_text"),
                     F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
                     F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("captured_text"))
    out = normalize.interval_from_end(text, "end_text")
    return out.select("event_id",
                      F.col("interval_start_utc").cast("timestamp_ntz").alias("interval_start_utc"),
                      F.col("interval_end_utc").cast("timestamp_ntz").alias("interval_end_utc"),
                      F.col("date_text").try_cast("date").alias("event_date"),
                      parse_iso_instant("captured_text").cast("timestamp_ntz").alias("captured_at"))


def _hourly(ev):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")   # zone-free like the source column
    return ev.select("event_id", "user_id", hour.alias("hour"), "ts", "event_type", "value")


def q_dedup_keep_last(spark, sf_dir):
    return normalize.dedup_keep_last(_hourly(_t(spark, sf_dir, "events")), ["user_id", "hour"], ["event_id"])


def q_daily_station_mean(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    m = normalize.station_day_mean(ev, ["day", "event_type"], ["value"], first_col="props", order_col="event_id",
                                   digits=VALUE_DIGITS)
    return m.select("day", "event_type", "avg_value",
                    F.col("readings").cast("bigint").alias("readings"), "first_props")


def q_wide_mean(spark, sf_dir):
    """Means in microjoules of readings in kWh: their exact sums are far beyond 64 bits."""
    ev = _t(spark, sf_dir, "events").withColumn("microjoules", F.col("value") * F.lit(MICROJOULES_PER_KWH))
    means = normalize.station_day_mean(ev, ["event_type"], ["microjoules"], digits=6)
    return means.select("event_type", "avg_microjoules", F.col("readings").cast("bigint").alias("readings"))


def q_explode_readings(spark, sf_dir):
    emb = _t(spark, sf_dir, "embeddings")
    flat = emb.select("vec_id", F.posexplode("embedding").alias("pos", "x"))
    return flat.select("vec_id", F.col("pos").cast("bigint").alias("pos"), F.col("x").cast("double").alias("x"))


# ---------------------------------------------------------------- scans

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _typed_events(df):
    return df.select(F.col("event_id").try_cast("bigint").alias("event_id"),
                     F.col("ts").try_cast("timestamp_ntz").alias("ts"),
                     F.col("user_id").try_cast("bigint").alias("user_id"), "event_type",
                     R.try_number("value", "double").alias("value"), "props")


def _events_as_text(ev):
    return ev.select(*[F.col(c).cast("string").alias(c) for c in EVENT_COLUMNS])


def q_scan_csv(spark, sf_dir):
    out = scratch_path(spark, "scan-csv")
    _events_as_text(_t(spark, sf_dir, "events")).write.option("header", True).csv(out)
    contract = contracts.Contract("events_csv", tuple(EVENT_COLUMNS), (), strict=True)
    rows, _status, _scan = files.scan_checked_csv(spark, [out], contract, escape="\\")
    return _typed_events(rows)


def q_scan_json(spark, sf_dir):
    base = scratch_path(spark, "scan-json")
    ev = _events_as_text(_t(spark, sf_dir, "events"))
    early = F.col("ts") < F.lit(UPSERT_INCOMING_FROM)
    ev.filter(early).write.json(f"{base}/a")
    ev.filter(~early).write.json(f"{base}/b")
    rows = files.scan_json(spark, [f"{base}/a", f"{base}/b"], files.string_schema(EVENT_COLUMNS),
                           multiline=False)
    return _typed_events(rows)


EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


# ---------------------------------------------------------------- landing

def _doc_manifest(spark, sf_dir):
    """Fingerprint every document once; classification reads the small checkpointed manifest."""
    d = _t(spark, sf_dir, "documents")
    return materialize(d.select(F.col("doc_id").alias("landed_seq"), F.col("n_chars").alias("name"),
                                content_sha("text").alias("content_sha")))


def q_landing_immutable(spark, sf_dir):
    c = landing.classify_immutable(_doc_manifest(spark, sf_dir))
    return c.select(F.col("landed_seq").alias("doc_id"), F.col("name").alias("n_chars"),
                    "landing_status", "landing_error")


def q_landing_capture_name(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    m = ev.select(F.col("event_id").alias("landed_seq"), capture_name(F.col("ts").cast("string")).alias("name"),
                  content_sha("props").alias("content_sha"))
    c = landing.classify_immutable(m)
    return c.select(F.col("landed_seq").alias("event_id"), "name", "landing_status")


def _doc_versions(spark, sf_dir):
    m = _doc_manifest(spark, sf_dir).withColumnRenamed("name", "stem")
    return landing.version_names(m)


def q_landing_versioned(spark, sf_dir):
    return _doc_versions(spark, sf_dir).select(
        F.col("stem").alias("n_chars"), "content_sha", "version_name",
        F.col("first_seq").alias("first_doc_id"), F.col("last_seq").alias("last_doc_id"),
        F.col("arrivals").cast("bigint").alias("arrivals"))


def q_landing_latest(spark, sf_dir):
    lv = landing.latest_versions(_doc_versions(spark, sf_dir))
    return lv.select("base_name", "latest_name", F.col("latest_seq").alias("latest_doc_id"),
                     F.col("versions").cast("bigint").alias("versions"))


VERSIONS_SQL = """
WITH v AS (
  SELECT n_chars, sha256(text) AS content_sha, min(doc_id) AS first_doc_id, max(doc_id) AS last_doc_id,
         CAST(count(*) AS BIGINT) AS arrivals
  FROM documents GROUP BY n_chars, sha256(text)
), p AS (
  SELECT n_chars, arg_min(content_sha, first_doc_id) AS plain_sha FROM v GROUP BY n_chars
), named AS (
  SELECT v.*, CASE WHEN v.content_sha = p.plain_sha THEN CAST(v.n_chars AS VARCHAR) || '.json'
                   ELSE CAST(v.n_chars AS VARCHAR) || '__' || substr(v.content_sha, 1, 12) || '.json' END AS version_name
  FROM v JOIN p USING (n_chars)
)
"""


# ---------------------------------------------------------------- upsert

def _upsert_batches(spark, sf_dir):
    h = _hourly(_t(spark, sf_dir, "events")).select("user_id", "hour", "ts", "event_id", "value")
    current = normalize.dedup_keep_last(h.filter(F.col("ts") < F.lit(UPSERT_CURRENT_BEFORE).cast("timestamp_ntz"))
                                        .drop("ts"), ["user_id", "hour"], ["event_id"])
    # the boundary is hour-aligned, so filtering the raw ts is the same as filtering the hour
    # and, unlike a date_trunc comparison, reaches the Parquet scan
    incoming = h.filter(F.col("ts") >= F.lit(UPSERT_INCOMING_FROM).cast("timestamp_ntz"))
    return current, incoming.drop("ts")


def q_upsert_latest(spark, sf_dir):
    current, incoming = _upsert_batches(spark, sf_dir)
    return upsert.upsert(current, incoming, ["user_id", "hour"], order_cols=["event_id"])


def q_upsert_history(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "event_id", "value")
    current = ev.filter(F.col("ts") < F.lit(UPSERT_CURRENT_BEFORE).cast("timestamp_ntz"))
    incoming = ev.filter(F.col("ts") >= F.lit(UPSERT_INCOMING_FROM).cast("timestamp_ntz")) \
                 .withColumn("value", F.col("value") + 1)
    return upsert.append_history(current, incoming, ["user_id", "ts"], order_cols=["event_id"])


def q_incremental_overlap(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    current = ev.filter(F.col("ts") < F.lit(UPSERT_CURRENT_BEFORE).cast("timestamp_ntz"))
    watermark = current.agg(F.max("ts")).scalar()
    repull = reconcile.incremental_window(ev, "ts", watermark, OVERLAP_HOURS)
    return repull.select("event_id", "ts", "user_id", "value")


def q_incremental_pull(spark, sf_dir):
    """Two pulls of a growing source through the ledger's watermark: the first delivery lacks the views of its last hours."""
    from .ingest import Store
    from .repull import RUN_COL, IncrementalFact
    ev = _t(spark, sf_dir, "events").select(*FILE_COLUMNS)
    cut = F.lit(UPSERT_CURRENT_BEFORE).cast("timestamp_ntz")
    late = F.coalesce((F.col("event_type") == "view") & (F.col("ts") >= cut - F.expr(f"INTERVAL {LATE_HOURS} HOURS")), F.lit(False))
    fact = IncrementalFact(Store(spark, scratch_path(spark, "incremental-pull")), "events", ["event_id"], "ts", OVERLAP_HOURS)
    fact.pull(ev.filter((F.col("ts") < cut) & ~late), "first", FILES_AS_OF)
    run = fact.pull(ev, "second", FILES_AS_OF).first()
    return (fact.current().withColumn("watermark_before", F.lit(run["watermark_before"]).cast("timestamp_ntz"))
                .withColumn("watermark_after", F.lit(run["watermark_after"]).cast("timestamp_ntz")).withColumnRenamed(RUN_COL, "run_id"))


# ---------------------------------------------------------------- quality

def _event_gaps(spark, sf_dir):
    return quality.detect_gaps(_t(spark, sf_dir, "events"), ["event_type"], "ts", 3600)


def q_gap_detect(spark, sf_dir):
    return _event_gaps(spark, sf_dir)


GAPS_CTE = """
gaps AS (
  SELECT event_type, prev_ts, next_ts,
         CAST(epoch_us(next_ts) - epoch_us(prev_ts) AS DOUBLE) / 1000000 AS gap_seconds
  FROM (SELECT event_type, ts AS next_ts,
               lag(ts) OVER (PARTITION BY event_type ORDER BY ts) AS prev_ts FROM events) o
  WHERE prev_ts IS NOT NULL AND next_ts - prev_ts > INTERVAL 1 HOUR
)"""


def q_gap_state(spark, sf_dir):
    """Gaps from the state kept per batch: the month's last days come first, its first days last, one attempt dies."""
    ev = _t(spark, sf_dir, "events").select("event_type", "ts")
    state = GapState(spark, scratch_path(spark, "gap-state"), ["event_type"], "ts", 3600)
    first, second = F.col("ts") < F.lit(GAP_BATCHES[0]), F.col("ts") < F.lit(GAP_BATCHES[1])

    def committed(*pairs):
        return spark.createDataFrame(list(pairs), f"{upsert.BATCH_SEQ} bigint, {upsert.ATTEMPT} bigint")
    state.seed(None)
    state.append(ev.filter(~second), 3)
    state.fold(committed((3, 0)))
    state.append(ev, 2)                                  # never committed
    state.append(ev.filter(~first & second), 2, 1)
    state.fold(committed((3, 0), (2, 1)))
    state.append(ev.filter(first), 1)
    return state.gaps(committed((3, 0), (2, 1), (1, 0)))


def q_quality_rollup(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    keys = ev.select("event_type").distinct()
    return quality.completeness_by_key(keys, _event_gaps(spark, sf_dir), ["event_type"])


def _event_ledger(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("source"), F.col("ts").alias("finished_at"),
                     F.when(F.col("event_type") == "error", F.lit(quality.FAILED))
                      .otherwise(F.lit(quality.SUCCESS)).alias("status"),
                     F.col("event_id").alias("seq"),
                     F.to_date("ts").cast("string").alias("watermark"))


def _freshness(spark, sf_dir):
    return quality.freshness_state(_event_ledger(spark, sf_dir), seq_col="seq", watermark_col="watermark")


def q_freshness_state(spark, sf_dir):
    return _freshness(spark, sf_dir)


FRESHNESS_CTE = """
fs AS (
  SELECT user_id AS source,
         max(ts) FILTER (WHERE event_type <> 'error') AS last_success_at,
         max(ts) AS last_attempt_at,
         arg_max(CAST(CAST(ts AS DATE) AS VARCHAR), row(ts, event_id)) FILTER (WHERE event_type <> 'error') AS current_watermark,
         CASE WHEN arg_max(event_type, row(ts, event_id)) <> 'error' THEN 'fresh' ELSE 'failing' END AS status
  FROM events GROUP BY user_id
)"""


def q_freshness_sweep(spark, sf_dir):
    return quality.stale_sources(_freshness(spark, sf_dir), SWEEP_AS_OF)


def q_freshness_sweep_result(spark, sf_dir):
    stale = quality.stale_sources(_freshness(spark, sf_dir), SWEEP_AS_OF)
    return quality.sweep_result(stale, "sweep-" + SWEEP_AS_OF[:10], SWEEP_AS_OF).drop("checked_at")


def _accounting(spark, sf_dir):
    f = _flagged_events(spark, sf_dir).withColumn("day", F.to_date("ts")) \
                                     .withColumn("hour", F.date_trunc("hour", "ts"))
    return quality.run_accounting(f, ["day"], "rejection_reason", ["user_id", "hour"])


def q_run_accounting(spark, sf_dir):
    return _accounting(spark, sf_dir)


ACCOUNTING_CTE = """
flagged AS (
  SELECT CAST(ts AS DATE) AS day, user_id, date_trunc('hour', ts) AS hour,
         """ + EVENT_REASON_SQL + """ AS reason FROM events
), per_key AS (
  SELECT day, user_id, hour, count(*) AS n, count(*) FILTER (WHERE reason = '') AS ok
  FROM flagged GROUP BY day, user_id, hour
), acct AS (
  SELECT day, CAST(sum(n) AS BIGINT) AS records_in, CAST(sum(n) - sum(ok) AS BIGINT) AS records_quarantined,
         CAST(count(*) FILTER (WHERE ok > 0) AS BIGINT) AS records_accepted,
         CAST(sum(CASE WHEN ok > 1 THEN ok - 1 ELSE 0 END) AS BIGINT) AS records_deduplicated
  FROM per_key GROUP BY day
)"""


def q_backfill_status(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    span = ev.agg(F.min(F.to_date("ts")).alias("lo"), F.max(F.to_date("ts")).alias("hi"))
    requested = span.select(F.explode(F.sequence("lo", F.date_add("hi", 3))).alias("day"))
    outcomes = _accounting(spark, sf_dir).select("day", "records_accepted",
                                                 F.lit(None).cast("string").alias("error"))
    return quality.backfill_status(requested, outcomes, ["day"])


def q_backfill_summary(spark, sf_dir):
    return quality.backfill_summary(q_backfill_status(spark, sf_dir)).select(
        F.col("attempted").cast("bigint").alias("attempted"), F.col("failed").cast("bigint").alias("failed"))


def q_completeness_check(spark, sf_dir):
    gaps = _event_gaps(spark, sf_dir)
    return quality.completeness_result(gaps, "check-" + SWEEP_AS_OF[:10], SWEEP_AS_OF).select(
        "run_id", "check_name", "status", "detail")


# ---------------------------------------------------------------- reads

def q_read_daily(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return reads.bounded_read(ev, "ts", "2024-01-10", "2024-01-12", ["ts", "event_id"], cap=500)


def q_read_history(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return reads.bounded_read(o, "o_orderdate", "1996-01-01", "1996-12-31", ["o_orderdate", "o_orderkey"], cap=500)


def q_read_interval(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return reads.bounded_read(ev, "ts", "2024-01-05", "2024-01-08", ["ts", "event_id"], cap=5000,
                              key_col="event_type", key="click")


def _guard_input(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    day = F.to_date("ts")
    start_text = F.when(F.col("event_type") == "purchase", F.date_format(day, "yyyy/MM/dd")) \
                  .otherwise(F.date_format(day, "yyyy-MM-dd"))
    end_text = F.date_format(F.date_add(day, (F.floor(F.col("value") * 2) - 20).cast("int")), "yyyy-MM-dd")
    return ev.select(F.col("event_id").alias("rid"), start_text.alias("start_text"),
                     end_text.alias("end_text"), F.col("event_type").alias("key"))


def q_request_guard(spark, sf_dir):
    g = reads.guard_requests(_guard_input(spark, sf_dir), "start_text", "end_text", "key", EVENT_KEYS)
    return g.select("rid", "request_status", "start_date", "end_date")


def _bulk_requests(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    per = ev.select(F.col("event_type").alias("key"), F.to_date("ts").alias("day")).distinct()
    req = per.select(F.concat_ws("|", "key", F.col("day").cast("string")).alias("rid"), "key",
                     F.col("day").cast("string").alias("start_text"),
                     F.date_add("day", BULK_SPAN_DAYS).cast("string").alias("end_text"))
    return reads.guard_requests(req, "start_text", "end_text", "key", EVENT_KEYS)


def q_bulk_read(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    out = reads.bulk_read(_bulk_requests(spark, sf_dir), ev, "rid", "key", "event_type", "ts",
                          ["ts", "event_id"], cap=BULK_CAP)
    return out.select("rid", "event_id", "ts", "value", F.col("row_in_request").cast("bigint").alias("row_in_request"),
                      F.col("matched_rows").cast("bigint").alias("matched_rows"), "truncated")


def q_read_envelope(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    env = reads.read_envelope(_bulk_requests(spark, sf_dir), ev, "rid", "key", "event_type", "ts",
                              cap=BULK_CAP, source="events", generated_at=SWEEP_AS_OF)
    # registered outputs carry zone-free timestamps, so a client in any time zone reads the same values
    return env.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


BULK_REQ_CTE = """
req AS (
  SELECT DISTINCT event_type AS key, CAST(ts AS DATE) AS day FROM events
), guarded AS (
  SELECT key || '|' || CAST(day AS VARCHAR) AS rid, key, day AS start_date,
         CAST(day + INTERVAL 2 DAY AS DATE) AS end_date,
         CASE WHEN key IN ('click', 'purchase', 'signup', 'view') THEN 'ok' ELSE 'unknown_key' END AS request_status
  FROM req
), matched AS (
  SELECT g.rid, e.event_id, e.ts, e.value
  FROM guarded g JOIN events e ON e.event_type = g.key
   AND CAST(e.ts AS DATE) BETWEEN g.start_date AND g.end_date
  WHERE g.request_status = 'ok'
)"""


def q_quality_newest(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return reads.newest(ev, [F.col("ts").desc(), F.col("event_id").desc()], 100)


def q_export_window(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return reads.trailing_window(ev, "ts", EXPORT_AS_OF, EXPORT_TRAILING_DAYS)


def q_export_forecast_window(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return reads.forward_window(ev, "ts", FORECAST_AS_OF, FORECAST_FORWARD_DAYS)


def q_export_set(spark, sf_dir):
    """Three exports published as a set, an older and an unfinished set beside it; read back through the pointer."""
    from .export import latest_set, publish, read_export
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    out = scratch_path(spark, "export-set")

    def frames(as_of):
        return {"history": ("events", reads.trailing_window(ev, "ts", as_of, EXPORT_TRAILING_DAYS)),
                "outlook": ("events", reads.forward_window(ev, "ts", as_of, FORECAST_FORWARD_DAYS)),
                "newest": ("events", reads.newest(ev, [F.col("ts").desc(), F.col("event_id").desc()], BULK_CAP))}
    publish(spark, frames(FORECAST_AS_OF), out, SWEEP_AS_OF)
    published = publish(spark, frames(EXPORT_AS_OF), out, SWEEP_AS_OF)
    frames(FORECAST_AS_OF)["history"][1].limit(1).write.json(f"{out}/sets/died/history/records")      # no envelope, no pointer
    if latest_set(spark, out) != published:
        raise RuntimeError("the pointer does not name the set published last")
    found = None
    for name in ("history", "outlook", "newest"):
        one = read_export(spark, out, name, published)
        rows = one.records.select(F.lit(name).alias("export"), "*", F.lit(one.envelope["record_count"]).cast("bigint").alias("record_count"))
        found = rows if found is None else found.unionByName(rows)
    return found


def q_snapshot_filter(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("ts_text"),
                                            "event_type", "value")
    return reads.snapshot_filter(ev, "ts_text", "2024-01-03", "2024-01-09", "event_id",
                                 key_col="event_type", key="view")


def _family_totals(ev, types):
    return (ev.filter(F.col("event_type").isin(*types))
              .groupBy("user_id", F.to_date("ts").alias("day"))
              .agg(exact_sum("value", VALUE_DIGITS).alias("total")))


def q_reconcile(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    left = _family_totals(ev, ["click", "view"])
    right = _family_totals(ev, ["purchase", "signup", "error"])
    r = reconcile.reconcile(left, right, ["user_id", "day"], "total", RECONCILE_TOLERANCE)
    return r.select("user_id", "day", "left_value", "right_value", "difference", "reconcile_status")


# ---------------------------------------------------------------- streaming

def q_stream_upsert(spark, sf_dir):
    """Catch-up stream over the events table: keyed upsert into a change log, read back latest."""
    import datetime as _dt

    from ..streaming.file_stream import stream_table_upsert
    from .ingest import Store
    store = Store(spark, scratch_path(spark, "stream-upsert"))

    def project(batch):
        return batch.select("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "event_id", "value",
                            F.to_date("ts").alias("event_date"))
    q = stream_table_upsert(store, f"{sf_dir.rstrip('/')}/events.parquet", "events", ["user_id", "hour"],
                            "event_date", project, ["event_id"], store.path("_checkpoint"),
                            _dt.datetime(2024, 2, 1))
    q.awaitTermination()      # availableNow: stops once caught up, however long the table takes
    log = upsert.ChangeLog(spark, store.path("facts", "events"), ["user_id", "hour"], "event_date")
    committed = store.runs().filter(F.col("source") == "events").select(upsert.BATCH_SEQ)
    return log.current(committed).select("user_id", "hour", "event_id", "value")


# ---------------------------------------------------------------- files through the store

FILE_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")
ABSENT_TYPE = "refund"            # requested, never delivered


def _event_files_dataset():
    """Events as a dataset of CSV files: every accepted event is a fact of its own."""
    def prepare(df):
        return (df.withColumn("event_id_n", F.col("event_id").try_cast("bigint")).withColumn("ts_n", F.col("ts").try_cast("timestamp_ntz"))
                  .withColumn("user_id_n", F.col("user_id").try_cast("bigint")).withColumn("value_n", R.try_number("value")))

    def finish(df):
        return df.select(F.col("event_id_n").alias("event_id"), F.col("ts_n").alias("ts"), F.col("user_id_n").alias("user_id"),
                         "event_type", F.col("value_n").alias("value"), files.FILE_NAME)

    rules = (R.not_null("event_id_n"), R.not_null("ts_n"), R.coerced("value", "value_n", "double"), R.ge("value_n", 1), R.le("value_n", 100))
    return Dataset(name="event_files", fmt="csv", contract=contracts.Contract("event_files", FILE_COLUMNS, rules), keys=("event_id",),
                   date_col="event_date", date_source="ts", fact_columns=("event_id", "ts", "user_id", "event_type", "value"),
                   prepare=prepare, finish=finish, landing="immutable")


def _deliver_event_files(spark, sf_dir, base):
    """All events as headered CSV files by type; each type has its columns in an order of its own, errors lack the value."""
    ev = _t(spark, sf_dir, "events").select(*[F.col(c).cast("string").alias(c) for c in FILE_COLUMNS])
    for i, kind in enumerate((*EVENT_KEYS, "error")):
        order = [c for c in FILE_COLUMNS[i:] + FILE_COLUMNS[:i] if not (kind == "error" and c == "value")]
        mine = ev.filter(F.col("event_type") == kind) if kind != "error" else \
            ev.filter(F.col("event_type").isNull() | ~F.col("event_type").isin(*EVENT_KEYS))
        mine.select(*order).write.option("header", True).csv(f"{base}/{kind}")
    return [f"{base}/{kind}/*.csv" for kind in (*EVENT_KEYS, "error", ABSENT_TYPE)]


def q_stream_files(spark, sf_dir):
    """Delivered CSV files streamed through the checked ingest: headers by name, bad files fail alone."""
    from ..streaming.file_stream import start_stream
    from .ingest import Store
    store, dataset = Store(spark, scratch_path(spark, "stream-files")), _event_files_dataset()
    _deliver_event_files(spark, sf_dir, store.path("delivered"))
    start_stream(store, dataset, store.path("delivered", "*", "*.csv"), store.path("_checkpoint"), FILES_AS_OF).awaitTermination()
    return store.current_facts(dataset).select(*dataset.fact_columns)


def q_rebuild_raw(spark, sf_dir):
    """Facts rebuilt from the raw zone's bytes, by hash."""
    from .ingest import Store, ingest, rebuild
    store, dataset = Store(spark, scratch_path(spark, "rebuild-raw")), _event_files_dataset()
    ingest(store, dataset, _deliver_event_files(spark, sf_dir, store.path("delivered")), "load", 1, FILES_AS_OF)
    rebuild(store, dataset, "rebuild", FILES_AS_OF, write_base=True)
    return store.read("rebuilt", dataset.name).select(*dataset.fact_columns)


def q_backfill_files(spark, sf_dir):
    """Requested file sets against what was delivered: per set its status, first error and accepted rows."""
    from .ingest import Store, ingest
    store, dataset = Store(spark, scratch_path(spark, "backfill-files")), _event_files_dataset()
    done = ingest(store, dataset, _deliver_event_files(spark, sf_dir, store.path("delivered")), "backfill", 1, FILES_AS_OF)
    kind = F.regexp_extract("requested", r"/([^/]+)/[^/]*$", 1).alias("event_type")
    error = F.coalesce("landing_error", "header_error")
    status = done.files.groupBy(kind).agg(F.max("file_status").alias("_worst"), F.min(error).alias("error"))
    accepted = store.current_facts(dataset).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return status.join(accepted, "event_type", "left").select(
        "event_type", F.when(F.col("error").isNotNull(), F.lit("failed")).otherwise(F.lit("success")).alias("status"), "error",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("records_accepted"))


# ---------------------------------------------------------------- registry

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "forecast_accuracy": q_forecast_accuracy,
    "latest_capture_accuracy": q_latest_capture_accuracy,
    "read_accuracy": q_read_accuracy,
    "read_capture_accuracy": q_read_capture_accuracy,
    "contract_quarantine": q_contract_quarantine,
    "contract_accept": q_contract_accept,
    "coerce_quarantine": q_coerce_quarantine,
    "interval_normalize": q_interval_normalize,
    "dedup_keep_last": q_dedup_keep_last,
    "daily_station_mean": q_daily_station_mean,
    "wide_mean": q_wide_mean,
    "explode_readings": q_explode_readings,
    "scan_csv": q_scan_csv,
    "scan_json": q_scan_json,
    "landing_immutable": q_landing_immutable,
    "landing_capture_name": q_landing_capture_name,
    "landing_versioned": q_landing_versioned,
    "landing_latest": q_landing_latest,
    "upsert_latest": q_upsert_latest,
    "upsert_history": q_upsert_history,
    "incremental_overlap": q_incremental_overlap,
    "gap_detect": q_gap_detect,
    "gap_state": q_gap_state,
    "quality_rollup": q_quality_rollup,
    "freshness_state": q_freshness_state,
    "freshness_sweep": q_freshness_sweep,
    "freshness_sweep_result": q_freshness_sweep_result,
    "run_accounting": q_run_accounting,
    "backfill_status": q_backfill_status,
    "backfill_summary": q_backfill_summary,
    "completeness_check": q_completeness_check,
    "read_daily": q_read_daily,
    "read_history": q_read_history,
    "read_interval": q_read_interval,
    "request_guard": q_request_guard,
    "bulk_read": q_bulk_read,
    "incremental_pull": q_incremental_pull,
    "export_set": q_export_set,
    "read_envelope": q_read_envelope,
    "quality_newest": q_quality_newest,
    "export_window": q_export_window,
    "export_forecast_window": q_export_forecast_window,
    "snapshot_filter": q_snapshot_filter,
    "reconcile": q_reconcile,
    "stream_upsert": q_stream_upsert,
    "stream_files": q_stream_files,
    "rebuild_raw": q_rebuild_raw,
    "backfill_files": q_backfill_files,
}


EXACT_SUM_SQL = "CAST(CAST(sum(CAST(floor(value * 10000.0 + 0.5) AS BIGINT)) AS BIGINT) AS DOUBLE) / 10000.0"

HOURLY_DEDUP_SQL = """
SELECT event_id, user_id, hour, ts, event_type, value FROM (
  SELECT event_id, user_id, date_trunc('hour', ts) AS hour, ts, event_type, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
  FROM events) t WHERE rn = 1
"""

ACCEPTED_FILES_SQL = """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE event_type IN ('click', 'purchase', 'signup', 'view') AND value BETWEEN 1 AND 100"""

ORACLE_SQL: dict[str, str] = {
    "forecast_accuracy": ACCURACY_SQL_BODY.format(extra=""),
    "read_accuracy": ACCURACY_SQL_BODY.format(
        extra="AND l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-04-01'"),
    "latest_capture_accuracy": LATEST_CAPTURE_SQL,
    "read_capture_accuracy": LATEST_CAPTURE_SQL.replace(
        "WHERE l.l_shipdate", "WHERE o.o_orderdate >= TIMESTAMP '1996-01-01' AND o.o_orderdate < TIMESTAMP '1996-04-01'\n  AND l.l_shipdate"),
    "contract_quarantine": f"""
SELECT event_id, user_id, event_type, value, reason AS rejection_reason FROM (
  SELECT *, {EVENT_REASON_SQL} AS reason FROM events) t WHERE reason <> ''""",
    "contract_accept": f"""
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, {EVENT_REASON_SQL} AS reason FROM events) t WHERE reason = ''""",
    "coerce_quarantine": """
SELECT event_id, raw_value, TRY_CAST(raw_value AS DOUBLE) AS value, TRY_CAST(raw_k AS BIGINT) AS k,
       concat_ws('; ',
         CASE WHEN raw_value IS NOT NULL AND TRY_CAST(raw_value AS DOUBLE) IS NULL THEN 'value:coerce(double)' END,
         CASE WHEN raw_k IS NOT NULL AND TRY_CAST(raw_k AS BIGINT) IS NULL THEN 'k:coerce(bigint)' END) AS rejection_reason
FROM (SELECT event_id,
             CASE WHEN event_type = 'error' THEN 'not-a-number' ELSE CAST(value AS VARCHAR) END AS raw_value,
             json_extract_string(props, '$.k') AS raw_k FROM events) t
WHERE (raw_value IS NOT NULL AND TRY_CAST(raw_value AS DOUBLE) IS NULL)
   OR (raw_k IS NOT NULL AND TRY_CAST(raw_k AS BIGINT) IS NULL)""",
    "interval_normalize": """
SELECT event_id,
       strptime(strftime(ts, '%m/%d/%Y %H:%M:%S'), '%m/%d/%Y %H:%M:%S') - INTERVAL 1 HOUR AS interval_start_utc,
       strptime(strftime(ts, '%m/%d/%Y %H:%M:%S'), '%m/%d/%Y %H:%M:%S') AS interval_end_utc,
       TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS event_date,
       date_trunc('second', ts) AS captured_at
FROM events""",
    "dedup_keep_last": HOURLY_DEDUP_SQL,
    "daily_station_mean": """
SELECT CAST(ts AS DATE) AS day, event_type, """ + exact_mean_sql("value", 4) + """ AS avg_value,
       CAST(count(*) AS BIGINT) AS readings, arg_min(props, event_id) AS first_props
FROM events GROUP BY CAST(ts AS DATE), event_type""",
    "wide_mean": """
SELECT event_type, """ + exact_mean_sql("value * 3600000000000.0::DOUBLE", 6) + """ AS avg_microjoules,
       CAST(count(*) AS BIGINT) AS readings
FROM events GROUP BY event_type""",
    "explode_readings": """
SELECT vec_id, CAST(pos AS BIGINT) AS pos, CAST(x AS DOUBLE) AS x FROM (
  SELECT vec_id, unnest(generate_series(0, len(embedding) - 1)) AS pos, unnest(embedding) AS x
  FROM embeddings) t""",
    "scan_csv": EVENTS_SQL,
    "scan_json": EVENTS_SQL,
    "landing_immutable": """
WITH m AS (SELECT doc_id, n_chars, sha256(text) AS sha FROM documents),
f AS (SELECT n_chars, arg_min(sha, doc_id) AS first_sha, min(doc_id) AS first_id FROM m GROUP BY n_chars)
SELECT m.doc_id, m.n_chars,
       CASE WHEN m.doc_id = f.first_id THEN 'landed' WHEN m.sha = f.first_sha THEN 'duplicate' ELSE 'collision' END AS landing_status,
       CASE WHEN m.doc_id <> f.first_id AND m.sha <> f.first_sha
            THEN 'immutable raw file ' || CAST(m.n_chars AS VARCHAR) || ' already landed with sha256 '
                 || substr(f.first_sha, 1, 12) || ', incoming sha256 ' || substr(m.sha, 1, 12) END AS landing_error
FROM m JOIN f USING (n_chars)""",
    "landing_capture_name": """
WITH m AS (SELECT event_id, coalesce(regexp_replace(CAST(ts AS VARCHAR), '[:. ]', '', 'g'), 'unknown') AS name,
                  sha256(props) AS sha FROM events),
f AS (SELECT name, arg_min(sha, event_id) AS first_sha, min(event_id) AS first_id FROM m GROUP BY name)
SELECT m.event_id, m.name,
       CASE WHEN m.event_id = f.first_id THEN 'landed' WHEN m.sha = f.first_sha THEN 'duplicate' ELSE 'collision' END AS landing_status
FROM m JOIN f USING (name)""",
    "landing_versioned": VERSIONS_SQL + """
SELECT n_chars, content_sha, version_name, first_doc_id, last_doc_id, arrivals FROM named""",
    "landing_latest": VERSIONS_SQL + """
SELECT regexp_extract(version_name, '^(.+?)(__[0-9a-f]{12})?\\.json$', 1) AS base_name,
       arg_max(version_name, last_doc_id) AS latest_name, max(last_doc_id) AS latest_doc_id,
       CAST(count(*) AS BIGINT) AS versions
FROM named GROUP BY 1""",
    "upsert_latest": """
WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value FROM events),
cur AS (SELECT user_id, hour, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id DESC) AS rn
          FROM h WHERE hour < TIMESTAMP '2024-01-20') t WHERE rn = 1),
inc AS (SELECT user_id, hour, event_id, value FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id, hour ORDER BY event_id DESC) AS rn
          FROM h WHERE hour >= TIMESTAMP '2024-01-15') t WHERE rn = 1)
SELECT coalesce(i.user_id, c.user_id) AS user_id, coalesce(i.hour, c.hour) AS hour,
       CASE WHEN i.user_id IS NOT NULL THEN i.event_id ELSE c.event_id END AS event_id,
       CASE WHEN i.user_id IS NOT NULL THEN i.value ELSE c.value END AS value
FROM cur c FULL JOIN inc i ON c.user_id = i.user_id AND c.hour = i.hour""",
    "upsert_history": """
WITH cur AS (SELECT user_id, ts, event_id, value FROM events WHERE ts < TIMESTAMP '2024-01-20'),
inc AS (SELECT user_id, ts, event_id, value FROM (
          SELECT user_id, ts, event_id, value + 1 AS value,
                 row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn
          FROM events WHERE ts >= TIMESTAMP '2024-01-15') t WHERE rn = 1)
SELECT * FROM cur c WHERE NOT EXISTS (SELECT 1 FROM inc i WHERE i.user_id = c.user_id AND i.ts = c.ts)
UNION ALL SELECT * FROM inc""",
    "incremental_overlap": """
SELECT event_id, ts, user_id, value FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') - INTERVAL 6 HOUR""",
    "incremental_pull": """
WITH first AS (
  SELECT max(ts) AS seen FROM events WHERE ts < TIMESTAMP '2024-01-20'
    AND NOT coalesce(event_type = 'view' AND ts >= TIMESTAMP '2024-01-20' - INTERVAL 3 HOUR, false)
), last AS (SELECT max(ts) AS seen FROM events)
SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
       CASE WHEN e.ts < f.seen - INTERVAL 6 HOUR THEN 'first' ELSE 'second' END AS run_id,
       f.seen AS watermark_before, l.seen AS watermark_after
FROM events e, first f, last l""",
    "export_set": """
WITH rows AS (
  SELECT 'history' AS export, event_id, ts, event_type, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-11'
  UNION ALL
  SELECT 'outlook', event_id, ts, event_type, value FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-25' AND DATE '2024-02-08'
  UNION ALL
  SELECT 'newest', * FROM (SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100) n
)
SELECT *, CAST(count(*) OVER (PARTITION BY export) AS BIGINT) AS record_count FROM rows""",
    "gap_detect": "WITH " + GAPS_CTE + " SELECT * FROM gaps",
    "gap_state": "WITH " + GAPS_CTE + " SELECT * FROM gaps",
    "quality_rollup": "WITH " + GAPS_CTE + """
, keys AS (SELECT DISTINCT event_type FROM events),
cnt AS (SELECT event_type, count(*) AS n FROM gaps GROUP BY event_type)
SELECT k.event_type, CAST(coalesce(c.n, 0) AS BIGINT) AS gap_count,
       CASE WHEN coalesce(c.n, 0) > 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN coalesce(c.n, 0) > 0 THEN CAST(c.n AS VARCHAR) || ' gap(s) detected' ELSE 'no gaps detected' END AS detail
FROM keys k LEFT JOIN cnt c USING (event_type)""",
    "freshness_state": "WITH " + FRESHNESS_CTE + " SELECT * FROM fs",
    "freshness_sweep": "WITH " + FRESHNESS_CTE + """
SELECT * FROM fs WHERE status <> 'fresh' OR last_success_at IS NULL
   OR last_success_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 25 HOUR""",
    "freshness_sweep_result": "WITH " + FRESHNESS_CTE + """
, st AS (SELECT count(*) AS n FROM fs WHERE status <> 'fresh' OR last_success_at IS NULL
           OR last_success_at < TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 25 HOUR)
SELECT 'sweep-2024-01-31' AS run_id, 'source_freshness_sweep' AS check_name,
       CASE WHEN n > 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN n > 0 THEN CAST(n AS VARCHAR) || ' stale/failing source(s)' ELSE 'all sources fresh' END AS detail,
       CAST(n AS BIGINT) AS stale_count FROM st""",
    "run_accounting": "WITH " + ACCOUNTING_CTE + " SELECT * FROM acct",
    "backfill_status": "WITH " + ACCOUNTING_CTE + """
, span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
requested AS (SELECT CAST(d AS DATE) AS day FROM span, generate_series(lo, hi + INTERVAL 3 DAY, INTERVAL 1 DAY) g(d))
SELECT r.day, CAST(coalesce(a.records_accepted, 0) AS BIGINT) AS records_accepted,
       CASE WHEN coalesce(a.records_accepted, 0) > 0 THEN 'success' ELSE 'failed' END AS status,
       CASE WHEN a.records_accepted IS NULL THEN 'source file not available'
            WHEN a.records_accepted = 0 THEN 'no rows accepted' END AS error
FROM requested r LEFT JOIN acct a USING (day)""",
    "backfill_summary": "WITH " + ACCOUNTING_CTE + """
, span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
requested AS (SELECT CAST(d AS DATE) AS day FROM span, generate_series(lo, hi + INTERVAL 3 DAY, INTERVAL 1 DAY) g(d))
SELECT CAST(count(*) AS BIGINT) AS attempted,
       CAST(count(*) FILTER (WHERE coalesce(a.records_accepted, 0) = 0) AS BIGINT) AS failed
FROM requested r LEFT JOIN acct a USING (day)""",
    "completeness_check": "WITH " + GAPS_CTE + """
SELECT 'check-2024-01-31' AS run_id, 'missing_interval_completeness' AS check_name,
       CASE WHEN count(*) > 0 THEN 'fail' ELSE 'pass' END AS status,
       CASE WHEN count(*) > 0 THEN CAST(count(*) AS VARCHAR) || ' gap(s) detected' ELSE 'no gaps detected' END AS detail
FROM gaps""",
    "read_daily": """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'
ORDER BY ts, event_id LIMIT 500""",
    "read_history": """
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'
ORDER BY o_orderdate, o_orderkey LIMIT 500""",
    "read_interval": """
SELECT event_id, ts, user_id, event_type, value FROM events
WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-09'
ORDER BY ts, event_id LIMIT 5000""",
    "request_guard": """
WITH r AS (
  SELECT event_id AS rid,
         CASE WHEN event_type = 'purchase' THEN strftime(CAST(ts AS DATE), '%Y/%m/%d')
              ELSE strftime(CAST(ts AS DATE), '%Y-%m-%d') END AS start_text,
         strftime(CAST(ts AS DATE) + CAST(floor(value * 2) - 20 AS INTEGER), '%Y-%m-%d') AS end_text,
         event_type AS key
  FROM events
), p AS (
  SELECT rid, key,
         CASE WHEN regexp_full_match(start_text, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(start_text AS DATE) END AS start_date,
         CASE WHEN regexp_full_match(end_text, '\\d{4}-\\d{2}-\\d{2}') THEN TRY_CAST(end_text AS DATE) END AS end_date
  FROM r
)
SELECT rid,
       CASE WHEN start_date IS NULL OR end_date IS NULL THEN 'invalid_date_format'
            WHEN start_date > end_date THEN 'invalid_date_range'
            WHEN end_date - start_date > 366 THEN 'date_range_too_large'
            WHEN key NOT IN ('click', 'purchase', 'signup', 'view') OR key IS NULL THEN 'unknown_key'
            ELSE 'ok' END AS request_status,
       start_date, end_date
FROM p""",
    "bulk_read": "WITH " + BULK_REQ_CTE + """
, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY ts, event_id) AS row_in_request,
         count(*) OVER (PARTITION BY rid) AS matched_rows FROM matched)
SELECT rid, event_id, ts, value, CAST(row_in_request AS BIGINT) AS row_in_request,
       CAST(matched_rows AS BIGINT) AS matched_rows, matched_rows > 100 AS truncated
FROM ranked WHERE row_in_request <= 100""",
    "read_envelope": "WITH " + BULK_REQ_CTE + """
, stats AS (SELECT rid, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM matched GROUP BY rid)
SELECT g.rid, 'events' AS source, g.request_status, g.start_date, g.end_date,
       CAST(least(coalesce(s.n, 0), 100) AS BIGINT) AS record_count,
       CAST(coalesce(s.n, 0) AS BIGINT) AS matched_rows, s.first_ts, s.last_ts,
       coalesce(s.n, 0) > 100 AS truncated,
       CASE WHEN g.request_status = 'ok' THEN 'quarantine_excluded' END AS quality_status,
       TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp,
       ['Curated data only -- quarantined/rejected records are never included.'] AS known_limitations
FROM guarded g LEFT JOIN stats s USING (rid)""",
    "stream_files": ACCEPTED_FILES_SQL,
    "rebuild_raw": ACCEPTED_FILES_SQL,
    "backfill_files": """
SELECT t.event_type, CASE WHEN t.error IS NULL THEN 'success' ELSE 'failed' END AS status, t.error,
       CAST(count(e.event_id) FILTER (WHERE t.error IS NULL AND e.value BETWEEN 1 AND 100) AS BIGINT) AS records_accepted
FROM (VALUES ('click', NULL), ('purchase', NULL), ('signup', NULL), ('view', NULL), ('error', 'missing columns: value'),
             ('refund', 'source file not available')) t(event_type, error)
LEFT JOIN events e ON e.event_type = t.event_type GROUP BY t.event_type, t.error""",
    "stream_upsert": """
SELECT user_id, hour, event_id, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour, event_id, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn
  FROM events) t WHERE rn = 1""",
    "quality_newest": """
SELECT event_id, ts, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 100""",
    "export_window": """
SELECT event_id, ts, event_type, value FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-11'""",
    "export_forecast_window": """
SELECT event_id, ts, event_type, value FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-24'""",
    "snapshot_filter": """
SELECT event_id, CAST(ts AS VARCHAR) AS ts_text, event_type, value FROM events
WHERE event_type = 'view'
  AND TRY_CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'
ORDER BY event_id LIMIT 500""",
    "reconcile": """
WITH l AS (SELECT user_id, CAST(ts AS DATE) AS day, """ + EXACT_SUM_SQL + """ AS total FROM events
           WHERE event_type IN ('click', 'view') GROUP BY 1, 2),
r AS (SELECT user_id, CAST(ts AS DATE) AS day, """ + EXACT_SUM_SQL + """ AS total FROM events
      WHERE event_type IN ('purchase', 'signup', 'error') GROUP BY 1, 2)
SELECT coalesce(l.user_id, r.user_id) AS user_id, coalesce(l.day, r.day) AS day,
       l.total AS left_value, r.total AS right_value, l.total - r.total AS difference,
       CASE WHEN r.user_id IS NULL THEN 'only_left' WHEN l.user_id IS NULL THEN 'only_right'
            WHEN abs(l.total - r.total) <= 5.0 THEN 'match' ELSE 'mismatch' END AS reconcile_status
FROM l FULL JOIN r ON l.user_id = r.user_id AND l.day = r.day""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_sql_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run
    return {k: wrap(v) for k, v in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
