"""Named bounded reads, request guards, windowed exports and snapshot filters.

A read is a fixed query + validated parameters + a row cap + provenance.
Instead of one request per call, a *frame* of requests is validated and
answered in one job; a single read is the one-row case.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timeparse import parse_iso_date

# Read bounds and request outcomes.
MAX_RANGE_DAYS = 366
MAX_ROWS = 5000
SNAPSHOT_MAX_ROWS = 500
OK = "ok"
INVALID_FORMAT = "invalid_date_format"
INVALID_RANGE = "invalid_date_range"
RANGE_TOO_LARGE = "date_range_too_large"
UNKNOWN_KEY = "unknown_key"
QUALITY_STATUS = "quarantine_excluded"
LIMITATION = "Curated data only -- quarantined/rejected records are never included."


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def guard_requests(requests: DataFrame, start_col: str, end_col: str, key_col: str | None = None,
                   allowed_keys: Iterable[str] | None = None,
                   max_days: int = MAX_RANGE_DAYS) -> DataFrame:
    """Validate a frame of read requests; the first failing rule is the reason.

    Order: both dates strict ``YYYY-MM-DD`` and real; start <= end;
    ``end - start <= max_days``; key in the allowed set.
    Adds ``start_date``, ``end_date`` (DATE) and ``request_status``.
    """
    s = parse_iso_date(start_col)
    e = parse_iso_date(end_col)
    status = (F.when(s.isNull() | e.isNull(), F.lit(INVALID_FORMAT))
               .when(s > e, F.lit(INVALID_RANGE))
               .when(F.datediff(e, s) > F.lit(int(max_days)), F.lit(RANGE_TOO_LARGE)))
    if key_col is not None and allowed_keys is not None:
        status = status.when(~F.coalesce(_c(key_col).isin(*sorted(allowed_keys)), F.lit(False)),
                             F.lit(UNKNOWN_KEY))
    status = status.otherwise(F.lit(OK))
    return (requests.withColumn("start_date", s).withColumn("end_date", e)
                    .withColumn("request_status", status))


def day_range(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """Rows whose UTC day of ``ts_col`` is in the closed day range [start, end].

    Written as the half-open instant range ``start <= ts < end + 1 day`` (bounds
    cast to the column's own timestamp type) so the predicate folds to
    literals and reaches the Parquet scan.
    """
    t = df.schema[ts_col].dataType
    lo = F.lit(start).cast("date").cast(t)
    hi = F.date_add(F.lit(end).cast("date"), 1).cast(t)
    return df.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def bounded_read(df: DataFrame, ts_col: str, start, end, order_cols: Sequence[str],
                 cap: int = MAX_ROWS, key_col: str | None = None, key=None) -> DataFrame:
    """One named read: key filter, day range, ordered, at most ``cap`` rows (top-k)."""
    rows = df
    if key_col is not None:
        rows = rows.filter(F.col(key_col) == F.lit(key))
    rows = day_range(rows, ts_col, start, end)
    return rows.orderBy(*order_cols).limit(int(cap))


def _request_days(valid: DataFrame) -> DataFrame:
    """One row per (request, covered UTC day); the guard bounds a request to ``max_days + 1`` days."""
    return valid.select("_rid", "_key", F.explode(F.sequence(F.col("start_date"), F.col("end_date"))).alias("_day"))


def _valid_requests(requests: DataFrame, rid_col: str, req_key_col: str) -> DataFrame:
    return (requests.filter(F.col("request_status") == OK)
                    .select(F.col(rid_col).alias("_rid"), F.col(req_key_col).alias("_key"), "start_date", "end_date"))


def fact_day_stats(facts: DataFrame, fact_key_col: str, ts_col: str) -> DataFrame:
    """Facts pre-aggregated per (key, UTC day): count, first and last timestamp.

    A hash aggregate with map-side combine over two columns: what crosses the
    shuffle is one row per (key, day) per input partition, not the facts.
    """
    return (facts.groupBy(F.col(fact_key_col).alias("_skey"), F.to_date(F.col(ts_col)).alias("_sday"))
                 .agg(F.count(F.lit(1)).alias("_n"), F.min(ts_col).alias("_first"), F.max(ts_col).alias("_last")))


def _request_stats(requests: DataFrame, facts: DataFrame, rid_col: str, req_key_col: str,
                   fact_key_col: str, ts_col: str) -> DataFrame:
    """Per valid request: matched row count and first/last timestamp, from the per-day stats."""
    days = _request_days(_valid_requests(requests, rid_col, req_key_col))
    stats = fact_day_stats(facts, fact_key_col, ts_col)
    j = days.join(stats, (days["_key"] == stats["_skey"]) & (days["_day"] == stats["_sday"]))
    return j.groupBy("_rid").agg(F.sum("_n").alias("matched_rows"), F.min("_first").alias("first_ts"),
                                 F.max("_last").alias("last_ts"))


def bulk_read(requests: DataFrame, facts: DataFrame, rid_col: str, req_key_col: str,
              fact_key_col: str, ts_col: str, order_cols: Sequence[str],
              cap: int = MAX_ROWS) -> DataFrame:
    """Answer many validated range reads at once; ``rid_col`` names a request (unique).

    Range join without a theta join: each request is expanded to the UTC
    days it covers (at most ``MAX_RANGE_DAYS + 1`` per request, enforced by
    the guard), facts get their UTC day, and the two meet on an equi join
    ``(key, day)``; only matching rows are produced. ``matched_rows`` /
    ``truncated`` come from the per-(key, day) fact statistics, so counting
    never re-joins the fact rows themselves.

    A read in time order (``order_cols`` starts with ``ts_col``) knows from
    these statistics how many of its rows lie before each of its days, so

    * only the days that begin below the cap are joined at all,
    * the facts of a (key, day) are put in order once for all requests that
      overlap there, and only its first ``cap`` rows cross the shuffle
      (``WindowGroupLimit`` cuts each input partition first),
    * a row's place in a request is the count before its day plus its place
      in the day, so no request's rows are gathered or sorted again: the join
      emits the answer, ``cap`` rows a request at most.

    Any other order needs every matching row: the cap is then a
    ``row_number() <= cap`` per request, cut per partition in the same way.

    Rows without a key or a timestamp match no request; invalid requests and
    requests without a match give no rows (``read_envelope`` lists them).
    """
    cap = int(cap)
    first = order_cols[0]
    if isinstance(first, str) and first == ts_col:
        days = _days_to_read(requests, facts, rid_col, req_key_col, fact_key_col, ts_col, cap).alias("days")
        ranked = _first_of_day(requests, facts, fact_key_col, ts_col, order_cols, cap).alias("ranked")
        place = F.col("days._before") + F.col("ranked._place")
        met = (F.col("days._key") == F.col(f"ranked.`{fact_key_col}`")) & (F.col("days._day") == F.col("ranked._fday"))
        total = F.col("days.matched_rows")
        return (days.join(ranked, met & (place <= F.lit(cap)))
                    .select(F.col("days._rid").alias(rid_col), *[F.col(f"ranked.`{c}`") for c in facts.columns],
                            place.alias("row_in_request"), total, (total > F.lit(cap)).alias("truncated")))
    days = _request_days(_valid_requests(requests, rid_col, req_key_col))
    f = facts.withColumn("_fday", F.to_date(F.col(ts_col)))
    matched = (days.join(f, (days["_key"] == f[fact_key_col]) & (days["_day"] == f["_fday"]))
                   .drop("_key", "_day", "_fday").withColumnRenamed("_rid", rid_col))
    w = Window.partitionBy(rid_col).orderBy(*order_cols)
    capped = matched.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap)
    counts = _request_stats(requests, facts, rid_col, req_key_col, fact_key_col, ts_col) \
        .select(F.col("_rid").alias(rid_col), "matched_rows")
    return (capped.join(counts, rid_col)
                  .withColumn("truncated", F.col("matched_rows") > F.lit(cap))
                  .withColumnRenamed("_rn", "row_in_request"))


def _days_to_read(requests: DataFrame, facts: DataFrame, rid_col: str, req_key_col: str,
                  fact_key_col: str, ts_col: str, cap: int) -> DataFrame:
    """The (request, day) pairs that the first ``cap`` rows of each request lie in.

    ``_before`` is the number of the request's rows on earlier days (a prefix
    sum over one row per day, 367 at most), ``matched_rows`` their number on all.
    """
    days = _request_days(_valid_requests(requests, rid_col, req_key_col))
    stats = fact_day_stats(facts, fact_key_col, ts_col)
    per_day = days.join(stats, (days["_key"] == stats["_skey"]) & (days["_day"] == stats["_sday"])) \
                  .select("_rid", "_key", "_day", "_n")
    request = Window.partitionBy("_rid").orderBy("_day")
    earlier = F.sum("_n").over(request.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(request.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return (per_day.withColumn("_before", F.coalesce(earlier, F.lit(0).cast("bigint"))).withColumn("matched_rows", total)
                   .filter(F.col("_before") < F.lit(cap)))


def _first_of_day(requests: DataFrame, facts: DataFrame, fact_key_col: str, ts_col: str,
                  order_cols: Sequence[str], cap: int) -> DataFrame:
    """The first ``cap`` facts of every (key, day) between the first and the last day any request asks for.

    The bounds are scalar subqueries over the requests; they reach the scan as filters on ``ts_col``.
    """
    t = facts.schema[ts_col].dataType
    asked = requests.filter(F.col("request_status") == OK)
    lo = asked.agg(F.min("start_date").cast(t)).scalar()
    hi = asked.agg(F.date_add(F.max("end_date"), 1).cast(t)).scalar()
    near = facts.filter((F.col(ts_col) >= lo) & (F.col(ts_col) < hi) & F.col(fact_key_col).isNotNull())
    w = Window.partitionBy(fact_key_col, "_fday").orderBy(*order_cols)
    return (near.withColumn("_fday", F.to_date(F.col(ts_col))).withColumn("_place", F.row_number().over(w))
                .filter(F.col("_place") <= F.lit(cap)))


def read_envelope(requests: DataFrame, facts: DataFrame, rid_col: str, req_key_col: str,
                  fact_key_col: str, ts_col: str, cap: int = MAX_ROWS, source: str = "facts",
                  generated_at=None) -> DataFrame:
    """One provenance row per request: source, status, period, count, first/last timestamp,
    truncated, quality status, answer time (``generated_at``, passed in) and known limitations.

    Invalid requests still get a row (count 0) carrying their rejection reason.
    Built from per-(key, day) fact statistics: the facts are aggregated once,
    never joined row by row to the requests.
    """
    stats = _request_stats(requests, facts, rid_col, req_key_col, fact_key_col, ts_col) \
        .withColumnRenamed("_rid", rid_col)
    out = requests.select(rid_col, "request_status", "start_date", "end_date").join(stats, rid_col, "left")
    n = F.coalesce(F.col("matched_rows"), F.lit(0)).cast("bigint")
    return out.select(rid_col, F.lit(source).alias("source"), "request_status", "start_date", "end_date",
                      F.least(n, F.lit(int(cap)).cast("bigint")).alias("record_count"),
                      n.alias("matched_rows"), "first_ts", "last_ts",
                      (n > F.lit(int(cap))).alias("truncated"),
                      F.when(F.col("request_status") == OK, F.lit(QUALITY_STATUS)).alias("quality_status"),
                      F.lit(generated_at).cast("timestamp").alias("ingestion_timestamp"),
                      F.array(F.lit(LIMITATION)).alias("known_limitations"))


def trailing_window(df: DataFrame, date_col, as_of, days: int) -> DataFrame:
    """Export window ``date >= as_of - days`` with no upper bound (late rows included)."""
    d = F.to_date(_c(date_col))
    return df.filter(d >= F.date_sub(F.lit(as_of).cast("date"), int(days)))


def forward_window(df: DataFrame, date_col, as_of, days: int) -> DataFrame:
    """Export window ``as_of <= date <= as_of + days`` (closed)."""
    d = F.to_date(_c(date_col))
    a = F.lit(as_of).cast("date")
    return df.filter((d >= a) & (d <= F.date_add(a, int(days))))


def newest(df: DataFrame, order_cols: Sequence[Column], n: int) -> DataFrame:
    """Newest-first cap, e.g. the latest check results (top-k, no full sort)."""
    return df.orderBy(*order_cols).limit(int(n))


def snapshot_filter(df: DataFrame, text_col: str, start, end, order_col: str,
                    key_col: str | None = None, key=None, cap: int = SNAPSHOT_MAX_ROWS) -> DataFrame:
    """Filter exported records by the date in the first 10 characters of a text field.

    Optional key equality first; missing or unparseable dates are dropped;
    closed range; the first ``cap`` rows in snapshot order.
    """
    rows = df
    if key_col is not None:
        rows = rows.filter(F.col(key_col) == F.lit(key))
    d = parse_iso_date(F.substring(F.col(text_col), 1, 10))
    rows = rows.filter(d.isNotNull() & (d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))
    return rows.orderBy(order_col).limit(int(cap))
