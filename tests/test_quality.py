import datetime as dt
import random

from pyspark.sql import functions as F

from gridledger.operators import quality

T0 = dt.datetime(2026, 7, 14, 4, 0, 0)


def _series(spark, rows):
    return spark.createDataFrame(rows, "baa string, ts timestamp")


def _hourly(name, hours, start=T0):
    return [(name, start + dt.timedelta(hours=h)) for h in hours]


def brute_gaps(rows, max_gap_s):
    by = {}
    for k, t in rows:
        by.setdefault(k, []).append(t)
    out = []
    for k, ts in by.items():
        ts.sort()
        for a, b in zip(ts, ts[1:]):
            if (b - a).total_seconds() > max_gap_s:
                out.append((k, a, b))
    return sorted(out)


def test_full_hourly_grid_has_no_gaps(spark):
    df = _series(spark, _hourly("SPP", range(193)) + _hourly("SWPW", range(193)))
    assert quality.detect_gaps(df, ["baa"], "ts").count() == 0


def test_one_dropped_interior_hour_is_one_gap_not_interpolated(spark):
    hours = [h for h in range(193) if h != 100]
    df = _series(spark, _hourly("SPP", hours) + _hourly("SWPW", range(193)))
    g = quality.detect_gaps(df, ["baa"], "ts").collect()
    assert len(g) == 1
    assert g[0]["baa"] == "SPP"
    assert g[0]["prev_ts"] == T0 + dt.timedelta(hours=99)
    assert g[0]["next_ts"] == T0 + dt.timedelta(hours=101)
    assert g[0]["gap_seconds"] == 7200


def test_several_missing_hours_are_one_hole_and_edges_unchecked(spark):
    df = _series(spark, _hourly("SPP", [5, 6, 7, 20, 21]))
    g = quality.detect_gaps(df, ["baa"], "ts").collect()
    assert len(g) == 1 and g[0]["gap_seconds"] == 13 * 3600


def test_exactly_one_hour_is_not_a_gap_and_one_microsecond_more_is(spark):
    t = T0
    df = _series(spark, [("A", t), ("A", t + dt.timedelta(hours=1)),
                         ("A", t + dt.timedelta(hours=2, microseconds=1))])
    g = quality.detect_gaps(df, ["baa"], "ts").collect()
    assert len(g) == 1 and g[0]["prev_ts"] == t + dt.timedelta(hours=1)


def test_matches_brute_force_lag_on_irregular_series_with_small_fanout(spark):
    rnd = random.Random(7)
    rows = []
    for key in ["a", "b", "c"]:
        t = T0
        for _ in range(400):
            t += dt.timedelta(seconds=rnd.choice([60, 600, 1800, 3600, 3601, 5400, 20000]))
            rows.append((key, t))
    rows += [("a", rows[10][1])]  # a duplicate timestamp is not a gap
    df = _series(spark, rows).repartition(7)
    for fanout in (1, 3, 1024):
        got = sorted((r["baa"], r["prev_ts"], r["next_ts"])
                     for r in quality.detect_gaps(df, ["baa"], "ts", 3600, fanout=fanout).collect())
        assert got == brute_gaps(rows, 3600), fanout


def test_completeness_rows(spark):
    df = _series(spark, _hourly("SPP", [0, 1, 5]) + _hourly("SWPW", [0, 1, 2]))
    gaps = quality.detect_gaps(df, ["baa"], "ts")
    res = {r["baa"]: (r["status"], r["detail"]) for r in
           quality.completeness_by_key(df.select("baa").distinct(), gaps, ["baa"]).collect()}
    assert res == {"SPP": ("fail", "1 gap(s) detected"), "SWPW": ("pass", "no gaps detected")}
    one = quality.completeness_result(gaps, "r1", "2026-07-17 00:00:00").first()
    assert (one["status"], one["detail"], one["check_name"]) == ("fail", "1 gap(s) detected",
                                                                 "missing_interval_completeness")


def _ledger(spark, rows):
    return spark.createDataFrame(rows, "source string, finished_at timestamp, status string, seq long, watermark string")


def test_freshness_state_and_sweep(spark):
    t = dt.datetime(2026, 7, 16, 12)
    led = _ledger(spark, [("load", t, "success", 1, "2026-07-16"),
                          ("load", t + dt.timedelta(hours=1), "failed", 2, None),
                          ("solar", t, "success", 3, "2026-07-16"),
                          ("old", t - dt.timedelta(hours=30), "success", 4, "2026-07-15")])
    st = {r["source"]: r for r in quality.freshness_state(led, seq_col="seq", watermark_col="watermark").collect()}
    assert st["load"]["status"] == "failing"
    assert st["load"]["last_success_at"] == t            # kept after a failure
    assert st["load"]["last_attempt_at"] == t + dt.timedelta(hours=1)
    assert st["load"]["current_watermark"] == "2026-07-16"
    parity = {r["source"]: r for r in quality.freshness_state(led, seq_col="seq",
                                                              parity_null_on_failure=True).collect()}
    assert parity["load"]["last_success_at"] is None
    state = quality.freshness_state(led, seq_col="seq")
    stale = sorted(r["source"] for r in quality.stale_sources(state, "2026-07-16 13:00:00").collect())
    assert stale == ["load", "old"]
    res = quality.sweep_result(quality.stale_sources(state, "2026-07-16 13:00:00"), "s", "2026-07-16 13:00:00").first()
    assert (res["status"], res["detail"]) == ("fail", "2 stale/failing source(s)")


def test_sweep_with_no_sources_passes(spark):
    empty = _ledger(spark, [])
    res = quality.sweep_result(quality.stale_sources(quality.freshness_state(empty), "2026-07-16"), "s",
                               "2026-07-16").first()
    assert (res["status"], res["detail"], res["stale_count"]) == ("pass", "all sources fresh", 0)


def test_run_accounting_counts(spark):
    df = spark.createDataFrame([("d1", "k1", None), ("d1", "k1", None), ("d1", "k2", "bad"), ("d2", "k3", None)],
                               "day string, key string, reason string")
    got = {r["day"]: tuple(r)[1:] for r in quality.run_accounting(df, ["day"], "reason", ["key"]).collect()}
    # records_in, quarantined, accepted (distinct keys), deduplicated
    assert got == {"d1": (3, 1, 1, 1), "d2": (1, 0, 1, 0)}


def test_backfill_one_unavailable_day_of_three(spark):
    req = spark.createDataFrame([("2026-07-14",), ("2026-07-15",), ("2026-07-16",)], "day string")
    out = spark.createDataFrame([("2026-07-14", 386, None), ("2026-07-16", 386, None)],
                                "day string, records_accepted long, error string")
    st = quality.backfill_status(req, out, ["day"])
    summary = quality.backfill_summary(st).first()
    assert (summary["attempted"], summary["failed"]) == (3, 1)
    failed = st.filter(F.col("status") == "failed").first()
    assert failed["day"] == "2026-07-15" and failed["error"] == "source file not available"
