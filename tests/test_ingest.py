"""End-to-end ingest on re-created fixture-shaped files (own values, same layout)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridledger.operators import accuracy, quality
from gridledger.plans.datasets import DAILY, FORECAST, LOAD, WEATHER
from gridledger.plans.ingest import Store, ingest

AS_OF = dt.datetime(2026, 7, 17, 0, 0)
END0 = dt.datetime(2026, 7, 14, 5, 0)   # first interval end (UTC); start = end - 1 h


def _load_rows(n_hours=193, n_actual=26):
    """Newest first like the source; actuals only for the oldest ``n_actual`` hours of each series."""
    out = []
    for h in reversed(range(n_hours)):
        end = END0 + dt.timedelta(hours=h)
        local = end - dt.timedelta(hours=5)
        for baa, base in (("SPP", 40000), ("SWPW", 3600)):
            fc = base + (h * 37) % 900
            act = "" if h >= n_actual else str(fc + ((h * 53) % 200) - 100)
            out.append((local.strftime("%m/%d/%Y %H:%M:%S"), end.strftime("%m/%d/%Y %H:%M:%S"), str(fc), act, baa))
    return out


def _write_csv(path, rows, header="Interval,GMTIntervalEnd,MTLF,Averaged Actual,BAA"):
    path.write_text(header + "\n" + "\n".join(",".join(r) for r in rows) + "\n")
    return str(path)


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def _brute_accuracy(rows):
    acc = {}
    for _, end, fc, act, baa in rows:
        if not act:
            continue
        start = dt.datetime.strptime(end, "%m/%d/%Y %H:%M:%S") - dt.timedelta(hours=1)
        acc.setdefault((baa, start.date()), []).append((float(fc), float(act)))
    out = {}
    for k, v in acc.items():
        n = len(v)
        out[k] = (n, sum(a - f for f, a in v) / n, sum(abs(a - f) for f, a in v) / n,
                  sum(abs(a - f) / a for f, a in v) / n * 100)
    return out


def test_load_file_end_to_end(spark, store, tmp_path):
    rows = _load_rows()
    p = _write_csv(tmp_path / "OP-MTLF-202607150000.csv", rows)
    res = ingest(store, LOAD, [p], "run-1", 1, AS_OF)
    run = res.run.first()
    assert (run["status"], run["records_in"], run["records_accepted"], run["records_quarantined"]) == \
           ("success", 386, 386, 0)
    facts = store.current_facts(LOAD)
    assert facts.count() == 386
    per = {r["baa"]: (r["n"], r["nn"]) for r in
           facts.groupBy("baa").agg(F.count(F.lit(1)).alias("n"), F.count("load_actual_mw").alias("nn")).collect()}
    assert per == {"SPP": (193, 26), "SWPW": (193, 26)}
    bounds = facts.agg(F.min("interval_start_utc"), F.max("interval_start_utc")).first()
    assert bounds[0] == dt.datetime(2026, 7, 14, 4) and bounds[1] == dt.datetime(2026, 7, 22, 4)
    assert facts.filter(F.to_date("interval_start_utc") == "2026-07-15").groupBy("baa").count() \
                .agg(F.min("count"), F.max("count")).first() == (24, 24)
    # accuracy view equals a plain-Python computation
    acc = accuracy.interval_accuracy(facts, ["baa"], "interval_start_utc", "load_forecast_mw", "load_actual_mw")
    got = {(r["baa"], r["day"]): (r["interval_count"], r["mean_bias"], r["mean_abs_error"], r["mean_abs_pct_error"])
           for r in acc.collect()}
    want = _brute_accuracy(rows)
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0]
        for a, b in zip(got[k][1:], want[k][1:]):
            assert abs(a - b) <= 1e-9 * max(1.0, abs(b))
    # completeness check was recorded: full grid, no gaps
    chk = spark.read.parquet(store.path("ledger", "checks")).first()
    assert (chk["status"], chk["detail"]) == ("pass", "no gaps detected")
    # quarantine written only when something is rejected
    assert spark.read.parquet(store.path("manifest", "spp_load")).count() == 1


def test_reingest_identical_file_is_idempotent_and_collision_fails(spark, store, tmp_path):
    rows = _load_rows()
    d1 = tmp_path / "a"
    d1.mkdir()
    p = _write_csv(d1 / "OP-MTLF-202607150000.csv", rows)
    ingest(store, LOAD, [p], "run-1", 1, AS_OF)
    ingest(store, LOAD, [p], "run-2", 2, AS_OF)
    assert store.current_facts(LOAD).count() == 386
    runs = store.runs().filter(F.col("source") == "spp_load")
    assert runs.count() == 2
    # same name, different bytes: the file fails as a whole, earlier data stays
    d2 = tmp_path / "b"
    d2.mkdir()
    changed = [r[:2] + (str(int(r[2]) + 1),) + r[3:] for r in rows]
    p2 = _write_csv(d2 / "OP-MTLF-202607150000.csv", changed)
    res = ingest(store, LOAD, [p2], "run-3", 3, AS_OF)
    f = res.files.first()
    assert f["landing_status"] == "collision" and f["file_status"] == "failed"
    assert "immutable" in f["landing_error"]
    assert res.run.first()["status"] == "failed"
    assert store.current_facts(LOAD).agg(F.sum("load_forecast_mw")).first()[0] == \
        sum(float(r[2]) for r in rows)


def test_bad_rows_quarantined_bad_header_file_fails_others_load(spark, store, tmp_path):
    rows = _load_rows(48, 48)
    mutated = list(rows)
    mutated[3] = mutated[3][:4] + ("XYZ",)
    mutated[5] = mutated[5][:2] + ("-100",) + mutated[5][3:]
    mutated[7] = mutated[7][:2] + ("not-a-number",) + mutated[7][3:]
    good = _write_csv(tmp_path / "day1.csv", mutated)
    bad = _write_csv(tmp_path / "day2.csv", rows, header="Interval,GMTIntervalEnd,MTLF,BAA")
    res = ingest(store, LOAD, [good, bad], "run-1", 1, AS_OF)
    run = res.run.first()
    assert run["records_quarantined"] == 3 and run["records_accepted"] == 93 and run["files_failed"] == 1
    q = spark.read.parquet(store.path("quarantine", "spp_load"))
    reasons = sorted(r["rejection_reason"] for r in q.collect())
    assert reasons == ["BAA:isin(SPP,SWPW)", "load_forecast_mw:coerce(double)", "load_forecast_mw:ge(0)"]
    st = {r["source_file"]: r["file_status"] for r in res.files.collect()}
    assert st == {"day1.csv": "success", "day2.csv": "failed"}


def test_in_file_duplicate_keeps_last_line(spark, store, tmp_path):
    rows = _load_rows(4, 4)
    dup = rows[0][:2] + ("123",) + rows[0][3:]
    p = _write_csv(tmp_path / "dup.csv", rows + [dup])
    ingest(store, LOAD, [p], "run-1", 1, AS_OF)
    facts = store.current_facts(LOAD)
    assert facts.count() == 8
    key_end = dt.datetime.strptime(rows[0][1], "%m/%d/%Y %H:%M:%S")
    got = facts.filter((F.col("baa") == rows[0][4]) & (F.col("interval_end_utc") == key_end)).first()
    assert got["load_forecast_mw"] == 123.0


def _json(path, obj):
    path.write_text(json.dumps(obj))
    return str(path)


DAILY_DOCS = [("2026-01-01", 12.4, 100.0, "complete"), ("2026-01-02", 9.8, 93.75, "partial"),
              ("2026-01-04", 15.1, 100.0, "complete")]


def _daily_doc(day, kwh, pct, status):
    return {"date": day, "system": "home", "solar_production_kwh": kwh, "completeness_pct": pct,
            "data_status": status, "ingested_at": "2026-01-05T00:00:00+00:00", "source": "device",
            "source_record_count": 96}


def _forecast_doc(generated, days):
    return {"generated_at_utc": generated, "model_version": "m1",
            "location": {"station": "KMDS", "latitude": 1.0, "longitude": 2.0},
            "projection_days": [{"date": d, "expected_units_w_m2h": 1.0, "hours_in_forecast": 9, "projected_kwh": v}
                                for d, v in days]}


def test_household_bridges_and_accuracy(spark, store, tmp_path):
    dd = tmp_path / "daily"
    dd.mkdir()
    paths = [_json(dd / f"{d}.json", _daily_doc(d, k, p, s)) for d, k, p, s in DAILY_DOCS]
    r = ingest(store, DAILY, paths, "d-1", 1, AS_OF).run.first()
    assert r["records_accepted"] == 3
    daily = store.current_facts(DAILY)
    got = sorted((str(x["date"]), x["solar_production_kwh"], x["completeness_pct"], x["data_status"])
                 for x in daily.collect())
    assert got == [(d, k, p, s) for d, k, p, s in DAILY_DOCS]

    fd = tmp_path / "fc"
    fd.mkdir()
    doc = _forecast_doc("2026-01-01T15:00:00+00:00",
                        [("2026-01-02", 10.5), ("2026-01-03", 11.0), ("2026-01-04", 14.8), ("2026-01-05", 12.0)])
    res = ingest(store, FORECAST, [_json(fd / "projection_2026-01-01.json", doc)], "f-1", 1, AS_OF)
    assert res.run.first()["records_accepted"] == 4
    name = spark.read.parquet(store.path("manifest", FORECAST.name)).first()["name"]
    assert name == "2026-01-01T150000+0000.json"

    def acc():
        a = accuracy.latest_capture_accuracy(store.current_facts(DAILY), store.current_facts(FORECAST), "date",
                                             "forecast_for_date", "captured_at_utc", "solar_production_kwh",
                                             "forecast_kwh")
        return {str(x["date"]): round(x["bias"], 9) for x in a.collect()}
    assert acc() == {"2026-01-02": -0.7, "2026-01-04": 0.3}
    # a later capture for 01-04 wins
    doc2 = _forecast_doc("2026-01-02T15:00:00+00:00", [("2026-01-04", 14.9)])
    ingest(store, FORECAST, [_json(fd / "projection_2026-01-02.json", doc2)], "f-2", 2, AS_OF)
    assert store.current_facts(FORECAST).count() == 5
    assert acc() == {"2026-01-02": -0.7, "2026-01-04": 0.2}


def test_daily_revision_keeps_both_versions_uses_latest(spark, store, tmp_path):
    a, b = tmp_path / "v1", tmp_path / "v2"
    a.mkdir(), b.mkdir()
    ingest(store, DAILY, [_json(a / "2026-07-15.json", _daily_doc("2026-07-15", 80.0, 95.0, "partial"))],
           "r1", 1, AS_OF)
    ingest(store, DAILY, [_json(b / "2026-07-15.json", _daily_doc("2026-07-15", 83.51, 100.0, "complete"))],
           "r2", 2, AS_OF)
    man = spark.read.parquet(store.path("manifest", DAILY.name))
    assert sorted(r["version_name"] for r in man.collect())[0] == "2026-07-15.json"
    assert man.select("version_name").distinct().count() == 2
    rows = store.current_facts(DAILY).collect()
    assert len(rows) == 1 and rows[0]["solar_production_kwh"] == 83.51 and rows[0]["completeness_pct"] == 100.0


def _weather_doc(day, readings):
    return {"date": day, "station": "KMDS", "readings_available": len(readings),
            "recorded_at_utc": day + "T23:00:00Z",
            "readings": [{"timestamp_local": f"{day}T{h:02d}:00", "sky_cover_pct": s, "temperature_c": t}
                         for h, (t, s) in enumerate(readings)]}


def test_weather_station_day_means_and_evolving_day(spark, store, tmp_path):
    wd = tmp_path / "w"
    wd.mkdir()
    d1 = _json(wd / "2026-01-01.json", _weather_doc("2026-01-01", [(-8, 10), (-7, 20), (-6, 30), (-6, 30)]))
    d2 = _json(wd / "2026-01-02.json", _weather_doc("2026-01-02", [(-2, 70), (-1, 80), (0, 90), (-0.5, 95)]))
    ingest(store, WEATHER, [d1, d2], "w1", 1, AS_OF)
    got = sorted((str(r["date"]), r["station"], r["avg_temperature_c"], r["avg_sky_cover_pct"])
                 for r in store.current_facts(WEATHER).collect())
    assert got == [("2026-01-01", "KMDS", -6.75, 22.5), ("2026-01-02", "KMDS", -0.875, 83.75)]
    # evolving day: 4 readings, then a revision with 8 -> one row averaging the 8
    e1, e2 = tmp_path / "e1", tmp_path / "e2"
    e1.mkdir(), e2.mkdir()
    four = [(20 + h, 50) for h in range(4)]
    eight = [(20 + h, 50) for h in range(8)]
    ingest(store, WEATHER, [_json(e1 / "2026-07-15.json", _weather_doc("2026-07-15", four))], "w2", 2, AS_OF)
    ingest(store, WEATHER, [_json(e2 / "2026-07-15.json", _weather_doc("2026-07-15", eight))], "w3", 3, AS_OF)
    day = store.current_facts(WEATHER).filter(F.col("date") == "2026-07-15").collect()
    assert len(day) == 1 and day[0]["avg_temperature_c"] == 23.5


def test_freshness_from_ledger_after_runs(spark, store, tmp_path):
    p = _write_csv(tmp_path / "f.csv", _load_rows(24, 24))
    ingest(store, LOAD, [p], "run-1", 1, AS_OF)
    state = quality.freshness_state(store.runs(), seq_col="_batch_seq")
    assert quality.stale_sources(state, AS_OF + dt.timedelta(hours=1)).count() == 0
    assert quality.stale_sources(state, AS_OF + dt.timedelta(hours=26)).count() == 1


def test_rebuild_from_raw_equals_replayed_ingests(spark, store, tmp_path):
    from gridledger.plans.ingest import rebuild
    a, b = tmp_path / "v1", tmp_path / "v2"
    a.mkdir(), b.mkdir()
    ingest(store, DAILY, [_json(a / f"{d}.json", _daily_doc(d, k, p, s)) for d, k, p, s in DAILY_DOCS], "r1", 1, AS_OF)
    ingest(store, DAILY, [_json(b / "2026-01-02.json", _daily_doc("2026-01-02", 10.1, 100.0, "complete"))],
           "r2", 2, AS_OF)
    cols = ["date", "solar_production_kwh", "completeness_pct", "data_status"]
    want = sorted(tuple(r) for r in store.current_facts(DAILY).select(*cols).collect())
    got = sorted(tuple(r) for r in rebuild(store, DAILY, "rb", AS_OF, write_base=True).select(*cols).collect())
    assert got == want and len(got) == 3
    assert store.compact(DAILY) == 2
    after = sorted(tuple(r) for r in store.current_facts(DAILY).select(*cols).collect())
    assert after == want
    assert spark.read.parquet(store.path("rebuilt", DAILY.name)).count() == 3


def test_retrying_a_batch_is_idempotent(spark, store, tmp_path):
    """A crashed run retried under the same batch number replaces its partial output."""
    rows = _load_rows(24, 24)
    bad = rows + [rows[0][:4] + ("XYZ",)]
    p = _write_csv(tmp_path / "f.csv", bad)
    ingest(store, LOAD, [p], "run-1", 7, AS_OF)
    ingest(store, LOAD, [p], "run-1b", 7, AS_OF)          # same batch again
    assert store.current_facts(LOAD).count() == 48
    assert store.facts(LOAD).log().count() == 48
    assert spark.read.parquet(store.path("quarantine", LOAD.name)).count() == 1
    man = spark.read.parquet(store.path("manifest", LOAD.name))
    assert man.count() == 1 and man.first()["landing_status"] == "landed"


def test_quality_sweep_records_checks_and_its_own_run(spark, store, tmp_path):
    from gridledger.plans.sweep import run_quality_sweep
    hours = [h for h in range(48) if h != 20]
    rows = [r for r in _load_rows(48, 48)
            if not (r[4] == "SPP" and r[1] == (END0 + dt.timedelta(hours=20)).strftime("%m/%d/%Y %H:%M:%S"))]
    assert len(rows) == 95 and len(hours) == 47
    ingest(store, LOAD, [_write_csv(tmp_path / "g.csv", rows)], "run-1", 1, AS_OF)
    fresh = {r["check_name"]: (r["status"], r["detail"]) for r in
             run_quality_sweep(store, "sw-1", 1, AS_OF + dt.timedelta(hours=1)).collect()}
    assert fresh == {"missing_interval_completeness": ("fail", "1 gap(s) detected"),
                     "source_freshness_sweep": ("pass", "all sources fresh")}
    late = {r["check_name"]: r["detail"] for r in
            run_quality_sweep(store, "sw-2", 2, AS_OF + dt.timedelta(hours=30)).collect()}
    assert late["source_freshness_sweep"] == "1 stale/failing source(s)"
    sweeps = store.runs().filter(F.col("source") == "quality_sweep").collect()
    assert sorted(r["status"] for r in sweeps) == ["success", "success"]
    # the load run's watermark is the latest event date it loaded
    load_run = store.runs().filter(F.col("source") == "spp_load").first()
    assert load_run["watermark_after"] == "2026-07-16"


def test_partial_status_when_rows_are_quarantined(spark, store, tmp_path):
    rows = _load_rows(4, 4)
    p = _write_csv(tmp_path / "p.csv", rows + [rows[0][:4] + ("XYZ",)])
    run = ingest(store, LOAD, [p], "run-1", 1, AS_OF, partial_on_rejects=True).run.first()
    assert run["status"] == "partial" and run["records_quarantined"] == 1
    assert store.current_facts(LOAD).count() == 8


def test_null_readings_document_yields_no_rows_and_is_counted(spark, store, tmp_path):
    wd = tmp_path / "w"
    wd.mkdir()
    good = _json(wd / "2026-01-01.json", _weather_doc("2026-01-01", [(-8, 10), (-7, 20)]))
    null_doc = {"date": "2026-01-02", "station": "KMDS", "readings": None}
    bad = _json(wd / "2026-01-02.json", null_doc)
    run = ingest(store, WEATHER, [good, bad], "w1", 1, AS_OF).run.first()
    assert run["records_empty_documents"] == 1 and run["records_accepted"] == 1
    assert not store.exists("quarantine", WEATHER.name)      # nothing rejected: no quarantine output


def test_oversized_file_fails_alone_without_being_read(spark, store, tmp_path):
    small = _write_csv(tmp_path / "small.csv", _load_rows(4, 4))
    big = _write_csv(tmp_path / "big.csv", _load_rows(48, 48))
    res = ingest(store, LOAD, [small, big], "run-1", 1, AS_OF, max_document_bytes=2000)
    st = {r["source_file"]: (r["file_status"], r["landing_error"]) for r in res.files.collect()}
    assert st["small.csv"] == ("success", None)
    assert st["big.csv"][0] == "failed" and "document limit" in st["big.csv"][1]
    run = res.run.first()
    assert run["status"] == "success" and run["files_failed"] == 1 and run["records_accepted"] == 8
