import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridledger.operators import reads
from gridledger.plans.datasets import DAILY, LOAD
from gridledger.plans.export import export_all, read_export
from gridledger.plans.ingest import Store, ingest
from gridledger.sources.files import read_snapshot
from gridledger.streaming.file_stream import start_csv_stream

from .test_ingest import AS_OF, _daily_doc, _json, _load_rows, _write_csv


def test_request_guard_rules_and_order(spark):
    req = spark.createDataFrame([
        (1, "2026-01-01", "2027-01-02", "SPP"),    # 366 days: ok
        (2, "2026-01-01", "2027-01-03", "SPP"),    # 367 days: too large
        (3, "2026-01-05", "2026-01-01", "SPP"),    # inverted
        (4, "2026/01/01", "2026-01-02", "SPP"),    # format
        (5, "2026-02-30", "2026-03-01", "SPP"),    # not a real date
        (6, "2026-01-01", "2026-01-02", "XYZ"),    # unknown key
        (7, "2026-01-05", "2026-01-01", "XYZ"),    # date rules come first
        (8, "2026-01-01", "2026-01-01", None),     # missing key
    ], "rid int, s string, e string, k string")
    got = {r["rid"]: r["request_status"] for r in reads.guard_requests(req, "s", "e", "k", ["SPP", "SWPW"]).collect()}
    assert got == {1: "ok", 2: "date_range_too_large", 3: "invalid_date_range", 4: "invalid_date_format",
                   5: "invalid_date_format", 6: "unknown_key", 7: "invalid_date_range", 8: "unknown_key"}


def _facts(spark):
    t0 = dt.datetime(2026, 7, 1)
    data = [("A" if i % 3 else "B", t0 + dt.timedelta(minutes=37 * i), i) for i in range(3000)]
    return spark.createDataFrame(data, "k string, ts timestamp, id long"), data


def test_bulk_read_matches_brute_force_with_cap_and_truncation(spark):
    facts, data = _facts(spark)
    req = spark.createDataFrame([("r1", "2026-07-02", "2026-07-04", "A"), ("r2", "2026-07-10", "2026-07-10", "B"),
                                 ("r3", "2026-07-20", "2026-07-19", "A"), ("r4", "2026-12-01", "2026-12-02", "A")],
                                "rid string, s string, e string, key string")
    g = reads.guard_requests(req, "s", "e", "key", ["A", "B"])
    cap = 50
    out = reads.bulk_read(g, facts, "rid", "key", "k", "ts", ["ts", "id"], cap=cap).collect()
    spans = {"r1": ("A", dt.date(2026, 7, 2), dt.date(2026, 7, 4)), "r2": ("B", dt.date(2026, 7, 10), dt.date(2026, 7, 10)),
             "r4": ("A", dt.date(2026, 12, 1), dt.date(2026, 12, 2))}
    for rid, (k, lo, hi) in spans.items():
        match = sorted((t, i) for kk, t, i in data if kk == k and lo <= t.date() <= hi)
        mine = sorted((r["ts"], r["id"]) for r in out if r["rid"] == rid)
        assert mine == match[:cap]
        if mine:
            flags = {(r["matched_rows"], r["truncated"]) for r in out if r["rid"] == rid}
            assert flags == {(len(match), len(match) > cap)}
    assert not [r for r in out if r["rid"] == "r3"]
    env = {r["rid"]: r for r in reads.read_envelope(g, facts, "rid", "key", "k", "ts", cap=cap).collect()}
    assert env["r3"]["request_status"] == "invalid_date_range" and env["r3"]["record_count"] == 0
    assert env["r1"]["truncated"] and env["r1"]["record_count"] == cap
    assert env["r4"]["matched_rows"] == 0 and env["r4"]["first_ts"] is None


def test_bounded_read_and_windows(spark):
    facts, data = _facts(spark)
    got = reads.bounded_read(facts, "ts", "2026-07-02", "2026-07-03", ["ts", "id"], cap=10, key_col="k", key="B")
    want = sorted((t, i) for k, t, i in data if k == "B" and dt.date(2026, 7, 2) <= t.date() <= dt.date(2026, 7, 3))[:10]
    assert [(r["ts"], r["id"]) for r in got.collect()] == want
    trailing = reads.trailing_window(facts, "ts", "2026-07-20", 3).count()
    assert trailing == sum(1 for _, t, _ in data if t.date() >= dt.date(2026, 7, 17))
    fwd = reads.forward_window(facts, "ts", "2026-07-03", 2).count()
    assert fwd == sum(1 for _, t, _ in data if dt.date(2026, 7, 3) <= t.date() <= dt.date(2026, 7, 5))


def test_snapshot_filter_and_reader(spark, tmp_path):
    recs = [{"date": "2026-01-0%d" % d, "baa": "SPP" if d % 2 else "SWPW", "v": d} for d in range(1, 10)]
    recs.append({"date": "garbage", "baa": "SPP", "v": 0})
    recs.append({"baa": "SPP", "v": -1})
    p = tmp_path / "snap.json"
    p.write_text("\n".join(json.dumps(r) for r in recs))
    schema = T.StructType([T.StructField("date", T.StringType()), T.StructField("baa", T.StringType()),
                           T.StructField("v", T.LongType())])
    df, status = read_snapshot(spark, str(p), schema)
    assert status == "ok" and df.count() == 11
    got = reads.snapshot_filter(df, "date", "2026-01-02", "2026-01-07", "v", key_col="baa", key="SPP", cap=2)
    assert [r["v"] for r in got.collect()] == [3, 5]
    _, missing = read_snapshot(spark, str(tmp_path / "nope.json"), schema)
    assert missing == "export_not_available"
    bad = tmp_path / "bad.json"
    bad.write_text("{not json")
    _, corrupt = read_snapshot(spark, str(bad), schema)
    assert corrupt == "export_corrupt"


def test_export_all_writes_windows_and_envelopes(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    ingest(store, LOAD, [_write_csv(tmp_path / "l.csv", _load_rows(48, 48))], "r1", 1, AS_OF)
    dd = tmp_path / "d"
    dd.mkdir()
    docs = [("2026-01-01", 12.4, 100.0, "complete"), ("2026-07-16", 9.8, 93.75, "partial")]
    ingest(store, DAILY, [_json(dd / f"{d}.json", _daily_doc(d, k, p, s)) for d, k, p, s in docs], "r2", 1, AS_OF)
    out = str(tmp_path / "exports")
    assert read_export(spark, out, "household_solar_history").status == "export_not_available"
    names = export_all(store, out, dt.date(2026, 1, 15))
    assert {"household_solar_history", "spp_load_conditions", "spp_load_forecast_accuracy", "source_health",
            "data_quality"} <= set(names)
    hist = read_export(spark, out, "household_solar_history")
    assert hist.records.count() == 2                      # trailing window has no upper bound: July included
    assert hist.envelope["record_count"] == 2 and hist.envelope["source"] == "household_solar"
    assert read_export(spark, out, "spp_load_conditions").records.count() == 96
    assert read_export(spark, out, "household_solar_forecast").status == "export_not_available"



def test_csv_stream_catch_up_is_incremental(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    src = tmp_path / "incoming"
    src.mkdir()
    rows = _load_rows(48, 48)
    _write_csv(src / "f1.csv", rows[:40])
    ck = str(tmp_path / "ck")
    q = start_csv_stream(store, LOAD, str(src), ck, AS_OF)
    q.awaitTermination(300)
    assert store.current_facts(LOAD).count() == 40
    bad = rows[40:] + [rows[0][:4] + ("XYZ",)]
    _write_csv(src / "f2.csv", bad)
    q = start_csv_stream(store, LOAD, str(src), ck, AS_OF)
    q.awaitTermination(300)
    assert store.current_facts(LOAD).count() == 96
    assert spark.read.parquet(store.path("quarantine", LOAD.name)).count() == 1
    runs = store.runs().filter(F.col("source") == LOAD.name).orderBy("_batch_seq").collect()
    assert [r["records_in"] for r in runs] == [40, 57]


def test_replayed_micro_batch_is_skipped(spark, tmp_path):
    """foreachBatch may run a batch again after a failure: the ledger row makes it a no-op."""
    from gridledger.streaming.file_stream import upsert_batches
    store = Store(spark, str(tmp_path / "store"))
    batch = spark.createDataFrame([("a", 1, 1.0, "2026-01-01"), ("a", 2, 2.0, "2026-01-01"),
                                   ("b", 3, 3.0, "2026-01-02")], "k string, seq long, v double, event_date string")
    fn = upsert_batches(store, "src", ["k"], "event_date", lambda b: b, ["seq"], AS_OF)
    fn(batch, 0)
    fn(batch, 0)                                   # replay of the same micro-batch
    runs = store.runs().filter(F.col("source") == "src").collect()
    assert len(runs) == 1 and runs[0]["records_in"] == 3 and runs[0]["records_accepted"] == 2
    from gridledger.operators.upsert import ChangeLog
    log = ChangeLog(spark, store.path("facts", "src"), ["k"], "event_date")
    assert sorted((r["k"], r["v"]) for r in log.current().collect()) == [("a", 2.0), ("b", 3.0)]
    assert log.log().count() == 2
