"""Cap-aware bulk reads, exports published as one set, incremental pulls and named reads."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from gridledger.operators import reads
from gridledger.operators.commits import create_if_absent
from gridledger.plans import export
from gridledger.plans.datasets import DAILY, FORECAST, LOAD
from gridledger.plans.export import export_all, latest_set, publish, read_export
from gridledger.plans.ingest import Store, ingest
from gridledger.plans.named_reads import answer, read, read_health, read_quality
from gridledger.plans.repull import IncrementalFact

from .test_ingest import AS_OF, _daily_doc, _json, _load_rows, _write_csv

T0 = dt.datetime(2026, 7, 1)


# ---------------------------------------------------------------- cap-aware bulk read

def _hot_facts(spark, n=6000):
    """Three series over 20 days with ties; one day of one series holds a third of the rows; rows without key or time."""
    data = [("A", T0 + dt.timedelta(days=4, seconds=(i * 7) % 900), i) for i in range(n // 3)]
    data += [("AB"[i % 2] if i % 5 else "C", T0 + dt.timedelta(minutes=(i * 37) % (20 * 1440) // 60 * 60), i) for i in range(n // 3, n)]
    odd = [(None, T0, -1), ("A", None, -2)]
    return spark.createDataFrame(data + odd, "k string, ts timestamp, id long").repartition(7), data


def _overlapping(spark):
    asked = [(f"r{i}", str((T0 + dt.timedelta(days=lo)).date()), str((T0 + dt.timedelta(days=hi)).date()), k)
             for i, (lo, hi, k) in enumerate(itertools.product(range(0, 20, 3), (5, 9, 21), "AB")) if lo <= hi]
    asked += [("bad", "2026-07-09", "2026-07-01", "A"), ("odd", "2026-07-01", "2026-07-09", "Z"), ("null", "2026-07-01", "2026-07-09", None)]
    return reads.guard_requests(spark.createDataFrame(asked, "rid string, s string, e string, key string"), "s", "e", "key", ["A", "B"]), asked


def _join_outputs(df):
    """Output rows of every join in the executed plan."""
    jvm_plan = df._jdf.queryExecution().executedPlan()
    found, todo = [], [jvm_plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in node.getClass().getSimpleName():
            todo.append(node.plan())
            continue
        if "Join" in name:
            found.append((name, node.metrics().get("numOutputRows").get().value()))
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return found


@pytest.mark.parametrize("cap", [1, 40, 700, 100_000])
def test_bulk_read_in_time_order_equals_brute_force(spark, cap):
    facts, data = _hot_facts(spark)
    guarded, asked = _overlapping(spark)
    out = reads.bulk_read(guarded, facts, "rid", "key", "k", "ts", ["ts", "id"], cap=cap)
    got = {}
    for r in out.collect():
        got.setdefault(r["rid"], []).append((r["row_in_request"], r["k"], r["ts"], r["id"], r["matched_rows"], r["truncated"]))
    want = {}
    for rid, s, e, k in asked:
        match = sorted((t, i) for kk, t, i in data if kk == k and s <= str(t.date()) <= e)
        if rid.startswith("r") and match:
            want[rid] = [(p + 1, k, t, i, len(match), len(match) > cap) for p, (t, i) in enumerate(match[:cap])]
    assert {rid: sorted(v) for rid, v in got.items()} == want


def test_bulk_read_joins_no_more_rows_than_it_answers_with(spark):
    facts, _ = _hot_facts(spark)
    guarded, asked = _overlapping(spark)
    cap = 40
    out = reads.bulk_read(guarded, facts, "rid", "key", "k", "ts", ["ts", "id"], cap=cap)
    n = len(out.collect())
    joins = [rows for _, rows in _join_outputs(out)]
    days = reads._request_days(reads._valid_requests(guarded, "rid", "key")).count()
    assert len(joins) == 2 and n in joins and n <= len(asked) * cap
    assert max(joins) <= max(n, days)             # the other join is of days with their counts
    # the rows that cross the shuffle are the first of each day
    first = reads._first_of_day(guarded, facts, "k", "ts", ["ts", "id"], cap)
    assert first.groupBy("k", "_fday").count().agg(F.max("count")).first()[0] == cap
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_bulk_read_in_another_order_and_without_facts(spark):
    facts, data = _hot_facts(spark)
    guarded, asked = _overlapping(spark)
    out = reads.bulk_read(guarded, facts, "rid", "key", "k", "ts", [F.col("id").desc()], cap=15)
    got = {}
    for r in out.collect():
        got.setdefault(r["rid"], set()).add(r["id"])
    rid, s, e, k = asked[0]
    assert got[rid] == set(sorted((i for kk, t, i in data if kk == k and s <= str(t.date()) <= e), reverse=True)[:15])
    assert reads.bulk_read(guarded, facts.limit(0), "rid", "key", "k", "ts", ["ts", "id"]).count() == 0
    assert reads.bulk_read(guarded.limit(0), facts, "rid", "key", "k", "ts", ["ts", "id"]).count() == 0


# ---------------------------------------------------------------- exports as one set

def _forecast_doc(captured, days):
    return {"generated_at_utc": captured, "model_version": "m", "projection_days": [
        {"date": d, "expected_units_w_m2h": 1.0, "hours_in_forecast": 24, "projected_kwh": k} for d, k in days]}


@pytest.fixture()
def full_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for name in "dfl":
        (tmp_path / name).mkdir()
    ingest(store, LOAD, [_write_csv(tmp_path / "l" / "l.csv", _load_rows(48, 48))], "r1", 1, AS_OF)
    ingest(store, DAILY, [_json(tmp_path / "d" / "2026-07-15.json", _daily_doc("2026-07-15", 9.5, 100.0, "complete"))], "r2", 1, AS_OF)
    doc = _forecast_doc("2026-07-14T06:00:00+00:00", [("2026-07-15", 9.0), ("2026-07-16", 8.0)])
    ingest(store, FORECAST, [_json(tmp_path / "f" / "a.json", doc)], "r3", 1, AS_OF)
    return store


ALL_SEVEN = {"household_solar_history", "household_solar_forecast", "household_forecast_accuracy", "spp_load_conditions",
             "spp_load_forecast_accuracy", "source_health", "data_quality"}


def test_all_seven_exports_agree_while_the_store_changes(spark, full_store, tmp_path, monkeypatch):
    out = str(tmp_path / "exports")
    batch = itertools.count(2)
    plain = export._write_envelope

    def with_a_run_in_between(*args):
        n = next(batch)               # a run commits between the records and the envelope of each export
        day = dt.date(2026, 7, 15) + dt.timedelta(days=n)
        fact = spark.createDataFrame([(day, 1.0 + n, 100.0, "complete", "x.json", AS_OF, f"d{n}", day)],
                                     "date date, solar_production_kwh double, completeness_pct double, data_status string, "
                                     "source_file string, ingested_at timestamp, pipeline_run_id string, event_date date")
        full_store.facts(DAILY).append(fact, n)
        full_store.record_run(run_id=f"d{n}", source=DAILY.name, _batch_seq=n, _attempt=0, started_at=AS_OF, finished_at=AS_OF, status="success")
        plain(*args)

    monkeypatch.setattr(export, "_write_envelope", with_a_run_in_between)
    assert set(export_all(full_store, out, dt.date(2026, 7, 16))) == ALL_SEVEN
    monkeypatch.setattr(export, "_write_envelope", plain)
    for name in ALL_SEVEN:
        one = read_export(spark, out, name)
        assert one.status == "ok" and one.records.count() == one.envelope["record_count"] > 0, name
    # one state of the ledger: the runs that came in between are in no export of the set
    assert read_export(spark, out, "household_solar_history").records.count() == 1
    health = {r["source"]: r for r in read_export(spark, out, "source_health").records.collect()}
    assert set(health) == {"spp_load", "household_solar", "household_solar_forecast"}
    export_all(full_store, out, dt.date(2026, 7, 16))
    assert read_export(spark, out, "household_solar_history").records.count() == 8


def test_a_reader_sees_finished_sets_only(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "exports")
    one = {n: ("s", spark.range(3).withColumn("t", F.lit("2026-01-01 00:00:00.123456").cast("timestamp"))) for n in "ab"}
    two = {n: ("s", spark.range(5)) for n in "ab"}
    first = publish(spark, one, out, AS_OF)
    plain, calls = export._write_envelope, itertools.count()

    def dies(*args):
        if next(calls) == 1:
            raise RuntimeError("lost")
        plain(*args)

    monkeypatch.setattr(export, "_write_envelope", dies)
    with pytest.raises(RuntimeError):
        publish(spark, two, out, AS_OF)
    monkeypatch.setattr(export, "_write_envelope", plain)
    assert latest_set(spark, out) == first
    a = read_export(spark, out, "a")
    assert a.envelope["record_count"] == a.records.count() == 3
    assert a.records.first()["t"] == dt.datetime(2026, 1, 1, 0, 0, 0, 123456)
    # a pointer whose text is not there yet does not count
    create_if_absent(spark, f"{out}/pointers/2", "")
    assert latest_set(spark, out) == first
    second = publish(spark, two, out, AS_OF)
    assert latest_set(spark, out) == second and read_export(spark, out, "b").records.count() == 5
    assert read_export(spark, out, "b", first).records.count() == 3       # a reader may stay with its set
    empty = publish(spark, {"a": ("s", spark.range(0))}, out, AS_OF)
    got = read_export(spark, out, "a", empty)
    assert got.status == "ok" and got.envelope["record_count"] == 0 and got.records.count() == 0 and got.records.columns == ["id"]
    assert read_export(spark, out, "b", empty).status == "export_not_available"


def test_a_damaged_export_is_not_answered(spark, tmp_path):
    out = str(tmp_path / "exports")
    set_id = publish(spark, {"a": ("s", spark.range(3))}, out, AS_OF)
    (tmp_path / "exports" / "sets" / set_id / "a" / "records" / "part-x.json").write_text("{not json\n")
    got = read_export(spark, out, "a")
    assert (got.status, got.envelope, got.records) == ("export_corrupt", None, None)


# ---------------------------------------------------------------- incremental pull

def _source(spark, rows):
    return spark.createDataFrame(rows, "id long, ts timestamp, v double")



def test_two_pulls_equal_one_full_pull(spark, tmp_path):
    def at(h):
        return T0 + dt.timedelta(hours=h)
    first = [(i, at(i), float(i)) for i in range(48) if i != 45] + [(900, None, 1.0)]
    later = [(i, at(i), float(i) + (100 if i == 44 else 0)) for i in range(60)] + [(900, None, 2.0)]   # 45 late, 44 revised
    store = Store(spark, str(tmp_path / "s"))
    fact = IncrementalFact(store, "meter", ["id"], "ts", 6)
    assert fact.current() is None and fact.watermark() is None
    one = fact.pull(_source(spark, first), "a", AS_OF).first()
    assert (one["watermark_before"], one["watermark_after"], one["records_accepted"]) == (None, "2026-07-02 23:00:00.000000", 48)
    two = fact.pull(_source(spark, later), "b", AS_OF).first()
    assert (two["watermark_before"], two["watermark_after"]) == (one["watermark_after"], "2026-07-03 11:00:00.000000")
    assert two["records_in"] == 60 - 41 + 1                 # from six hours before the watermark on, and the undated row
    full = IncrementalFact(store, "meter_full", ["id"], "ts", 6)
    full.pull(_source(spark, later), "c", AS_OF)
    assert [v[:3] for v in _values_all(fact)] == [v[:3] for v in _values_all(full)]
    assert {v[3] for v in _values_all(fact) if v[0] in (44, 45, 59, 900)} == {"b"}
    # a repeated run reads nothing; an empty one moves nothing
    assert fact.pull(_source(spark, later), "b", AS_OF).first()["_batch_seq"] == two["_batch_seq"]
    none = fact.pull(_source(spark, []), "d", AS_OF).first()
    assert none["watermark_after"] == two["watermark_after"] and none["records_in"] == 0
    before = _values_all(fact)
    fact.compact()
    assert _values_all(fact) == before                      # rows without a date are folded too


def _values_all(fact):
    return sorted(((r["id"], r["ts"], r["v"], r["pipeline_run_id"]) for r in fact.current().collect()), key=lambda r: r[0])


def test_rows_beyond_the_overlap_wait_for_a_full_pull(spark, tmp_path):
    fact = IncrementalFact(Store(spark, str(tmp_path / "s")), "meter", ["id"], "ts", 6)
    day = [(i, T0 + dt.timedelta(hours=i), 1.0) for i in range(24)]
    fact.pull(_source(spark, [r for r in day if r[0] != 3]), "a", AS_OF)
    fact.pull(_source(spark, day), "b", AS_OF)
    assert 3 not in {v[0] for v in _values_all(fact)}
    fact.pull(_source(spark, day), "c", AS_OF, full=True)
    assert {v[0] for v in _values_all(fact)} == set(range(24))


def test_a_pull_that_dies_moves_no_watermark(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"))
    fact = IncrementalFact(store, "meter", ["id"], "ts", 6)
    day = [(i, T0 + dt.timedelta(hours=i), 1.0) for i in range(24)]
    fact.pull(_source(spark, day[:12]), "a", AS_OF)
    mark = fact.watermark()
    plain = Store.record_run

    def dies(self, **values):
        raise RuntimeError("lost")

    monkeypatch.setattr(Store, "record_run", dies)          # the rows are written, the commit is not
    with pytest.raises(RuntimeError):
        fact.pull(_source(spark, [(i, t, 9.0) for i, t, _ in day]), "b", AS_OF)
    monkeypatch.setattr(Store, "record_run", plain)
    assert fact.watermark() == mark and len(_values_all(fact)) == 12
    with pytest.raises(Exception):                          # a source that fails is recorded, and moves nothing
        fact.pull(_source(spark, day).withColumn("v", F.expr("CAST(raise_error('broken') AS DOUBLE)")), "b", AS_OF)
    assert fact.watermark() == mark
    run = fact.pull(_source(spark, day), "b", AS_OF).first()
    assert run["_batch_seq"] == 2 and run["_attempt"] == 2 and run["watermark_before"] == mark
    assert [(v[0], v[2]) for v in _values_all(fact)] == [(i, 1.0) for i in range(24)]


def test_the_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "src")
    _source(spark, [(i, T0 + dt.timedelta(hours=i), 1.0) for i in range(48)]).write.parquet(path)
    from gridledger.operators.reconcile import incremental_window
    rows = incremental_window(spark.read.parquet(path), "ts", F.lit("2026-07-02 12:00:00.000000").cast("timestamp"), 6, keep_undated=True)
    assert "PushedFilters: [Or(IsNull(ts),GreaterThanOrEqual(ts,2026-07-02" in rows._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- named reads

def test_named_reads_answer_with_an_envelope(spark, full_store):
    records, envelope = read(full_store, "spp_load_conditions", "2026-07-14", "2026-07-15", AS_OF, series="SPP", cap=30)
    rows, env = records.collect(), envelope.first()
    assert len(rows) == 30 and env["record_count"] == 30 and env["truncated"] and env["matched_rows"] == 44
    assert [r["interval_start_utc"] for r in rows] == sorted(r["interval_start_utc"] for r in rows) and {r["baa"] for r in rows} == {"SPP"}
    assert env["source"] == "load_forecast_actual" and env["quality_status"] == "quarantine_excluded"
    records, envelope = read(full_store, "household_solar_forecast", "2026-07-16", "2026-07-20", AS_OF)
    assert [r["forecast_kwh"] for r in records.collect()] == [8.0] and envelope.first()["request_status"] == "ok"
    records, _ = read(full_store, "household_forecast_accuracy", "2026-07-01", "2026-07-20", AS_OF)
    assert records.count() == 1
    records, _ = read(full_store, "spp_load_forecast_accuracy", "2026-07-14", "2026-07-15", AS_OF, series="SWPW")
    assert records.count() == 2
    for start, end, series, why in (("2026/07/01", "2026-07-02", "SPP", "invalid_date_format"), ("2026-07-03", "2026-07-02", "SPP", "invalid_date_range"),
                                    ("2024-01-01", "2026-07-02", "SPP", "date_range_too_large"), ("2026-07-01", "2026-07-02", "X", "unknown_key")):
        records, envelope = read(full_store, "spp_load_conditions", start, end, AS_OF, series=series)
        assert records.count() == 0 and envelope.first()["request_status"] == why
    with pytest.raises(ValueError):
        read(full_store, "DROP TABLE", "2026-07-01", "2026-07-02", AS_OF)
    assert {r["source"] for r in read_health(full_store).collect()} == {"spp_load", "household_solar", "household_solar_forecast"}
    assert read_quality(full_store).count() == 1


def test_named_reads_take_frames_of_requests_and_empty_stores(spark, full_store, tmp_path):
    asked = spark.createDataFrame([(f"{d}", f"2026-07-{d}", f"2026-07-{d}", s) for d in (14, 15) for s in ("SPP", "SWPW")],
                                  "rid string, start_text string, end_text string, series string").withColumn("rid", F.concat("rid", "series"))
    records, envelopes = answer(full_store, "spp_load_conditions", asked, AS_OF)
    per = {r["rid"]: r["count"] for r in records.groupBy("rid").count().collect()}
    assert per == {r["rid"]: r["record_count"] for r in envelopes.collect()} == {"14SPP": 20, "14SWPW": 20, "15SPP": 24, "15SWPW": 24}
    empty = Store(spark, str(tmp_path / "nothing"))
    for name in ("household_solar_history", "spp_load_conditions", "household_forecast_accuracy"):
        records, envelope = read(empty, name, "2026-07-01", "2026-07-02", AS_OF, series="SPP")
        assert records.count() == 0 and envelope.first()["record_count"] == 0 and envelope.first()["request_status"] == "ok"
    assert read_quality(empty) is None
