from pyspark.sql import functions as F

from gridledger.operators import landing, upsert
from gridledger.operators.keyed import latest_per_key

from .conftest import rows


def _facts(spark, data):
    return spark.createDataFrame(data, "baa string, ts string, fc double, act double, seq long")


def test_upsert_replaces_inserts_and_null_overwrites(spark):
    cur = _facts(spark, [("SPP", "h1", 1.0, 1.5, 1), ("SPP", "h2", 2.0, 2.5, 2)])
    inc = _facts(spark, [("SPP", "h2", 3.0, None, 3), ("SPP", "h3", 4.0, None, 4)])
    out = upsert.upsert(cur, inc, ["baa", "ts"])
    assert rows(out, "ts", "fc", "act") == [("h1", 1.0, 1.5), ("h2", 3.0, None), ("h3", 4.0, None)]
    kept = upsert.upsert(cur, inc, ["baa", "ts"], keep_known=["act"])
    assert rows(kept, "ts", "act") == [("h1", 1.5), ("h2", 2.5), ("h3", None)]


def test_upsert_is_idempotent_and_dedups_batch_keep_last(spark):
    cur = _facts(spark, [("SPP", "h1", 1.0, 1.0, 1)])
    inc = _facts(spark, [("SPP", "h2", 5.0, 5.0, 2), ("SPP", "h2", 6.0, 6.0, 3)])
    once = upsert.upsert(cur, inc, ["baa", "ts"], order_cols=["seq"])
    twice = upsert.upsert(once, inc, ["baa", "ts"], order_cols=["seq"])
    assert rows(once) == rows(twice)
    assert rows(once, "ts", "fc") == [("h1", 1.0), ("h2", 6.0)]


def test_history_keeps_every_capture(spark):
    cur = spark.createDataFrame([("01-04", "c1", 14.8)], "d string, cap string, v double")
    inc = spark.createDataFrame([("01-04", "c2", 14.9), ("01-04", "c1", 14.8)], "d string, cap string, v double")
    assert upsert.append_history(cur, inc, ["d", "cap"]).count() == 2


def test_latest_per_key_is_order_independent(spark):
    df = spark.range(5000).select((F.col("id") % 37).alias("k"), F.col("id").alias("seq"),
                                  (F.col("id") * 3).alias("v"))
    a = rows(latest_per_key(df, ["k"], ["seq"]))
    b = rows(latest_per_key(df.repartition(13).orderBy(F.rand(3)), ["k"], ["seq"]))
    assert a == b and len(a) == 37 and all(r[1] >= 5000 - 37 for r in a)


def test_change_log_commit_marker_and_compact(spark, tmp_path):
    root = str(tmp_path / "facts")
    log = upsert.ChangeLog(spark, root, ["baa", "ts"], "event_date")
    schema = "baa string, ts string, v double, event_date string"
    b1 = spark.createDataFrame([("SPP", "h1", 1.0, "2026-07-14"), ("SPP", "h2", 2.0, "2026-07-15")], schema)
    b2 = spark.createDataFrame([("SPP", "h2", 9.0, "2026-07-15")], schema)
    log.append(b1, 1)
    log.append(b2, 2)
    committed_1 = spark.createDataFrame([(1,)], "_batch_seq long")
    assert rows(log.current(committed_1), "ts", "v") == [("h1", 1.0), ("h2", 2.0)]   # batch 2 uncommitted
    committed = spark.createDataFrame([(1,), (2,)], "_batch_seq long")
    assert rows(log.current(committed), "ts", "v") == [("h1", 1.0), ("h2", 9.0)]
    assert log.compact(committed) == 2
    assert rows(log.base(), "ts", "v") == [("h1", 1.0), ("h2", 9.0)]
    # a newer batch touching one date: reads merge base + delta; compaction rewrites only that date
    log.append(spark.createDataFrame([("SPP", "h1", 5.0, "2026-07-14"), ("SPP", "h3", 7.0, "2026-07-14")],
                                     schema), 3)
    assert rows(log.current(), "ts", "v") == [("h1", 5.0), ("h2", 9.0), ("h3", 7.0)]
    assert log.compact() == 3
    assert rows(log.base(), "ts", "v") == [("h1", 5.0), ("h2", 9.0), ("h3", 7.0)]
    assert rows(log.current(), "ts", "v") == [("h1", 5.0), ("h2", 9.0), ("h3", 7.0)]
    # an older batch number arriving late cannot beat what it precedes
    log.append(spark.createDataFrame([("SPP", "h4", 1.0, "2026-07-15")], schema), 4)
    assert rows(log.current(), "ts", "v") == [("h1", 5.0), ("h2", 9.0), ("h3", 7.0), ("h4", 1.0)]


def _manifest(spark, data):
    return spark.createDataFrame(data, "landed_seq long, name string, content_sha string")


def test_immutable_landing(spark):
    m = _manifest(spark, [(1, "a.csv", "aaa111222333444"), (2, "a.csv", "aaa111222333444"),
                          (3, "a.csv", "bbb111222333444"), (4, "b.csv", "ccc")])
    got = {r["landed_seq"]: (r["landing_status"], r["landing_error"]) for r in landing.classify_immutable(m).collect()}
    assert got[1] == ("landed", None) and got[2] == ("duplicate", None) and got[4] == ("landed", None)
    assert got[3][0] == "collision"
    assert "aaa111222333" in got[3][1] and "bbb111222333" in got[3][1] and "immutable" in got[3][1]


def test_versioned_landing_a_b_a(spark):
    sha_a, sha_b = "a" * 64, "b" * 64
    m = spark.createDataFrame([(1, "2026-07-15", sha_a), (2, "2026-07-15", sha_b), (3, "2026-07-15", sha_a)],
                              "landed_seq long, stem string, content_sha string")
    per_file = {r["landed_seq"]: (r["version_name"], r["landing_status"]) for r in landing.classify_versioned(m).collect()}
    assert per_file == {1: ("2026-07-15.json", "landed"), 2: ("2026-07-15__bbbbbbbbbbbb.json", "landed"),
                        3: ("2026-07-15.json", "reused")}
    latest = landing.latest_versions(landing.version_names(m)).first()
    assert (latest["base_name"], latest["latest_name"], latest["versions"]) == ("2026-07-15", "2026-07-15.json", 2)


def test_capture_name(spark):
    from gridledger.functions.hashing import capture_name
    df = spark.createDataFrame([("2026-01-01T15:00:00.000000+00:00",), (None,)], "g string")
    got = [r[0] for r in df.select(capture_name("g")).collect()]
    assert got == ["2026-01-01T150000000000+0000", "unknown"]

