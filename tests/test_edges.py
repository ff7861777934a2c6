"""Empty inputs, NULL keys and boundaries across operators."""

import datetime as dt
import math
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridledger.functions.exact import exact_mean, exact_sum
from gridledger.operators import accuracy, landing, quality, reads, reconcile, upsert
from gridledger.operators.keyed import latest_per_key


def test_empty_inputs_give_empty_results(spark):
    ev = spark.createDataFrame([], "k string, ts timestamp, f double, a double, seq long")
    assert quality.detect_gaps(ev, ["k"], "ts").count() == 0
    assert accuracy.interval_accuracy(ev, ["k"], "ts", "f", "a", digits=4).count() == 0
    assert latest_per_key(ev, ["k"], ["seq"]).count() == 0
    assert upsert.upsert(ev, ev, ["k", "ts"], order_cols=["seq"]).count() == 0
    m = spark.createDataFrame([], "landed_seq long, name string, content_sha string")
    assert landing.classify_immutable(m).count() == 0
    one = quality.completeness_result(quality.detect_gaps(ev, ["k"], "ts"), "r", "2026-01-01").first()
    assert (one["status"], one["detail"]) == ("pass", "no gaps detected")


def test_upsert_into_empty_current_and_with_empty_batch(spark):
    cur = spark.createDataFrame([("a", 1.0, 1)], "k string, v double, seq long")
    empty = spark.createDataFrame([], cur.schema)
    assert sorted(map(tuple, upsert.upsert(empty, cur, ["k"]).collect())) == [("a", 1.0, 1)]
    assert sorted(map(tuple, upsert.upsert(cur, empty, ["k"]).collect())) == [("a", 1.0, 1)]


def test_null_series_key_is_its_own_series(spark):
    t0 = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(None, t0), (None, t0 + dt.timedelta(hours=3)), ("a", t0),
                                ("a", t0 + dt.timedelta(hours=1))], "k string, ts timestamp")
    got = quality.detect_gaps(df, ["k"], "ts").collect()
    assert len(got) == 1 and got[0]["k"] is None and got[0]["gap_seconds"] == 3 * 3600


def test_exact_mean_handles_nulls_and_negative_values(spark):
    df = spark.createDataFrame([("x", -0.7), ("x", 0.3), ("x", None), ("y", None)], "g string, v double")
    got = {r["g"]: r["m"] for r in df.groupBy("g").agg(exact_mean("v", 4).alias("m")).collect()}
    assert got["x"] == -0.2 and got["y"] is None


@pytest.mark.parametrize("values, digits, mean", [
    ([1e11] * 3, 9, 1e11),
    ([1e11, -1e11, 3.0], 9, 1.0),
    ([9e18, 9e18, -9e18, -9e18, 4.0], 9, 0.8),
    ([1.0 / 1e-12, 1.0], 9, 500000000000.5),            # the ratio to a tiny actual
    ([float("nan"), 1.0], 4, float("nan")),
    ([float("inf"), 1e300], 4, float("inf")),
    ([float("-inf"), None], 4, float("-inf")),
    ([float("inf"), float("-inf")], 4, float("nan")),
    ([5e-324, -5e-324], 4, 0.0),
])
def test_exact_mean_over_the_double_range(spark, values, digits, mean):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = df.agg(exact_mean("v", digits).alias("m")).first()["m"]
    assert got == mean or (math.isnan(got) and math.isnan(mean))


def test_exact_sum_states_what_it_cannot_hold(spark):
    df = spark.createDataFrame([("a", 1e300), ("a", -1e300), ("b", 2.5)], "k string, v double")
    with pytest.raises(Exception, match="exact sum: beyond 2\\^93 units"):
        df.groupBy("k").agg(exact_sum("v", 4).alias("s")).collect()
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(exact_sum("v", 4, overflow="null").alias("s")).collect()}
    assert got == {"a": None, "b": 2.5}


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e17, 1e17), min_size=1, max_size=30))
def test_exact_mean_is_near_the_true_mean(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    a, b = (d.agg(exact_mean("v", 9).alias("m")).first()["m"] for d in (df.repartition(1), df.repartition(5)))
    true = sum(map(Fraction, values)) / len(values)
    size = max(abs(v) for v in values)
    assert a == b and abs(Fraction(a) - true) <= Fraction(1, 10 ** 9) + Fraction(size) / 2 ** 50


def test_guard_accepts_exactly_366_days_and_same_day(spark):
    req = spark.createDataFrame([("2024-01-01", "2024-12-31"), ("2024-01-01", "2025-01-01"),
                                 ("2024-01-01", "2025-01-02"), ("2024-02-29", "2024-02-29")], "s string, e string")
    got = [r["request_status"] for r in reads.guard_requests(req, "s", "e").collect()]
    assert got == ["ok", "ok", "date_range_too_large", "ok"]


def test_reconcile_statuses_and_tolerance_boundary(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("d", None)], "k string, v double")
    right = spark.createDataFrame([("a", 1.5), ("b", 9.0), ("e", 1.0), ("d", None)], "k string, v double")
    got = {r["k"]: r["reconcile_status"] for r in reconcile.reconcile(left, right, ["k"], "v", 0.5).collect()}
    assert got == {"a": "match", "b": "mismatch", "c": "only_left", "e": "only_right", "d": "match"}


def test_incremental_window_with_column_watermark(spark):
    t0 = dt.datetime(2026, 1, 2, 12)
    df = spark.createDataFrame([(t0 - dt.timedelta(hours=h),) for h in range(10)], "ts timestamp")
    wm = df.agg(F.max("ts")).scalar()
    assert reconcile.incremental_window(df, "ts", wm, 6).count() == 7
    assert reconcile.incremental_window(df, "ts", "2026-01-02 10:00:00", 1).count() == 4


def test_no_machine_local_checkpoint_folder_on_a_cluster():
    import pytest
    from gridledger.session import shared_dir

    class _Conf:
        def get(self, key, default=None):
            return default

    class _SC:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Conf()

    class _RuntimeConf:
        def get(self, key):
            raise KeyError(key)

    class _Spark:
        sparkContext = _SC()
        conf = _RuntimeConf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Spark())
