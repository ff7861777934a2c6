import math

from pyspark.sql import functions as F

from gridledger.functions import rules as R
from gridledger.operators import contracts
from gridledger.plans.datasets import DAILY, FORECAST, LOAD, WEATHER


def _load_rows(spark, data):
    df = spark.createDataFrame(data, "Interval string, GMTIntervalEnd string, MTLF string, `Averaged Actual` string, BAA string")
    return LOAD.prepare(df)


GOOD = ("07/14/2026 00:00:00", "07/14/2026 05:00:00", "40152", "40145", "SPP")


def test_valid_rows_all_accepted(spark):
    acc, rej = contracts.split(_load_rows(spark, [GOOD, GOOD[:3] + (None, "SWPW")]), LOAD.contract)
    assert acc.count() == 2 and rej.count() == 0


def test_each_mutation_rejects_exactly_one_row(spark):
    cases = {
        "BAA:isin(SPP,SWPW)": GOOD[:4] + ("XYZ",),
        "load_forecast_mw:ge(0)": GOOD[:2] + ("-100",) + GOOD[3:],
        "load_forecast_mw:coerce(double)": GOOD[:2] + ("not-a-number",) + GOOD[3:],
        "GMTIntervalEnd:ts_unparseable": (GOOD[0], "2026-07-14 05:00") + GOOD[2:],
    }
    for reason, bad in cases.items():
        acc, rej = contracts.split(_load_rows(spark, [GOOD, GOOD, bad]), LOAD.contract)
        assert acc.count() == 2
        got = [r["rejection_reason"] for r in rej.collect()]
        assert got == [reason], (reason, got)


def test_reasons_join_all_failures_and_nulls_pass_range_checks(spark):
    bad = (None, "07/14/2026 05:00:00", "-1", "-5", "XYZ")
    rej = contracts.rejected(contracts.flag(_load_rows(spark, [bad]), LOAD.contract))
    assert rej.first()["rejection_reason"] == (
        "Interval:not_null; load_forecast_mw:ge(0); load_actual_mw:ge(0); BAA:isin(SPP,SWPW)")


def test_boundaries_inclusive_and_nan_is_null(spark):
    data = [("2026-01-01", "S", "t", v, t) for v, t in
            [("0", "-90"), ("100", "60"), ("100.0001", "0"), ("-0.1", "0"), ("50", "60.5"),
             ("50", "-90.5"), ("NaN", "NaN"), (None, None)]]
    df = spark.createDataFrame(data, "date string, station string, timestamp_local string, sky_cover_pct string, temperature_c string")
    df = df.withColumn("source_file", F.lit("f.json"))
    flagged = contracts.flag(WEATHER.prepare(df), WEATHER.contract)
    got = [(r["sky_cover_pct"], r["temperature_c"], r["rejection_reason"]) for r in flagged.collect()]
    assert got[0][2] is None and got[1][2] is None
    assert got[2][2] == "sky_cover_pct_n:in_range(0,100)"
    assert got[3][2] == "sky_cover_pct_n:in_range(0,100)"
    assert got[4][2] == "temperature_c_n:in_range(-90,60)"
    assert got[5][2] == "temperature_c_n:in_range(-90,60)"
    # NaN text is numeric (no coercion failure) and is treated as missing, not as out of range
    assert got[6][2] is None and got[7][2] is None
    nan_row = flagged.filter(F.col("sky_cover_pct") == "NaN").first()
    assert nan_row["sky_cover_pct_n"] is None


def test_split_is_a_partition_of_the_input(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 17 - 3).cast("double").alias("v"))
    c = contracts.Contract("t", ("v",), (R.ge("v", 0), R.le("v", 10)))
    acc, rej = contracts.split(df, c)
    assert acc.count() + rej.count() == 1000
    assert acc.join(rej, "id").count() == 0


def test_column_set_reason(spark):
    df = spark.createDataFrame([(["Interval", "GMTIntervalEnd", "MTLF", "Averaged Actual", "BAA"],),
                                (["Interval", "GMTIntervalEnd", "MTLF", "BAA"],),
                                (["Interval", "GMTIntervalEnd", "MTLF", "Averaged Actual", "BAA", "X"],)],
                               "header array<string>")
    got = [r[0] for r in df.select(contracts.column_set_reason(F.col("header"), LOAD.contract)).collect()]
    assert got == [None, "missing columns: Averaged Actual", "unexpected columns: X"]


def test_try_number_never_raises_under_ansi(spark):
    df = spark.createDataFrame([("1e3",), ("abc",), ("",), ("NaN",), (None,)], "s string")
    got = [r[0] for r in df.select(R.try_number("s")).collect()]
    assert got[0] == 1000.0 and got[1] is None and got[2] is None and got[3] is None and got[4] is None
    assert not any(isinstance(x, float) and math.isnan(x) for x in got)


def test_csv_from_content_maps_columns_by_header_position(spark, tmp_path):
    from gridledger.sources import files
    a = tmp_path / "a.csv"
    a.write_bytes("﻿Interval,GMTIntervalEnd,MTLF,Averaged Actual,BAA\n"
                  "07/14/2026 00:00:00,07/14/2026 05:00:00,1,2,SPP\n\n"
                  "07/14/2026 01:00:00,07/14/2026 06:00:00,NA,,SWPW\n".encode())
    b = tmp_path / "b.csv"      # same columns, other order, quoted header names, CRLF
    b.write_bytes(b'"BAA","MTLF","Interval","GMTIntervalEnd","Averaged Actual"\r\nSPP,7,i,e,8\r\n')
    c = tmp_path / "c.csv"      # missing a required column: whole file fails
    c.write_bytes(b"Interval,GMTIntervalEnd,MTLF,BAA\nx,y,1,SPP\n")
    raw = files.read_raw(spark, [str(a), str(b), str(c)])
    rows, status = files.csv_from_content(raw, LOAD.contract)
    got = sorted((r["source_file"], r["line_order"], r["MTLF"], r["Averaged Actual"], r["BAA"]) for r in rows.collect())
    assert got == [("a.csv", 2, "1", "2", "SPP"), ("a.csv", 4, None, None, "SWPW"), ("b.csv", 2, "7", "8", "SPP")]
    errs = {r["source_path"].rsplit("/", 1)[1]: r["header_error"] for r in status.collect()}
    assert errs == {"a.csv": None, "b.csv": None, "c.csv": "missing columns: Averaged Actual"}


def test_numbers_of_json_documents_have_no_missing_value_words(spark):
    values = ["1.5", None, "NaN", " nan", "-nan", "N/A", "", "null", "-1", "Infinity"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v string")
    daily = df.select(F.lit("2026-01-01").alias("date"), F.lit("S").alias("system"), F.col("v").alias("solar_production_kwh"), F.lit("t").alias("ingested_at"),
                      F.col("v").alias("completeness_pct"), F.lit("complete").alias("data_status"), F.col("id").alias("source_file"))
    got = {r["source_file"]: r["rejection_reason"] for r in contracts.flag(DAILY.prepare(daily), DAILY.contract).collect()}
    missing, word = "solar_production_kwh:not_null", "solar_production_kwh_n:coerce(double); completeness_pct_n:coerce(double)"
    assert [got[str(i)] for i in range(len(values))] == [
        None, missing, missing, missing, missing, word, word, word,
        "solar_production_kwh_n:ge(0); completeness_pct_n:in_range(0,100)", "completeness_pct_n:in_range(0,100)"]
    projected = df.select(F.lit("2026-01-01").alias("date"), F.lit("2026-01-01T00:00:00+00:00").alias("generated_at_utc"),
                          F.col("v").alias("projected_kwh"), F.col("id").alias("source_file"))
    accepted = contracts.accepted(contracts.flag(FORECAST.prepare(projected), FORECAST.contract))
    assert sorted(r["source_file"] for r in accepted.collect()) == ["0", "9"]
