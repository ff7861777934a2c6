"""Cases that an earlier review found wrong."""

import pytest
from pyspark.sql import functions as F

from gridledger.operators import reads
from gridledger.operators.upsert import write_batch
from gridledger.plans.datasets import LOAD
from gridledger.plans.ingest import Store, ingest, rebuild
from gridledger.sources import files
from gridledger.streaming.file_stream import upsert_batches
from tests.test_ingest import AS_OF, _load_rows, _write_csv


def test_snapshot_filter_takes_whole_iso_dates_only(spark):
    df = spark.createDataFrame([(1, "2026"), (2, "2026-01"), (3, "2026-1-3"), (4, "2026-01-03T00:00"), (5, None)], "id int, t string")
    got = reads.snapshot_filter(df, "t", "2025-01-01", "2027-01-01", "id").collect()
    assert [r.id for r in got] == [4]


def test_retry_with_fewer_partitions_replaces_the_batch(spark, tmp_path):
    path = str(tmp_path / "log")
    write_batch(spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string"), path, 1, ["day"])
    write_batch(spark.createDataFrame([(3, "a")], "v int, day string"), path, 1, ["day"])
    assert sorted((r.v, r.day) for r in spark.read.parquet(path).collect()) == [(3, "a")]


def test_partly_corrupt_snapshot_is_corrupt(spark, tmp_path):
    p = tmp_path / "snap.json"
    p.write_text('{"v": 1}\n{not json\n{"v": 2}')
    rows, status = files.read_snapshot(spark, str(p), spark.createDataFrame([], "v long").schema)
    assert (status, rows.count()) == ("export_corrupt", 0)


def test_required_column_far_right_is_read(spark, tmp_path):
    p, junk = tmp_path / "wide.csv", tmp_path / "junk.csv"
    head, row = [f"x{i}" for i in range(60)] + list(LOAD.contract.columns), ["0"] * 60 + [f"v{i}" for i in range(len(LOAD.contract.columns))]
    p.write_text(",".join(head) + "\n" + ",".join(row) + "\n")
    junk.write_text("," * 30000)
    contract = type(LOAD.contract)(**{**vars(LOAD.contract), "strict": False})
    rows, status = files.csv_from_content(files.read_raw(spark, [str(p), str(junk)]), contract)
    assert [r[LOAD.contract.columns[-1]] for r in rows.collect()] == [row[-1]]
    assert {r.source_path.rsplit("/", 1)[1]: r.header_error for r in status.collect()} == {
        "wide.csv": None, "junk.csv": "header of more than 20480 fields"}


def test_rebuild_reads_landed_files_of_any_size(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "store"))
    ingest(store, LOAD, [_write_csv(tmp_path / "a.csv", _load_rows(4, 4))], "r1", 1, AS_OF)
    monkeypatch.setattr(files.read_raw, "__defaults__", (10,))
    assert rebuild(store, LOAD, "r2", AS_OF).count() == 8


def test_micro_batch_keeps_its_rows_beside_batch_runs(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(Exception):
        ingest(store, LOAD, [str(tmp_path / "none.csv")], "r0", 0, AS_OF)          # a failed run that used number 0
    ingest(store, LOAD, [_write_csv(tmp_path / "a.csv", _load_rows(4, 4))], "r1", 1, AS_OF)
    batch = store.facts(LOAD).log().limit(3).drop("_batch_seq", "_row_seq").withColumn("baa", F.concat("baa", F.lit("-s"))).checkpoint()
    fn = upsert_batches(store, LOAD.name, LOAD.keys, LOAD.date_col, lambda b: b, LOAD.keys, AS_OF)
    for batch_id in (0, 1, 1):
        fn(batch, batch_id)
    assert store.current_facts(LOAD).count() == 8 + 3
    runs = store.runs().where(F.col("run_id").contains("-stream-")).collect()
    assert sorted(r._batch_seq for r in runs) == [2, 3]
    with pytest.raises(ValueError):
        ingest(store, LOAD, [str(tmp_path / "a.csv")], "r2", 2, AS_OF)
    assert store.current_facts(LOAD).count() == 8 + 3
