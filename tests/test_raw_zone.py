"""Files of any size and shape: chunks and hashes, the raw zone, rebuilds, per-file failures, streams of files."""

import csv
import dataclasses
import datetime as dt
import hashlib
import io
import json

import pytest
from pyspark.sql import functions as F

from gridledger.operators import contracts
from gridledger.plans import ingest as ingest_module
from gridledger.plans.datasets import DAILY, LOAD, WEATHER
from gridledger.plans.ingest import Store, ingest, rebuild
from gridledger.sources import files, raw_zone
from gridledger.streaming.file_stream import start_stream

from .test_ingest import AS_OF, DAILY_DOCS, _daily_doc, _json, _load_rows, _weather_doc, _write_csv

HEADER = list(LOAD.contract.columns)


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def _facts(store, dataset=LOAD):
    return sorted(map(str, store.current_facts(dataset).drop("ingested_at", "pipeline_run_id", "source_file").collect()))


def test_fields_of_a_line_equal_the_csv_module(spark):
    lines = ['a,b,c', '', ',', 'a,"b,c",d', '"a""b",,x', '""', '"",""', '""""', '5" pipe,3', 'x,"",y', '"a,b,""c"",d",e', 'ab"c"d,e',
             '"1","2","3"', ',,,"x"', '"tail', "é,日本,\x01\x02", '"a" b,c']
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {r.i: r.f for r in frame.select("i", files.csv_fields(F.col("line")).alias("f")).collect()}
    for i, line in enumerate(lines):
        want = next(csv.reader(io.StringIO(line)), [""]) if line else [""]
        if line == '"a" b,c':
            continue                      # text after a closing quote: readers differ
        assert got[i] == want, line


def test_fields_written_by_spark_are_read_back(spark, tmp_path):
    rows = [(1, '{"k": 1, "v": "a\\"b"}'), (2, "back\\slash"), (3, 'q",\x02d'), (4, "plain"), (5, 'x\\\\"'), (6, ',')]
    spark.createDataFrame(rows, "i int, t string").coalesce(1).write.option("header", True).csv(str(tmp_path / "c"))
    scanned, _, _ = files.scan_checked_csv(spark, [str(tmp_path / "c")], contracts.Contract("c", ("i", "t"), ()), escape="\\")
    assert sorted((int(r.i), r.t) for r in scanned.collect()) == rows


def _tree_hash(data: bytes, size: int) -> tuple[str, int]:
    """The hash by its definition: chunks of the lines that start in each stretch of ``size`` bytes."""
    if len(data) <= size:
        return hashlib.sha256(data).hexdigest(), 1
    mark = 3 if data.startswith(b"\xef\xbb\xbf") else 0
    chunks, at = {}, 0
    for line in data[mark:].splitlines(keepends=True) if b"\r" not in data else [x + b"\n" for x in data[mark:].split(b"\n")]:
        chunks[at // size] = chunks.get(at // size, b"") + line
        at += len(line)
    parts = [chunks[k] for k in sorted(chunks)]
    parts[0] = data[:mark] + parts[0]
    if b"\r" in data:
        parts[-1] = parts[-1][:-1]
        parts = [p for p in parts if p]
    shas = [hashlib.sha256(p).hexdigest() for p in parts]
    return (shas[0] if len(shas) == 1 else hashlib.sha256("".join(shas).encode()).hexdigest()), len(shas)


def test_chunks_give_back_every_byte(spark, tmp_path):
    bodies = {"plain +a%20b.csv": b"".join(b"line %d,%s\n" % (i, b"x" * (i % 37)) for i in range(400)),
              "no end.csv": b"\n".join(b"l%d" % i for i in range(300)), "mark.csv": b"\xef\xbb\xbfh1,h2\n" + b"1,2\n" * 100,
              "mark no end.csv": b"\xef\xbb\xbfh1,h2\n" + b"1,2\n" * 100 + b"3,4", "blank ends.csv": b"a\n" * 60 + b"\n\n\n",
              "one line.csv": b"z" * 5000, "tiny.csv": b"h\n1\n", "crlf.csv": b"h,i\r\n" + b"1,2\r\n" * 90}
    paths = []
    for name, body in bodies.items():
        (tmp_path / name).write_bytes(body)
        paths.append(str(tmp_path / name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        listed = raw_zone.list_files(spark, paths)
        assert {r.source_file: r.length for r in listed.collect()} == {k: len(v) for k, v in bodies.items()}
        chunks = raw_zone.read_chunks(spark, listed, chunk_bytes=100).persist()
        by_file = {}
        for r in chunks.collect():
            by_file.setdefault(r.source_path.rsplit("/", 1)[1], []).append((r.chunk_no, bytes(r.bytes)))
        assert {k: b"".join(b for _, b in sorted(v)) for k, v in by_file.items()} == bodies
        for r in raw_zone.fingerprints(chunks).collect():
            name = r.source_path.rsplit("/", 1)[1]
            assert r.n_bytes == len(bodies[name]) and r.valid_text
            if name != "blank ends.csv":
                assert (r.content_sha, r.n_chunks) == _tree_hash(bodies[name], 100), name
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_file_above_64_mib_loads_with_line_order(spark, store, tmp_path):
    rows = _load_rows(24, 24)
    first, last = rows[0][:2] + ("111",) + rows[0][3:], rows[0][:2] + ("222",) + rows[0][3:]
    path = tmp_path / "big.csv"
    with open(path, "w") as out:
        out.write(",".join(HEADER) + "\n" + ",".join(first) + "\n")
        for i in range(70):                           # blank lines of a MiB between the rows
            out.write(" " * (1 << 20) + "\n")
            if i < len(rows) - 1:
                out.write(",".join(rows[i + 1]) + "\n")
        out.write(",".join(last) + "\n")
    assert path.stat().st_size > 64 << 20
    run = ingest(store, LOAD, [str(path)], "r1", 1, AS_OF).run.first()
    assert (run["status"], run["records_in"], run["records_accepted"], run["records_deduplicated"]) == ("success", 49, 48, 1)
    key_end = dt.datetime.strptime(rows[0][1], "%m/%d/%Y %H:%M:%S")
    facts = store.current_facts(LOAD)
    assert facts.filter((F.col("baa") == rows[0][4]) & (F.col("interval_end_utc") == key_end)).first()["load_forecast_mw"] == 222.0
    zone = store.read("raw", LOAD.name)
    assert zone.count() >= 9 and zone.agg(F.sum(F.octet_length("bytes"))).first()[0] == path.stat().st_size
    # the splittable scan of the same file agrees
    scanned, status, _ = files.scan_checked_csv(spark, [str(path)], LOAD.contract)
    assert scanned.count() == 49 and status.first()["header_error"] is None
    newest = scanned.filter(F.col("GMTIntervalEnd") == rows[0][1]).filter(F.col("BAA") == rows[0][4]).orderBy(F.col("line_order").desc())
    assert newest.first()["MTLF"] == "222"


def test_required_column_beyond_field_40_in_both_paths(spark, store, tmp_path):
    rows = _load_rows(4, 4)
    wide = dataclasses.replace(LOAD, contract=dataclasses.replace(LOAD.contract, strict=False))
    junk = [f"x{i}" for i in range(60)]
    a = _write_csv(tmp_path / "a.csv", [("0",) * 60 + r for r in rows], header=",".join(junk + HEADER))
    order = [4, 2, 0, 3, 1]
    b = _write_csv(tmp_path / "b.csv", [tuple(r[i] for i in order) for r in _load_rows(6, 6)], header=",".join(HEADER[i] for i in order))
    run = ingest(store, wide, [a, b], "r1", 1, AS_OF).run.first()
    assert (run["records_in"], run["records_accepted"], run["records_deduplicated"]) == (20, 12, 8)
    assert store.current_facts(LOAD).count() == 12
    scanned, status, _ = files.scan_checked_csv(spark, [a, b], wide.contract)
    assert status.filter(F.col("header_error").isNotNull()).isEmpty()
    assert sorted(tuple(r[c] or "" for c in HEADER) for r in scanned.collect()) == sorted(rows + _load_rows(6, 6))


def test_rebuild_does_not_need_the_delivered_files(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_zone, "CHUNK_BYTES", 1500)
    monkeypatch.setattr(raw_zone.read_chunks, "__defaults__", (1500,))
    a = _write_csv(tmp_path / "a.csv", _load_rows(48, 48))
    b = _write_csv(tmp_path / "b.csv", _load_rows(4, 4)[::-1])
    (tmp_path / "same.csv").write_bytes((tmp_path / "a.csv").read_bytes())
    ingest(store, LOAD, [a, b], "r1", 1, AS_OF)
    ingest(store, LOAD, [str(tmp_path / "same.csv")], "r2", 2, AS_OF)         # another name, the same bytes: kept once
    assert store.read("raw", LOAD.name).select("content_sha").distinct().count() == 2
    zone = store.read("raw", LOAD.name)
    assert zone.groupBy("content_sha", "chunk_no").count().agg(F.max("count")).first()[0] == 1
    assert zone.agg(F.sum(F.octet_length("bytes"))).first()[0] == sum((tmp_path / f).stat().st_size for f in ("a.csv", "b.csv"))
    want = _facts(store)
    (tmp_path / "a.csv").write_text("changed")
    (tmp_path / "b.csv").unlink()
    again = rebuild(store, LOAD, "rb", AS_OF)
    assert sorted(map(str, again.drop("ingested_at", "pipeline_run_id", "source_file").collect())) == want
    # a chunk whose bytes changed is found before it is used
    part = tmp_path / "store" / "raw" / LOAD.name / "_batch_seq=1" / "_attempt=0"
    kept = spark.read.parquet(str(part))
    broken = kept.withColumn("bytes", F.when(F.col("chunk_no") == 1, F.encode(F.lit("x"), "UTF-8")).otherwise(F.col("bytes"))).collect()
    spark.createDataFrame(broken, kept.schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(str(part))
    with pytest.raises(ValueError, match="bytes changed or missing"):
        rebuild(store, LOAD, "rb2", AS_OF)


def test_two_writers_of_one_number_keep_all_rows(spark, store, tmp_path):
    rows = _load_rows(8, 8)
    a, b = _write_csv(tmp_path / "a.csv", rows[:8]), _write_csv(tmp_path / "b.csv", rows[8:])
    assert store.claim(LOAD.name, "r1", 1) == (1, 0)              # run r1 holds number 1 and is still at work
    two = ingest(store, LOAD, [b], "r2", 1, AS_OF).run.first()
    assert (two["_batch_seq"], two["_attempt"]) == (2, 0)
    one = ingest(store, LOAD, [a], "r1", 1, AS_OF).run.first()
    assert (one["_batch_seq"], one["_attempt"]) == (1, 1)         # r1 again, after its first attempt died: attempt 1
    assert store.current_facts(LOAD).count() == 16
    # a third run that asks for a committed number with other files takes the next free one
    three = ingest(store, LOAD, [_write_csv(tmp_path / "c.csv", [r[:2] + ("7",) + r[3:] for r in rows[:2]])], "r3", 1, AS_OF).run.first()
    assert three["_batch_seq"] == 3 and store.current_facts(LOAD).count() == 16
    # the same files again are a retry: nothing is written
    log = store.facts(LOAD).log().count()
    again = ingest(store, LOAD, [a], "r1b", 1, AS_OF)
    assert again.run.first()["run_id"] == "r1" and store.facts(LOAD).log().count() == log
    assert again.accepted.count() == 8 and store.runs().count() == 3


def test_attempt_that_died_is_never_read(spark, store, tmp_path, monkeypatch):
    a = _write_csv(tmp_path / "a.csv", _load_rows(4, 4))
    whole = Store.record_run
    monkeypatch.setattr(Store, "record_run", lambda self, **v: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        ingest(store, LOAD, [a], "r1", 1, AS_OF)                   # everything was written but the commit
    monkeypatch.setattr(Store, "record_run", whole)
    assert store.facts(LOAD).log().count() == 8 and store.current_facts(LOAD).count() == 0
    run = ingest(store, LOAD, [a], "r1", 1, AS_OF).run.first()
    assert (run["_batch_seq"], run["_attempt"]) == (1, 1)
    assert store.current_facts(LOAD).count() == 8 and store.facts(LOAD).log().count() == 16
    landed = store.visible(LOAD, "manifest", LOAD.name).collect()
    assert [r["landing_status"] for r in landed] == ["landed"]
    assert rebuild(store, LOAD, "rb", AS_OF).count() == 8


def test_batch_that_commits_late_below_a_compaction_is_kept(spark, store):
    log = store.facts(LOAD)
    schema = "baa string, interval_start_utc string, v double, event_date string"

    def batch(n, *rows):
        log.append(spark.createDataFrame([(*r, "2026-07-14") for r in rows], schema), n)

    def now(*numbers):
        return spark.createDataFrame([(n, 0) for n in numbers], "_batch_seq long, _attempt long")

    def read(committed):
        return sorted((r.baa, r.interval_start_utc, r.v) for r in log.current(committed).collect())

    batch(1, ("a", "h1", 1.0))
    batch(2, ("b", "h1", 2.0), ("a", "h1", 2.0))
    batch(3, ("c", "h1", 3.0), ("a", "h1", 3.0))
    assert log.compact(now(1, 3)) == 3
    # 2 commits after 1 and 3 were folded: its key appears, and it does not win over 3
    want = [("a", "h1", 3.0), ("b", "h1", 2.0), ("c", "h1", 3.0)]
    assert read(now(1, 2, 3)) == want
    assert log.compact(now(1, 2, 3)) == 3 and read(now(1, 2, 3)) == want
    assert sorted((r[0], r[1]) for r in log.folded().collect()) == [(1, 0), (2, 0), (3, 0)]
    # a compaction that died holds its number until another takes over
    batch(4, ("d", "h1", 4.0))
    from gridledger.operators.commits import create_if_absent
    assert create_if_absent(spark, f"{log.root}/folds/2", "")
    with pytest.raises(RuntimeError, match="under way"):
        log.compact(now(1, 2, 3, 4))
    assert log.compact(now(1, 2, 3, 4), take_over=True) == 4
    assert read(now(1, 2, 3, 4)) == [*want, ("d", "h1", 4.0)]


def test_every_bad_file_fails_alone(spark, store, tmp_path, monkeypatch):
    rows = _load_rows(4, 4)
    d = tmp_path / "other"
    d.mkdir()
    ingest(store, LOAD, [_write_csv(tmp_path / "landed.csv", rows)], "r0", 1, AS_OF)
    good = _write_csv(tmp_path / "good.csv", _load_rows(6, 6))
    bad_header = _write_csv(tmp_path / "header.csv", rows, header="Interval,GMTIntervalEnd,MTLF,BAA")
    collided = _write_csv(d / "landed.csv", rows[:2])
    (tmp_path / "bytes.csv").write_bytes((",".join(HEADER) + "\n\xff\n").encode("latin-1"))
    (tmp_path / "empty.csv").write_bytes(b"")
    gone = _write_csv(tmp_path / "gone.csv", rows)
    absent, no_folder = str(tmp_path / "absent.csv"), str(tmp_path / "nowhere" / "x.csv")
    read = raw_zone.read_chunks

    def vanish(session, present, *args):
        present.count()
        (tmp_path / "gone.csv").unlink()             # between the listing and the read
        return read(session, present, *args)

    monkeypatch.setattr(raw_zone, "read_chunks", vanish)
    res = ingest(store, LOAD, [good, bad_header, collided, str(tmp_path / "bytes.csv"), str(tmp_path / "empty.csv"), gone, absent, no_folder],
                 "r1", 2, AS_OF)
    got = {(r["source_path"].replace(f"file:{tmp_path}/", "")): (r["file_status"], r["landing_error"] or r["header_error"]) for r in res.files.collect()}
    assert got["good.csv"] == ("success", None)
    assert got["header.csv"] == ("failed", "missing columns: Averaged Actual")
    assert got["other/landed.csv"][0] == "failed" and "immutable" in got["other/landed.csv"][1]
    assert got["bytes.csv"] == ("failed", ingest_module.NOT_TEXT)
    assert got["gone.csv"] == ("failed", ingest_module.UNREADABLE)
    assert got["empty.csv"] == got["absent.csv"] == got["nowhere/x.csv"] == ("failed", ingest_module.ABSENT)
    run = res.run.first()
    assert (run["status"], run["files_in"], run["files_failed"], run["records_accepted"]) == ("success", 8, 7, 12)
    monkeypatch.setattr(raw_zone, "read_chunks", read)
    with pytest.raises(FileNotFoundError):
        ingest(store, LOAD, [absent, no_folder], "r2", 3, AS_OF)
    assert store.runs().filter("run_id = 'r2'").first()["status"] == "failed"


def test_malformed_documents_are_quarantined_with_their_text(spark, store, tmp_path):
    good = _json(tmp_path / "2026-01-01.json", _weather_doc("2026-01-01", [(-8, 10), (-7, 20)]))
    cut = json.dumps(_weather_doc("2026-01-02", [(-2, 70)]))[:-20]
    (tmp_path / "2026-01-02.json").write_text(cut)
    wrong = json.dumps({"date": "2026-01-03", "station": "KMDS", "readings": "none"})
    (tmp_path / "2026-01-03.json").write_text(wrong)
    (tmp_path / "2026-01-04.json").write_text('{"date": "2026-01-04", "station": "KMDS", "readings": null}')
    (tmp_path / "2026-01-05.json").write_text("  \n")
    res = ingest(store, WEATHER, [good, *(str(tmp_path / f"2026-01-0{i}.json") for i in (2, 3, 4, 5))], "w1", 1, AS_OF)
    run = res.run.first()
    assert (run["records_in"], run["records_accepted"], run["records_quarantined"], run["records_empty_documents"], run["files_failed"]) == (5, 1, 3, 1, 3)
    q = {r["source_file"]: (r["rejection_reason"], r["document_text"]) for r in spark.read.parquet(store.path("quarantine", WEATHER.name)).collect()}
    assert q == {"2026-01-02.json": ("document:malformed", cut), "2026-01-03.json": ("document:malformed", wrong),
                 "2026-01-05.json": ("document:malformed", "  \n")}
    st = {r["source_file"][:10]: (r["file_status"], r["header_error"]) for r in res.files.collect()}
    assert st["2026-01-01"] == st["2026-01-04"] == ("success", None) and st["2026-01-02"] == ("failed", "document:malformed")


def test_streamed_files_give_what_ingest_gives(spark, tmp_path):
    rows = _load_rows(24, 24)
    src = tmp_path / "in"
    src.mkdir()
    order = [4, 2, 0, 3, 1]
    paths = [_write_csv(src / "a.csv", [tuple(r[i] for i in order) for r in rows[:30]], header=",".join(HEADER[i] for i in order)),
             _write_csv(src / "b.csv", rows[30:] + [rows[0][:4] + ("XYZ",)]),
             _write_csv(src / "c.csv", rows, header="Interval,GMTIntervalEnd,MTLF,BAA")]
    streamed, batch = Store(spark, str(tmp_path / "s1")), Store(spark, str(tmp_path / "s2"))
    start_stream(streamed, LOAD, str(src), str(tmp_path / "ck"), AS_OF).awaitTermination()
    ingest(batch, LOAD, paths, "r1", 1, AS_OF)

    def state(s):
        q = spark.read.parquet(s.path("quarantine", LOAD.name)).select(*HEADER, contracts.REASON, "source_file")
        f = spark.read.parquet(s.path("ledger", "files")).select("source_file", "landing_status", "header_error", "file_status")
        return _facts(s), sorted(map(str, q.collect())), sorted(map(str, f.collect()))

    assert state(streamed) == state(batch) and len(state(batch)[0]) == 48
    docs = tmp_path / "docs"
    docs.mkdir()
    _json(docs / "2026-01-01.json", _weather_doc("2026-01-01", [(-8, 10), (-6, 30)]))
    (docs / "2026-01-02.json").write_text("{")
    start_stream(streamed, WEATHER, str(docs), str(tmp_path / "ck2"), AS_OF).awaitTermination()
    assert [r["avg_temperature_c"] for r in streamed.current_facts(WEATHER).collect()] == [-7.0]
    # new files only, and another dataset's documents of one object each
    daily = tmp_path / "daily"
    daily.mkdir()
    for i, doc in enumerate(DAILY_DOCS):
        _json(daily / f"{doc[0]}.json", _daily_doc(*doc))
        if i != 1:
            start_stream(streamed, DAILY, str(daily), str(tmp_path / "ck3"), AS_OF).awaitTermination()
    runs = streamed.runs().filter(F.col("source") == DAILY.name).orderBy("_batch_seq").collect()
    assert [r["records_in"] for r in runs] == [1, 2] and streamed.current_facts(DAILY).count() == 3
