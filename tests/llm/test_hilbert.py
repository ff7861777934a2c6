"""Hilbert sharding: the curve against a recursive construction, the laws, copies, files and pruning."""

import tempfile
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridledger.llm import hilbert
from gridledger.llm.common import table
from gridledger.llm.queries import op13_hilbert

from .conftest import SF


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_neighbours_on_the_curve_are_neighbours_in_the_grid(spark, dims, bits):
    side = 1 << bits
    frame = spark.range(side ** dims).select(*[(F.floor(F.col("id") / side ** i) % side).cast("int").alias(f"s{i}") for i in range(dims)])
    rows = frame.select("*", hilbert.curve_index([F.col(f"s{i}") for i in range(dims)], bits).alias("h")).collect()
    order = sorted(rows, key=lambda r: r["h"])
    assert [r["h"] for r in order] == list(range(side ** dims))                       # a permutation of the cells
    for a, b in zip(order, order[1:]):
        assert sum(abs(a[f"s{i}"] - b[f"s{i}"]) for i in range(dims)) == 1             # unit steps: a Hilbert curve
    # every aligned sub-cube is one unbroken run
    for level in range(1, bits):
        runs = [tuple(r[f"s{i}"] >> level for i in range(dims)) for r in order]
        size = (1 << level) ** dims
        assert all(len(set(runs[k:k + size])) == 1 for k in range(0, len(runs), size))


def check_laws(frame, out, shards, law):
    texts = defaultdict(list)
    for r in frame.collect():
        t = (r["text"] or "").encode()
        texts[r["doc_id"]].append((len(t) + 1, zlib.crc32(t)))
    got = defaultdict(list)
    for r in out:
        got[r["doc_id"]].append((r["size"], r["text_crc32"]))
        assert r["law"] == law and r["grown_shard"] is None and 0 <= r["shard"] < shards
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in texts.items()}
    slots = defaultdict(list)
    sizes = Counter()
    for r in out:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    if law == "rows":
        assert max(counts) - min(counts) <= 1
    else:
        share, most = sum(sizes.values()) / shards, max(r["size"] for r in out)
        assert all(abs(sizes[s] - share) <= most for s in range(shards))
    order = sorted(out, key=lambda r: (r["shard"], r["slot"]))
    assert [r["curve_index"] for r in order] == sorted(r["curve_index"] for r in order)


@pytest.mark.parametrize("law", ["rows", "bytes"])
def test_laws_hold(docs, odd, law):
    for frame, shards in ((docs, 8), (docs, 3), (odd, 8), (odd, 2)):
        check_laws(frame, hilbert.assign(frame, shards, law).collect(), shards, law)


def test_a_row_that_repeats_is_split(spark, empty, monkeypatch):
    monkeypatch.setattr(hilbert, "BUCKET_ROWS", 10)
    rows = [(7, "same text", "en", "a")] * 60 + [(i, f"text {i} " * (i % 9), "en" if i % 2 else "de", f"s{i % 5}") for i in range(60)]
    frame = spark.createDataFrame(rows + [(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    for parts in (1, 7):
        check_laws(frame, hilbert.assign(frame.repartition(parts), 8).collect(), 8, "rows")
    a, b = (sorted(map(tuple, hilbert.assign(frame.repartition(p), 8).collect()), key=str) for p in (2, 5))
    assert a == b                                                                     # the layout does not matter
    assert hilbert.assign(empty).count() == 0 and hilbert.assign(empty, law="bytes").count() == 0
    assert hilbert.assign(spark.createDataFrame([(1, "x")], "doc_id long, text string"), 3).collect()[0]["slot"] == 0


def test_files_hold_their_runs_and_are_pruned(spark, docs, monkeypatch):
    frame = docs.withColumn("shard", F.lit("x")).union(docs.limit(1).withColumn("shard", F.lit("x")))
    path = f"{tempfile.mkdtemp()}/out"
    ranges = hilbert.write(frame, path, 8)
    stored = spark.read.parquet(path)
    assert sorted(map(str, stored.select(*frame.columns).collect())) == sorted(map(str, frame.collect()))
    counts = [r["rows"] for r in ranges.collect()]
    assert sum(counts) == frame.count() and max(counts) - min(counts) <= 1
    # pruning loses no row and opens fewer shards than there are
    opened = []
    for wanted in ({"lang": ("fr", "fr")}, {"size": (1, 400)}, {"lang": ("en", "en"), "size": (5000, 10 ** 9)}):
        kept = {r["shard"] for r in hilbert.shards_for(ranges, wanted).collect()}
        hit = stored.where(" and ".join(f"{'octet_length(text) + 1' if d == 'size' else d} between {a!r} and {b!r}" for d, (a, b) in wanted.items()))
        assert {r["shard_"] for r in hit.select("shard_").distinct().collect()} <= kept
        opened.append(len(kept))
    assert min(opened) < 8


def test_query_is_native(spark):
    out = op13_hilbert(spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    check_laws(table(spark, SF, "documents"), out.withColumn("curve_index", F.col("curve_index")).collect(), 8, "rows")
