"""Incremental file ingest with Structured Streaming.

A file-source stream picks up only files it has not seen (the checkpoint's
file log replaces a hand-kept "already processed" list); ``availableNow`` turns
it into a catch-up job that processes everything new and stops.

``start_stream`` streams the *files* of a dataset, CSV or JSON: each
micro-batch's new files go through the very same ingest as a batch run does --
landing, raw zone, header or document check, per-file ledger, contract,
quarantine, change log -- so a file gives the same result whichever way it
comes in, and files may differ in the order of their columns.
``stream_table_upsert`` streams rows of Parquet files into a keyed change log.

Exactly-once: ``foreachBatch`` may re-run a batch after a failure. The
ledger row of the run id ``<source>-stream-<writer>-<micro-batch>`` is the
commit marker; a micro-batch that already has one that did not fail is
skipped, and rows of a half-written attempt stay invisible to readers (they
filter on committed attempts). Numbers are claimed (``operators.commits``):
other writers' numbers, a batch run's or another stream's, are never taken
for one's own.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import contracts, quality
from ..operators.upsert import ATTEMPT, BATCH_SEQ, ChangeLog, write_batch
from ..plans.datasets import Dataset
from ..plans.ingest import Store, ingest


def _next_batch(store: Store, source: str, run_id: str, least: int) -> int | None:
    """The change-log sequence of a micro-batch, after all that other runs used; None if its run is committed."""
    if not store.exists("ledger", "runs"):       # first batch ever: nothing to look up
        return least
    mine = (F.col("run_id") == run_id) & (F.col("status") != quality.FAILED)
    found = store.runs().filter(F.col("source") == source) \
                 .agg(F.count_if(mine).alias("done"), F.max(BATCH_SEQ).alias("last")).first()
    if found["done"]:
        return None
    return least if found["last"] is None else max(least, int(found["last"]) + 1)


def _writer(checkpoint: str) -> str:
    """A stream's identity: its checkpoint numbers its micro-batches."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def upsert_batches(store: Store, source: str, keys: Sequence[str], date_col: str,
                   prepare: Callable[[DataFrame], DataFrame], order_cols: Sequence[str],
                   as_of: _dt.datetime, contract: contracts.Contract | None = None,
                   finish: Callable[[DataFrame], DataFrame] | None = None,
                   batch_offset: int = 0, writer: str = "0") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: validate, dedup keep-last, append to the change log, commit.

    ``prepare`` types the raw batch, ``contract`` (optional) splits off the
    quarantine, ``finish`` (optional) projects accepted rows to fact rows.
    ``writer`` tells this stream's micro-batches from those of others.
    """
    log = ChangeLog(store.spark, store.path("facts", source), keys, date_col)

    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{source}-stream-{writer}-{int(batch_offset) + int(batch_id)}"
        seq = _next_batch(store, source, run_id, int(batch_offset) + int(batch_id))
        if seq is None:
            return
        seq, attempt = store.claim(source, run_id, seq)
        rows = prepare(batch)
        n_bad = 0
        flagged = None
        if contract is not None:
            flagged = contracts.flag(rows, contract).persist()
            rejected = contracts.rejected(flagged)
            n_bad = int(write_batch(rejected.select(*[c for c in rejected.columns if not c.startswith("_")]),
                                    store.path("quarantine", source), seq, attempt=attempt,
                                    metrics=[F.count(F.lit(1)).alias("n")]).get("n", 0))
            rows = contracts.accepted(flagged)
        if finish is not None:
            rows = finish(rows)
        # counts are observed while the rows are written: no extra job per micro-batch
        written = log.append(rows, seq, order_cols=order_cols, attempt=attempt)
        n_in = written["rows_in"] + n_bad
        n_keys = written["rows_written"]
        store.record_run(run_id=run_id, source=source, **{BATCH_SEQ: seq, ATTEMPT: attempt}, started_at=as_of,
                         finished_at=as_of, status=quality.SUCCESS, records_in=n_in, records_accepted=n_keys,
                         records_quarantined=n_bad, records_deduplicated=n_in - n_bad - n_keys)
        if flagged is not None:
            flagged.unpersist()

    return run


# Fixed value: the columns of Spark's binary file source, which a stream must be told.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_batches(store: Store, dataset: Dataset, as_of: _dt.datetime, writer: str = "0",
                   **options) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function over a stream of file names: the batch ingest of each micro-batch's files.

    A micro-batch whose files all vanished before they were read is recorded as failed and the stream goes on.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        run_id = f"{dataset.name}-stream-{writer}-{int(batch_id)}"
        seq = _next_batch(store, dataset.name, run_id, int(batch_id))
        if seq is None:
            return
        # names alone; the stream's own file log holds them on the driver too
        paths = [r[0] for r in batch.select("path").distinct().collect()]
        if not paths:
            return
        try:
            ingest(store, dataset, paths, run_id, seq, as_of, **options)
        except FileNotFoundError:       # recorded in the ledger
            return

    return run


def start_stream(store: Store, dataset: Dataset, source_dir: str, checkpoint: str, as_of: _dt.datetime,
                 max_files_per_trigger: int | None = None, **options) -> StreamingQuery:
    """Catch-up stream over a directory of a dataset's files, CSV or JSON, of any size.

    The stream carries names and lengths only: ``binaryFile`` reads no content that is not asked for.
    ``options`` go to ``ingest``.
    """
    reader = store.spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    names = reader.load(source_dir).select("path", "length")
    fn = ingest_batches(store, dataset, as_of, writer=_writer(checkpoint), **options)
    return names.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_csv_stream(store: Store, dataset: Dataset, source_dir: str, checkpoint: str,
                     as_of: _dt.datetime, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """``start_stream`` for a dataset of headered CSV files."""
    return start_stream(store, dataset, source_dir, checkpoint, as_of, max_files_per_trigger)


def stream_table_upsert(store: Store, table_path: str, source: str, keys: Sequence[str], date_col: str,
                        project: Callable[[DataFrame], DataFrame], order_cols: Sequence[str],
                        checkpoint: str, as_of: _dt.datetime,
                        max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Catch-up stream over Parquet files: every trigger's new files are one keyed upsert batch.

    ``table_path`` is a directory, or one file inside a directory (then only
    files with that name are picked up, through ``pathGlobFilter``).
    """
    spark = store.spark
    schema = spark.read.parquet(table_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:        # unset: each trigger takes every new file (one batch per catch-up)
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(table_path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.isFile(jpath):
        reader = reader.option("pathGlobFilter", jpath.getName())
        table_path = jpath.getParent().toString()
    raw = reader.parquet(table_path)
    fn = upsert_batches(store, source, keys, date_col, project, order_cols, as_of, writer=_writer(checkpoint))
    return (raw.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
