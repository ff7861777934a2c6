"""End-to-end ingest of one batch of source files for one dataset.

One Spark job per *set* of files (never a driver loop over files or days); every file's bytes are
read from where they were delivered exactly once:

    requested paths -> listing (absent files are rows, not errors)
      -> chunks of bytes -> SHA-256 + landing name -> landing classification
         (immutable / versioned / capture) -> raw zone (each content once, under its hash)
      -> header check (CSV) or document check (JSON) and parse *from the raw zone*
      -> flatten -> try_cast typing -> contract flag (once, persisted)
      -> quarantine (rejected rows and documents + reasons) | normalised facts (dedup / aggregate)
      -> change-log append -> completeness check -> ledger row (commit marker)

A file that is absent, cannot be read, is no UTF-8 text, collides with a landed name, has a bad header or
is a malformed document fails on its own in the file ledger; the others load in the same job.

Layout under ``store_root`` (a shared path); every attempt of a batch writes its own
``_batch_seq=<n>/_attempt=<k>`` directories (see ``operators.commits``):

    claims/<dataset>/            who holds which batch number
    manifest/<dataset>/          landing manifest
    raw/<dataset>/               the landed bytes under their hash (``sources.raw_zone``)
    quarantine/<dataset>/        rejected rows and documents, original text + reason + lineage (only when any)
    normalized/<dataset>/        accepted fact rows per run, partitioned by event_date
    gaps/<dataset>/              first and last reading per time bucket and batch, and the gaps found (``operators.gap_state``)
    facts/<dataset>/log, base    change log; compacted snapshot and the list of what it holds
    ledger/runs, ledger/checks, ledger/files   run records, check results, per-file status

The ledger row is written last and names the attempt: readers only see attempts that have one, so a
run that dies midway (lost executors, killed driver) leaves no half-visible data, and re-running the
same files is idempotent.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import capture_name
from ..operators import contracts, landing, quality
from ..operators.commits import claim_batch
from ..operators.gap_state import GapState
from ..operators.keyed import latest_per_key
from ..operators.upsert import ATTEMPT, BATCH_SEQ, ChangeLog, attempt_filter, named_attempts, write_batch
from ..session import broadcast_if_small
from ..sources import files, raw_zone
from .datasets import Dataset

PARTIAL = "partial"

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("source", T.StringType(), False),
    T.StructField(BATCH_SEQ, T.LongType(), False),
    T.StructField(ATTEMPT, T.LongType(), True),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("finished_at", T.TimestampType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("files_in", T.LongType(), True),
    T.StructField("files_failed", T.LongType(), True),
    T.StructField("records_in", T.LongType(), True),
    T.StructField("records_accepted", T.LongType(), True),
    T.StructField("records_quarantined", T.LongType(), True),
    T.StructField("records_deduplicated", T.LongType(), True),
    T.StructField("records_empty_documents", T.LongType(), True),
    T.StructField("watermark_before", T.StringType(), True),
    T.StructField("watermark_after", T.StringType(), True),
    T.StructField("error", T.StringType(), True),
])


@dataclass
class Store:
    spark: SparkSession
    root: str
    ledger: DataFrame | None = None      # the run ledger as of some moment; None: as it is when read

    def pinned(self) -> Store:
        """This store with the ledger as it is now: runs that commit from here on are not seen through it."""
        return replace(self, ledger=self.runs())

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def exists(self, *parts: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(self.path(*parts))
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(jpath)

    def read(self, *parts: str) -> DataFrame | None:
        return self.spark.read.parquet(self.path(*parts)) if self.exists(*parts) else None

    def facts(self, dataset: Dataset) -> ChangeLog:
        return ChangeLog(self.spark, self.path("facts", dataset.name), dataset.keys, dataset.date_col)

    def gap_state(self, dataset: Dataset) -> GapState:
        """The gaps of a fact whose key is a series and a time, kept per batch."""
        *series, ts = dataset.keys
        return GapState(self.spark, self.path("gaps", dataset.name), series, ts, dataset.max_gap_seconds)

    def runs(self) -> DataFrame:
        if self.ledger is not None:
            return self.ledger
        if not self.exists("ledger", "runs"):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path("ledger", "runs"))

    def record_run(self, **values) -> DataFrame:
        """Append one ledger row, in a directory of its own: writers that commit at once do not meet."""
        row = {f.name: None for f in RUN_SCHEMA.fields} | values
        run = self.spark.createDataFrame([row], RUN_SCHEMA)
        run.write.parquet(self.path("ledger", "runs", f"_entry=r{uuid.uuid4().hex}"))
        return run

    def _ended(self, source: str) -> DataFrame:
        return self.runs().filter(F.col("source") == source).withColumn(ATTEMPT, F.coalesce(ATTEMPT, F.lit(0).cast("bigint")))

    def committed(self, dataset: Dataset) -> DataFrame:
        """The attempts whose facts count: ``_batch_seq, _attempt``."""
        return self._ended(dataset.name).filter(F.col("status") != quality.FAILED).select(BATCH_SEQ, ATTEMPT)

    def came_to_end(self, dataset: Dataset) -> Callable[[DataFrame], DataFrame]:
        """A filter that keeps the rows of attempts that came to their end, for any table of the store.

        A run that ended with every file failed did land its files: its rows are visible, though it has no facts.
        """
        return attempt_filter(self._ended(dataset.name).filter(F.col("error").isNull()).select(BATCH_SEQ, ATTEMPT))

    def visible(self, dataset: Dataset, *parts: str, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
        """A table of the store without the rows of attempts that died."""
        df = self.read(*parts)
        return None if df is None else (keep or self.came_to_end(dataset))(df)

    def claim(self, source: str, run_id: str, least: int) -> tuple[int, int]:
        """A batch number that no other run holds, ``least`` or greater, and the attempt of this run."""
        # numbers in the ledger are taken even without a claim file
        others = self.runs().filter((F.col("source") == source) & (F.col("run_id") != run_id) & F.col("error").isNull()
                                    & (F.col(BATCH_SEQ) >= int(least)))
        taken = frozenset(r[0] for r in others.select(BATCH_SEQ).distinct().collect())
        return claim_batch(self.spark, self.path("claims", source), run_id, least, taken)

    def compact(self, dataset: Dataset) -> int | None:
        """Fold every committed batch of a fact into its base snapshot (touched dates only)."""
        log = self.facts(dataset)
        return log.compact(self.committed(dataset)) if log.exists() else None

    def current_facts(self, dataset: Dataset) -> DataFrame | None:
        log = self.facts(dataset)
        if not log.exists():
            return None
        return log.current(self.committed(dataset))


@dataclass
class IngestResult:
    run: DataFrame          # the ledger row
    files: DataFrame        # per-file landing/header status
    accepted: DataFrame     # fact rows written by this run
    rejected: DataFrame     # quarantined rows written by this run


def _landing_name(dataset: Dataset, landed: DataFrame, chunks: DataFrame) -> DataFrame:
    """Logical landing name per file (the capture name is read from the bytes already in hand)."""
    if dataset.landing == "capture":
        keep = [files.FILE_PATH]
        whole = chunks.join(landed.select(files.FILE_PATH, "n_chunks"), files.FILE_PATH)
        texts = raw_zone.document_texts(whole, keep)
        gen = F.from_json("text", "generated_at_utc STRING").getField("generated_at_utc")
        names = texts.select(files.FILE_PATH, F.concat(capture_name(gen), F.lit(".json")).alias("name"))
        return landed.join(names, files.FILE_PATH)
    return landed.withColumn("name", F.col(files.FILE_NAME))


def land(store: Store, dataset: Dataset, incoming: DataFrame, batch_seq: int, attempt: int = 0,
         keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Classify one batch of incoming files (one row each, with ``name`` and ``content_sha``) against all landed before.

    Returns one row per incoming file with ``landing_status`` and, for
    versioned datasets, the ``version_name`` the content is stored under.
    """
    order = F.struct(F.lit(int(batch_seq)).cast("bigint").alias("batch"), F.lit(int(attempt)).cast("bigint").alias("attempt"),
                     F.col("modified_at"), F.col(files.FILE_PATH).alias("path"))
    incoming = incoming.withColumn("landed_seq", order).withColumn("_mine", F.lit(True))
    cols = [files.FILE_PATH, files.FILE_NAME, "name", "content_sha", "n_chunks", "landed_seq"]
    previous = store.visible(dataset, "manifest", dataset.name, keep=keep)
    everything = incoming.select(*cols, "_mine")
    if previous is not None:
        everything = previous.select(*cols, F.lit(False).alias("_mine")).unionByName(everything)
    if dataset.landing in ("immutable", "capture"):
        classified = landing.classify_immutable(everything, "name", "content_sha", "landed_seq")
    else:
        stemmed = everything.withColumn("stem", F.regexp_replace("name", r"\.json$", ""))
        classified = landing.classify_versioned(stemmed, "stem", "content_sha", "landed_seq") \
                            .withColumn("landing_error", F.lit(None).cast("string"))
    return classified.filter("_mine").select(*cols, "landing_status", "landing_error",
                                             *(["version_name", "stem"] if dataset.landing == "versioned" else []))


@dataclass
class Parsed:
    rows: DataFrame                  # typed and flagged by the caller
    file_errors: DataFrame           # source_path, content_error: files whose content fails as a whole
    documents: DataFrame | None      # malformed documents: source_path, source_file, document_text
    empty: Observation | None        # how many documents had a missing, NULL or empty array
    held: DataFrame | None = None    # the persisted documents, for the caller to let go


def _parse(dataset: Dataset, chunks: DataFrame, any_large: bool = True) -> Parsed:
    """Rows of the good files, parsed from their chunks.

    For nested documents, ``empty`` observes how many well-formed documents carried a missing, NULL or empty array
    (they yield no rows; the run record counts them). A malformed document fails its file and is handed on with its text.
    """
    if dataset.fmt == "csv":
        rows, header_status = files.csv_from_chunks(chunks, dataset.contract, any_large)
        return Parsed(rows.withColumnRenamed(files.LINE_ORDER, "_line_order"),
                      header_status.select(files.FILE_PATH, F.col("header_error").alias("content_error")), None, None)
    keep = [files.FILE_PATH, files.FILE_NAME, "_file_order"]
    docs = files.json_documents(raw_zone.document_texts(chunks, keep), dataset.json_schema, F.col("text"))
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)
    bad = docs.filter(F.col(files.CORRUPT).isNotNull()).select(
        files.FILE_PATH, files.FILE_NAME, F.col(files.CORRUPT).alias("document_text"))
    errors = docs.select(files.FILE_PATH, F.when(F.col(files.CORRUPT).isNotNull(), F.lit(MALFORMED)).alias("content_error"))
    good = docs.filter(F.col(files.CORRUPT).isNull()).select(*keep, "_doc.*")
    if dataset.explode:
        empty = Observation(f"empty-docs-{uuid.uuid4().hex}")
        good = good.observe(empty, F.count_if(F.coalesce(F.size(dataset.explode), F.lit(0)) <= 0).alias("n"))
        parents = [*dataset.parents, *keep]
        return Parsed(files.explode_documents(good, dataset.explode, parents, position_col="_line_order"), errors, bad, empty, docs)
    return Parsed(good.withColumn("_line_order", F.lit(0)), errors, bad, None, docs)


FOLD_AFTER = 8              # attempts whose bucket rows a completeness check reads before they are folded
MALFORMED = "document:malformed"
ABSENT = "source file not available"
UNREADABLE = "source file could not be read"
NOT_TEXT = "not valid UTF-8 text"


def landed_chunks(zone: DataFrame, wanted: DataFrame, known_files: int | None = None) -> DataFrame:
    """The landed bytes of files (``source_path, source_file, content_sha, _file_order``), found by their hash in the zone.

    The file list is metadata; where it is small it is broadcast, so that no bytes are shuffled.
    """
    zone = zone.withColumn(BATCH_SEQ, F.col(BATCH_SEQ).cast("bigint")).withColumn(ATTEMPT, F.col(ATTEMPT).cast("bigint"))
    where = wanted.join(raw_zone.stored_contents(zone), "content_sha")
    found = zone.drop("chunk_sha").join(broadcast_if_small(where, known_rows=known_files), ["content_sha", BATCH_SEQ, ATTEMPT])
    return found.select(files.FILE_PATH, files.FILE_NAME, "_file_order", "chunk_no", "n_chunks", "bytes")


def _flag(dataset: Dataset, rows: DataFrame) -> DataFrame:
    return contracts.flag(dataset.prepare(rows), dataset.contract).persist(StorageLevel.MEMORY_AND_DISK)


def ingest(store: Store, dataset: Dataset, paths, run_id: str, batch_seq: int,
           as_of: _dt.datetime, partial_on_rejects: bool = False,
           max_document_bytes: int | None = None) -> IngestResult:
    """Run the whole ingest for ``paths``; always records a ledger row (success or failure).

    ``batch_seq`` is the number the run asks for. If another run holds it, the run takes the next free one (the
    ledger row tells which); if that run has committed the very same files, the batch is a retry: nothing is written
    and the committed run is returned.

    Status: ``success``; ``failed`` when no file could be loaded; with
    ``partial_on_rejects``, ``partial`` when rows were quarantined or some
    files failed while others loaded (off by default, as in the reference).
    ``max_document_bytes``, if given, fails files above it; without it a file may be of any size.
    Raises FileNotFoundError if none of the requested files exists.
    """
    try:
        return _ingest(store, dataset, list(paths), run_id, batch_seq, as_of, partial_on_rejects, max_document_bytes)
    except Exception as exc:  # noqa: BLE001 -- the failure is recorded, then re-raised
        store.record_run(run_id=run_id, source=dataset.name, **{BATCH_SEQ: int(batch_seq)}, started_at=as_of,
                         finished_at=as_of, status=quality.FAILED, error=str(exc) or type(exc).__name__)
        raise


def rebuild(store: Store, dataset: Dataset, run_id: str, as_of: _dt.datetime,
            write_base: bool = False) -> DataFrame:
    """Recompute the curated fact from the bytes in the raw zone, by the hashes that the landing manifest names.

    The delivered files are not read: they may have changed or gone. Contents whose bytes do not give their hash
    any more are an error. Immutable datasets use each name's first (landed) file; versioned ones the
    latest version per logical name. All files go through one scan, and the
    keep-last order across files is the landing order, so the result equals
    replaying every ingest in sequence. With ``write_base`` the result is
    written to ``rebuilt/<dataset>`` (date-partitioned) for comparison or swap.
    """
    man = store.visible(dataset, "manifest", dataset.name)
    if man is None:
        raise ValueError(f"nothing landed for {dataset.name}")
    ok = man.filter((F.col("landing_status") != landing.COLLISION) & F.col("valid_text"))
    if dataset.landing == "versioned":
        ok = latest_per_key(ok, ["stem"], ["landed_seq"])
    else:
        ok = ok.filter(F.col("landing_status") == landing.LANDED)
    zone = store.visible(dataset, "raw", dataset.name)
    bad = raw_zone.damaged(zone).join(ok, "content_sha", "left_semi").limit(5).collect()
    if bad:
        raise ValueError(f"raw zone of {dataset.name}: bytes changed or missing for {', '.join(r[0] for r in bad)}")
    wanted = ok.select(files.FILE_PATH, files.FILE_NAME, "content_sha", F.col("landed_seq").alias("_file_order"))
    flagged = _flag(dataset, _parse(dataset, landed_chunks(zone, wanted)).rows)
    lineage = [F.lit(as_of).cast("timestamp").alias("ingested_at"), F.lit(run_id).alias("pipeline_run_id")]
    facts = dataset.finish(contracts.accepted(flagged)) \
        .select(*dataset.fact_columns, files.FILE_NAME, *lineage) \
        .withColumn(dataset.date_col, F.to_date(F.col(dataset.date_source)))
    if write_base:
        (facts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(dataset.date_col).parquet(store.path("rebuilt", dataset.name)))
    return facts


def _same_files(store: Store, dataset: Dataset, batch_seq: int, incoming: DataFrame) -> DataFrame | None:
    """The committed run of a batch number, if it landed exactly the incoming names and contents."""
    run = store._ended(dataset.name).filter((F.col(BATCH_SEQ) == int(batch_seq)) & (F.col("status") != quality.FAILED))
    found = run.orderBy(F.col(ATTEMPT).desc()).limit(1).collect()
    man = store.visible(dataset, "manifest", dataset.name) if found else None
    if man is None:
        return None
    mine = man.filter((F.col(BATCH_SEQ) == int(batch_seq)) & (F.col(ATTEMPT) == found[0][ATTEMPT]))
    one = incoming.groupBy("name", "content_sha").agg(F.count(F.lit(1)).alias("n"))
    two = mine.groupBy("name", "content_sha").agg(F.count(F.lit(1)).alias("m"))
    odd = one.join(two, ["name", "content_sha"], "full").filter(~F.col("n").eqNullSafe(F.col("m")))
    return store.spark.createDataFrame([found[0].asDict()], RUN_SCHEMA) if odd.isEmpty() else None


def _recorded(store: Store, dataset: Dataset, run: DataFrame) -> IngestResult:
    """The result of a run that came to its end, read from the store."""
    at = run.first()

    def own(df: DataFrame | None) -> DataFrame:
        if df is None:
            return store.spark.createDataFrame([], T.StructType([]))
        return df.filter((F.col(BATCH_SEQ) == at[BATCH_SEQ]) & (F.col(ATTEMPT) == at[ATTEMPT]))

    return IngestResult(run=run, files=own(store.read("ledger", "files").filter(F.col("source") == dataset.name)),
                        accepted=own(store.read("normalized", dataset.name)), rejected=own(store.read("quarantine", dataset.name)))


def _ingest(store: Store, dataset: Dataset, paths: list[str], run_id: str, batch_seq: int,
            as_of: _dt.datetime, partial_on_rejects: bool = False,
            max_document_bytes: int | None = None) -> IngestResult:
    spark = store.spark
    # a stream's batch owns its number
    if not run_id.startswith(f"{dataset.name}-stream-") and not store.runs().filter(
            (F.col("source") == dataset.name) & (F.col(BATCH_SEQ) == int(batch_seq)) & (F.col("status") != quality.FAILED)
            & F.col("run_id").startswith(f"{dataset.name}-stream-")).isEmpty():
        raise ValueError(f"batch {batch_seq} of {dataset.name} was written by a stream")
    listed = raw_zone.list_files(spark, paths).persist(StorageLevel.MEMORY_AND_DISK)
    present = listed.filter(F.col("length").isNotNull())
    if max_document_bytes is not None:
        present = present.filter(F.col("length") <= int(max_document_bytes))
    seen = listed.agg(F.count("length").alias("n"), F.max("length").alias("largest")).first()
    if seen["n"] == 0:
        raise FileNotFoundError(f"{ABSENT}: none of {len(paths)} requested, such as {paths[0] if paths else None}")
    # every file is read from storage once: fingerprint, landing name and the raw zone's rows come from these bytes
    chunks = raw_zone.read_chunks(spark, present).persist(StorageLevel.MEMORY_AND_DISK)
    prints = raw_zone.fingerprints(chunks)
    readable = present.select(files.FILE_PATH, files.FILE_NAME, "modified_at").join(prints, files.FILE_PATH)
    incoming = _landing_name(dataset, readable, chunks).persist(StorageLevel.MEMORY_AND_DISK)
    again = _same_files(store, dataset, batch_seq, incoming)
    if again is not None:
        for cached in (incoming, chunks, listed):
            cached.unpersist()
        return _recorded(store, dataset, again)
    batch_seq, attempt = store.claim(dataset.name, run_id, batch_seq)
    ended = store.came_to_end(dataset)

    def put(df: DataFrame, *parts: str, **options) -> dict:
        return write_batch(df, store.path(*parts), batch_seq, attempt=attempt, **options)

    landed = land(store, dataset, incoming, batch_seq, attempt, ended)
    landed = landed.join(incoming.select(files.FILE_PATH, "valid_text"), files.FILE_PATH).persist(StorageLevel.MEMORY_AND_DISK)
    put(landed, "manifest", dataset.name)
    ok = landed.filter(F.col("landing_status") != landing.COLLISION)
    # each content is kept once: those that the zone has already are not written again
    zone = store.visible(dataset, "raw", dataset.name, keep=ended)
    new = ok.groupBy("content_sha").agg(F.min(F.struct(files.FILE_PATH, "n_chunks")).alias("_f")).select(
        "content_sha", f"_f.{files.FILE_PATH}", "_f.n_chunks")
    if zone is not None:
        new = new.join(zone.select("content_sha").distinct(), "content_sha", "left_anti")
    put(raw_zone.rows_to_keep(chunks, broadcast_if_small(new, known_rows=seen["n"])), "raw", dataset.name)
    kept = store.read("raw", dataset.name)
    own = named_attempts([(batch_seq, attempt)])(kept)
    zone = own if zone is None else own.unionByName(ended(kept))

    use = ok.filter("valid_text")
    if dataset.landing == "versioned":
        # process only the latest version of each logical name seen in this batch
        use = latest_per_key(use, ["stem"], ["landed_seq"])
    wanted = use.select(files.FILE_PATH, files.FILE_NAME, "content_sha", F.col("landed_seq").alias("_file_order"))
    parsed = _parse(dataset, landed_chunks(zone, wanted, seen["n"]), seen["largest"] > raw_zone.CHUNK_BYTES)
    flagged = _flag(dataset, parsed.rows)

    lineage = [F.lit(as_of).cast("timestamp").alias("ingested_at"), F.lit(run_id).alias("pipeline_run_id")]
    rejected = contracts.rejected(flagged)
    rejected = rejected.select(*[c for c in rejected.columns if not c.startswith("_")])
    # this aggregate materialises the persisted flagged frame (every later output reads the
    # cache) and gives the ledger counts; quarantine is written only when something was rejected
    counts = flagged.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(contracts.REJECTED)).alias("bad")).first()
    n_in, n_bad = int(counts["n"]), int(counts["bad"])
    if parsed.documents is not None:
        # a malformed document is quarantined whole: its text, and no rows
        documents = parsed.documents.withColumn(contracts.REASON, F.lit(MALFORMED))
        rejected = rejected.unionByName(documents, allowMissingColumns=True)
        malformed = documents.count()
        n_in, n_bad = n_in + malformed, n_bad + malformed
    rejected = rejected.select("*", F.lit(as_of).cast("timestamp").alias("quarantined_at"), F.lit(run_id).alias("pipeline_run_id"))
    if n_bad > 0:
        put(rejected, "quarantine", dataset.name)
    n_empty = int(parsed.empty.get.get("n", 0)) if parsed.empty is not None else None
    facts = dataset.finish(contracts.accepted(flagged))
    facts = facts.select(*dataset.fact_columns, files.FILE_NAME, *lineage) \
                 .withColumn(dataset.date_col, F.to_date(F.col(dataset.date_source)))
    facts = facts.persist(StorageLevel.MEMORY_AND_DISK)
    fact_stats = put(facts, "normalized", dataset.name, partition_cols=[dataset.date_col],
                     metrics=[F.count(F.lit(1)).alias("n"), F.max(F.to_date(F.col(dataset.date_source))).alias("latest")])
    store.facts(dataset).append(facts, batch_seq, attempt=attempt)
    n_facts = int(fact_stats.get("n", 0))
    latest_day = fact_stats.get("latest")

    fstat = _file_status(listed, landed, parsed.file_errors, max_document_bytes)
    fstat = fstat.select(F.lit(run_id).alias("run_id"), F.lit(dataset.name).alias("source"), "*",
                         F.when(F.col("landing_error").isNotNull() | F.col("header_error").isNotNull(),
                                F.lit(quality.FAILED)).otherwise(F.lit(quality.SUCCESS)).alias("file_status"))
    fcount = put(fstat, "ledger", "files", scope=dataset.name, metrics=[
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("file_status") == quality.FAILED).alias("failed")])
    loaded_any = int(fcount["n"]) > int(fcount["failed"])

    # completeness of the whole fact, where the dataset has a grid: from its gap state, not from its rows
    state = None
    if dataset.max_gap_seconds is not None and loaded_any:
        # this attempt is not committed yet: include it explicitly
        committed = store.committed(dataset).unionByName(
            spark.createDataFrame([(int(batch_seq), int(attempt))], f"{BATCH_SEQ} bigint, {ATTEMPT} bigint"))
        state = store.gap_state(dataset)
        if not state.seeded():
            earlier = store.committed(dataset)
            state.seed(None if earlier.isEmpty() else store.facts(dataset).current(earlier))
        state.append(facts, batch_seq, attempt)
        put(quality.completeness_result(state.gaps(committed), run_id, as_of), "ledger", "checks", scope=dataset.name)

    status = quality.SUCCESS if loaded_any else quality.FAILED
    if loaded_any and partial_on_rejects and (n_bad > 0 or int(fcount["failed"]) > 0):
        status = PARTIAL
    if dataset.watermark == "data":
        watermark = latest_day.isoformat() if latest_day is not None else None
    else:
        watermark = as_of.date().isoformat()
    # commit marker, written last
    run = store.record_run(
        run_id=run_id, source=dataset.name, **{BATCH_SEQ: int(batch_seq), ATTEMPT: int(attempt)}, started_at=as_of,
        finished_at=as_of, status=status, files_in=int(fcount["n"]), files_failed=int(fcount["failed"]), records_in=n_in,
        records_accepted=n_facts, records_quarantined=n_bad, records_deduplicated=max(n_in - n_bad - n_facts, 0),
        records_empty_documents=n_empty, watermark_after=watermark)
    if state is not None:
        state.fold(store.committed(dataset), least=FOLD_AFTER)
    for cached in (facts, flagged, parsed.held, landed, incoming, chunks, listed):
        if cached is not None:
            cached.unpersist()
    # what was written, not a plan that would read the delivered files again
    return _recorded(store, dataset, run)


def _file_status(listed: DataFrame, landed: DataFrame, errors: DataFrame, max_document_bytes: int | None) -> DataFrame:
    """One row per requested file; what kept it from loading, if anything did, is its first error."""
    content = errors.filter(F.col("content_error").isNotNull()).select(files.FILE_PATH, "content_error")
    known = landed.select(files.FILE_PATH, "landing_status", F.col("landing_error").alias("_collision"), "valid_text")
    all_ = listed.join(known, files.FILE_PATH, "left").join(content, files.FILE_PATH, "left")
    too_large = F.lit(False) if max_document_bytes is None else F.col("length") > int(max_document_bytes)
    error = (F.when(F.col("length").isNull(), F.lit(ABSENT))
              .when(too_large, F.concat(F.lit("file larger than the document limit: "), F.col("length").cast("string"), F.lit(" bytes")))
              .when(F.col("landing_status").isNull(), F.lit(UNREADABLE))
              .otherwise(F.col("_collision")))
    header = F.when(error.isNotNull(), F.lit(None).cast("string")) \
              .when(~F.col("valid_text"), F.lit(NOT_TEXT)).otherwise(F.col("content_error"))
    return all_.select("requested", files.FILE_PATH, files.FILE_NAME, "landing_status", error.alias("landing_error"), header.alias("header_error"))
