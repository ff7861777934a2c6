"""Idempotent keyed upsert, in a pure form and a persisted change-log form.

Pure form: ``upsert(current, incoming, keys)`` = current rows whose key is
not in the batch, plus the batch (deduplicated keep-last). Every non-key
column is replaced, so a later NULL overwrites a known value unless the
column is listed in ``keep_known``.

Persisted form (no table format with MERGE is assumed): a fact is a
change log where each attempt of a batch owns a
``_batch_seq=<n>/_attempt=<k>`` directory (inner partitions by event date).
An attempt is only visible once its ledger row exists (commit marker), so a
job that dies half way leaves nothing a reader would pick up, and no writer
ever overwrites another's files (``operators.commits`` hands out the numbers).
The current table is the latest row per key over the compacted ``base`` plus
the committed attempts that are not in it. ``compact`` folds committed
attempts into ``base`` and records exactly which ones it folded, so a batch
that commits late with a low number is still read and folded later. It
rewrites only the date partitions that the new attempts touch, reading the
log and writing ``base`` -- never overwriting what it reads.
"""

from __future__ import annotations

import uuid
from typing import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .commits import create_if_absent
from .keyed import latest_per_key

BATCH_SEQ = "_batch_seq"
ATTEMPT = "_attempt"
ROW_SEQ = "_row_seq"


def upsert(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order_cols: Sequence[str] | None = None,
           keep_known: Iterable[str] | None = None) -> DataFrame:
    """Insert-or-replace ``incoming`` into ``current`` on ``keys``.

    One pass: both sides are tagged (current 0, incoming 1) and unioned, and
    the latest row per key by ``(tag, order_cols)`` wins -- a map-side
    combined aggregate, so each input is scanned once and a hot key never
    lands whole in one task. ``order_cols`` (ending in a unique tie-breaker)
    resolves a key repeated inside the batch keep-last. ``keep_known``
    columns take the latest non-NULL value instead, so a later NULL does not
    erase a known value.
    """
    keys = list(keys)
    cols = list(current.columns)
    order_cols = list(order_cols or [])
    order_types = {c: incoming.schema[c].dataType for c in order_cols}
    cur = current.select(*cols, F.lit(0).alias("_src"),
                         *[F.lit(None).cast(order_types[c]).alias(f"_o_{c}") for c in order_cols])
    inc = incoming.select(*cols, F.lit(1).alias("_src"), *[F.col(c).alias(f"_o_{c}") for c in order_cols])
    tagged = cur.unionByName(inc)
    order = F.struct(F.col("_src"), *[F.col(f"_o_{c}") for c in order_cols])
    keep_known = [c for c in (keep_known or []) if c not in keys]
    rest = [c for c in cols if c not in keys]
    aggs = []
    for c in rest:
        if c in keep_known:
            aggs.append(F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c))
    plain = [c for c in rest if c not in keep_known]
    if plain:
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in plain]), order).alias("_row"))
    out = tagged.groupBy(*keys).agg(*aggs)
    if plain:
        out = out.select(*keys, *keep_known, "_row.*")
    return out.select(*cols)


def append_history(current: DataFrame, incoming: DataFrame, keys: Sequence[str],
                   order_cols: Sequence[str] | None = None) -> DataFrame:
    """Upsert for history tables whose key includes the capture time.

    Distinct captures accumulate; re-delivering a capture replaces it.
    """
    return upsert(current, incoming, keys, order_cols)


def write_batch(df: DataFrame, path: str, batch_seq: int, partition_cols: Sequence[str] = (),
                scope: str | None = None, metrics: Sequence | None = None, attempt: int = 0) -> dict:
    """Idempotent batch write into ``<path>/_batch_seq=<n>/_attempt=<k>/<partitions>``.

    Each attempt owns one directory, written with a plain overwrite of that
    directory: re-running it replaces its earlier partial output instead of
    appending a second copy, and other attempts and batches are never
    touched. Reading ``<path>`` discovers ``_batch_seq``, ``_attempt`` (and the
    inner partition columns) as partition columns, so filters on them prune.
    ``scope`` adds a ``source=<scope>`` level for tables shared by several
    writers (check results, file status) whose batch numbers are independent.
    ``metrics`` (aggregate Columns) are observed while the write runs and
    returned as a dict -- counts for the run ledger without a second job.
    """
    base = path.rstrip("/") + (f"/source={scope}" if scope else "")
    target = f"{base}/{BATCH_SEQ}={int(batch_seq)}/{ATTEMPT}={int(attempt)}"
    obs = None
    if metrics:
        obs = Observation(f"write-{uuid.uuid4().hex}")
        df = df.observe(obs, *metrics)
    writer = df.drop(BATCH_SEQ, ATTEMPT, *(["source"] if scope else [])).write.mode("overwrite")
    # a retry with fewer partitions must not leave the earlier attempt's: the session's dynamic mode would
    writer = writer.option("partitionOverwriteMode", "static")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(target)
    return dict(obs.get) if obs is not None else {}


NAMED_ATTEMPTS = 1000       # most attempts that a filter names one by one


def attempt_filter(attempts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A function that keeps the rows of the attempts listed (``_batch_seq``, and ``_attempt`` where attempts differ).

    Up to ``NAMED_ATTEMPTS`` of them (since the last compaction, as a rule) are named in a filter on the directory
    columns, so that the other directories are not even listed for the scan; more are a semi join. The list is read
    once, however many tables it is applied to.
    """
    names = [c for c in (BATCH_SEQ, ATTEMPT) if c in attempts.columns]
    wanted = attempts.select(*[F.col(c).cast("bigint").alias(c) for c in names]).distinct()
    found = wanted.limit(NAMED_ATTEMPTS + 1).collect()
    if len(found) > NAMED_ATTEMPTS:
        return lambda df: df.join(wanted, names, "left_semi")
    return named_attempts([(r[BATCH_SEQ], r[ATTEMPT] if ATTEMPT in names else None) for r in found])


def named_attempts(pairs: Iterable[tuple[int, int | None]]) -> Callable[[DataFrame], DataFrame]:
    """As ``attempt_filter``, for a short list of (batch, attempt); an attempt of None stands for all."""
    by_attempt: dict[int | None, list[int]] = {}
    for batch, attempt in pairs:
        by_attempt.setdefault(attempt, []).append(batch)
    keep = F.lit(False)
    for attempt, batches in by_attempt.items():
        one = F.col(BATCH_SEQ).isin(batches)
        keep = keep | (one if attempt is None else one & (F.col(ATTEMPT) == attempt))
    return lambda df: df.filter(keep)


def only_attempts(df: DataFrame, attempts: DataFrame) -> DataFrame:
    """The rows of the attempts listed; see ``attempt_filter``."""
    return attempt_filter(attempts)(df)


class ChangeLog:
    """Append-only change log of one fact under ``root`` (a shared path)."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], date_col: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)
        self.date_col = date_col

    @property
    def log_path(self) -> str:
        return f"{self.root}/log"

    @property
    def base_path(self) -> str:
        return f"{self.root}/base"

    def append(self, batch: DataFrame, batch_seq: int, order_cols: Sequence[str] | None = None, attempt: int = 0) -> dict:
        """Write one attempt of a batch; in-batch duplicates resolve keep-last before writing.

        Re-running the same attempt replaces its files (see ``write_batch``), so
        it never doubles its rows. Returns
        ``rows_in`` (before dedup) and ``rows_written``, observed during the write.
        """
        seen = Observation(f"append-in-{uuid.uuid4().hex}")
        batch = batch.observe(seen, F.count(F.lit(1)).alias("rows_in"))
        if order_cols:
            batch = latest_per_key(batch, self.keys, order_cols)
        out = write_batch(batch.withColumn(ROW_SEQ, F.monotonically_increasing_id()), self.log_path, batch_seq,
                          [self.date_col], metrics=[F.count(F.lit(1)).alias("rows_written")], attempt=attempt)
        return {"rows_in": int(seen.get.get("rows_in", 0)), "rows_written": int(out.get("rows_written", 0))}

    def _exists(self, path: str) -> bool:
        jvm = self.spark.sparkContext._jvm
        jpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = jpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return fs.exists(jpath)

    def exists(self) -> bool:
        return self._exists(self.log_path)

    def log(self, committed: DataFrame | None = None) -> DataFrame:
        """The raw log; with ``committed`` (``_batch_seq``, and ``_attempt`` where attempts differ), only those.

        See ``only_attempts`` for how the commit filter prunes.
        """
        df = self.spark.read.parquet(self.log_path)
        return df if committed is None else only_attempts(df, committed)

    @property
    def folded_path(self) -> str:
        return f"{self.root}/folded"

    def folded(self) -> DataFrame:
        """The attempts that ``base`` holds: ``_batch_seq, _attempt``."""
        if not self._exists(self.folded_path):
            return self.spark.createDataFrame([], f"{BATCH_SEQ} bigint, {ATTEMPT} bigint")
        return self.spark.read.parquet(self.folded_path).select(BATCH_SEQ, ATTEMPT)

    def _attempts(self, committed: DataFrame | None) -> DataFrame:
        """Attempts of the log, the committed ones if told which these are."""
        return self.log(committed).select(F.col(BATCH_SEQ).cast("bigint"), F.col(ATTEMPT).cast("bigint")).distinct()

    def _unfolded(self, committed: DataFrame | None) -> tuple[DataFrame, int | None, int | None]:
        """Committed attempts that ``base`` does not hold, and their least and greatest batch number.

        The names of attempts come from the ledger, or from the log's directories; the two numbers prune the log's
        directories before the exact semi join on the attempts.
        """
        named = committed is not None and ATTEMPT in committed.columns
        pairs = (committed.select(F.col(BATCH_SEQ).cast("bigint"), F.col(ATTEMPT).cast("bigint")).distinct()
                 if named else self._attempts(committed))
        new = pairs.join(self.folded(), [BATCH_SEQ, ATTEMPT], "left_anti")
        low, high = new.agg(F.min(BATCH_SEQ), F.max(BATCH_SEQ)).first()
        return new, low, high

    def current(self, committed: DataFrame | None = None) -> DataFrame:
        """Latest row per key: ``base`` plus the committed attempts that are not folded into it.

        A read costs the compacted snapshot plus the batches since, not the whole
        history. Base rows keep the (batch, attempt, row) sequence they won with, so
        that newer batches win over them, and a batch that commits late does not.
        """
        new, low, high = self._unfolded(committed)
        base = self.base() if self._exists(self.base_path) else None
        if low is None:
            if base is None:
                return self.spark.read.parquet(self.log_path).limit(0).drop(BATCH_SEQ, ATTEMPT, ROW_SEQ)
            rows = base
        else:
            rows = only_attempts(self.spark.read.parquet(self.log_path).filter(F.col(BATCH_SEQ).between(int(low), int(high))), new)
            if base is not None:
                rows = base.unionByName(rows.select(*[F.col(c).cast(base.schema[c].dataType) for c in base.columns]))
        latest = latest_per_key(rows, self.keys, [BATCH_SEQ, ATTEMPT, ROW_SEQ])
        return latest.drop(BATCH_SEQ, ATTEMPT, ROW_SEQ)

    def compact(self, committed: DataFrame | None = None, upto: int | None = None, take_over: bool = False) -> int | None:
        """Fold committed attempts (of batches up to ``upto``) into ``base``; returns the greatest batch in it.

        Only event-date partitions that the new attempts touch are rewritten
        (dynamic partition overwrite), each from its full history of folded and new
        attempts, so compaction reads the log and writes ``base`` -- never
        overwriting what it reads. The list of what was folded is written last: a
        crash in between leaves the old list, and the next read merges the same
        batches again to the same result. One compaction runs at a time: it claims
        the next fold number; ``take_over`` claims it from one that died.
        """
        new, low, high = self._unfolded(committed)
        if upto is not None:
            new = new.filter(F.col(BATCH_SEQ) <= F.lit(int(upto)))
            low, high = new.agg(F.min(BATCH_SEQ), F.max(BATCH_SEQ)).first()
        done = self.folded().agg(F.max(BATCH_SEQ)).first()[0]
        if low is None:
            return done
        fold = 0
        if self._exists(self.folded_path):
            fold = self.spark.read.parquet(self.folded_path).agg(F.max("_fold")).first()[0] + 1
        if not create_if_absent(self.spark, f"{self.root}/folds/{fold}", "") and not take_over:
            raise RuntimeError(f"compaction {fold} of {self.root} is under way (or died: take_over=True)")
        # what is folded is fixed here: an attempt that commits from now on stays in the log
        fold_path = f"{self.folded_path}/_fold={fold}"
        plan_path = f"{self.root}/folds/plan-{uuid.uuid4().hex}"
        new.write.parquet(plan_path)
        new = self.spark.read.parquet(plan_path)
        log = self.spark.read.parquet(self.log_path)
        delta = only_attempts(log.filter(F.col(BATCH_SEQ).between(int(low), int(high))), new)
        # rows without a date have a partition too
        touched = delta.select(F.col(self.date_col).alias("_touched")).distinct()
        held = self.folded().unionByName(new)
        history = only_attempts(log, held).join(touched, F.col(self.date_col).eqNullSafe(F.col("_touched")), "left_semi")
        latest = latest_per_key(history, self.keys, [BATCH_SEQ, ATTEMPT, ROW_SEQ]) \
            .withColumn(BATCH_SEQ, F.col(BATCH_SEQ).cast("bigint")).withColumn(ATTEMPT, F.col(ATTEMPT).cast("bigint"))
        (latest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(self.date_col).parquet(self.base_path))
        new.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(fold_path)
        return int(high) if done is None else max(int(high), int(done))

    def base(self) -> DataFrame:
        return self.spark.read.parquet(self.base_path)
