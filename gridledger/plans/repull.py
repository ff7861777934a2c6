"""Incremental re-pull of a source that keeps growing and revises its recent rows.

One run of ``IncrementalFact.pull``: the watermark comes from the committed runs in the ledger, the rows from
``watermark - overlap`` on are read (the bound is a literal, so it reaches the scan), upserted into the fact's change
log, and the ledger row that commits them carries ``watermark_before`` and ``watermark_after``.

* The first run has no watermark and reads the whole source.
* A row that arrives late is taken if it is at most ``overlap`` older than the watermark; a revision likewise. Older
  ones are for a run with ``full=True``, which reads everything again. Rows without a timestamp are read by every run.
* A run that died has no ledger row: its rows are not seen, the watermark stays, and the next run reads them again. A
  run that is repeated under its id after it committed reads nothing and returns its ledger row.
* Several versions of a key in one pull resolve by ``order_cols`` (the timestamp, if none are named), versions of
  different pulls by the batch number, which is claimed before the source is read.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import quality
from ..operators.reconcile import incremental_window
from ..operators.upsert import ATTEMPT, BATCH_SEQ, ROW_SEQ, ChangeLog
from .ingest import RUN_SCHEMA, Store

DATE_COL = "_event_date"
RUN_COL = "pipeline_run_id"
# Fixed value: watermarks as text of one width, so that their order is that of the instants.
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


@dataclass
class IncrementalFact:
    """A fact of ``store`` that is kept up to date from a source with a key and a timestamp."""
    store: Store
    name: str
    keys: Sequence[str]
    ts_col: str
    overlap_hours: int
    order_cols: Sequence[str] = ()

    def _log(self) -> ChangeLog:
        return ChangeLog(self.store.spark, self.store.path("facts", self.name), self.keys, DATE_COL)

    def _committed(self) -> DataFrame:
        return self.store._ended(self.name).filter((F.col("status") != quality.FAILED) & F.col("error").isNull())

    def watermark(self) -> str | None:
        """The latest timestamp that committed runs have taken in, as text; None before the first."""
        return self._committed().agg(F.max("watermark_after")).first()[0]

    def pull(self, source: DataFrame, run_id: str, as_of: _dt.datetime, full: bool = False) -> DataFrame:
        """Take in what is new in ``source``; returns the ledger row. A failure is recorded and raised."""
        reserved = {DATE_COL, RUN_COL, BATCH_SEQ, ATTEMPT, ROW_SEQ} & set(source.columns)
        if reserved:
            raise ValueError(f"columns kept for the change log: {', '.join(sorted(reserved))}")
        done = self._committed().filter(F.col("run_id") == run_id).limit(1).collect()
        if done:
            return self.store.spark.createDataFrame([done[0].asDict()], RUN_SCHEMA)
        number = self._committed().agg(F.max(BATCH_SEQ)).first()[0]
        number, attempt = self.store.claim(self.name, run_id, 1 if number is None else number + 1)
        mine = {"run_id": run_id, "source": self.name, BATCH_SEQ: number, ATTEMPT: attempt, "started_at": as_of, "finished_at": as_of}
        try:
            before = self.watermark()
            t = source.schema[self.ts_col].dataType
            rows = source
            if before is not None and not full:
                rows = incremental_window(source, self.ts_col, F.lit(before).cast(t), self.overlap_hours, keep_undated=True)
            seen = Observation(f"pull-{uuid.uuid4().hex}")
            rows = rows.observe(seen, F.date_format(F.max(self.ts_col), WATERMARK_FORMAT).alias("latest"))
            rows = rows.withColumn(RUN_COL, F.lit(run_id)).withColumn(DATE_COL, F.to_date(F.col(self.ts_col)))
            written = self._log().append(rows, number, list(self.order_cols) or [self.ts_col], attempt)
        except Exception as exc:
            self.store.record_run(**mine, status=quality.FAILED, error=str(exc) or type(exc).__name__)
            raise
        after = max((w for w in (before, seen.get.get("latest")) if w is not None), default=None)
        # commit marker, written last
        return self.store.record_run(
            **mine, status=quality.SUCCESS, records_in=written["rows_in"], records_accepted=written["rows_written"],
            records_deduplicated=written["rows_in"] - written["rows_written"], watermark_before=before, watermark_after=after)

    def current(self) -> DataFrame | None:
        """Latest version of every key over the committed runs, with the run that brought it; None before the first."""
        log = self._log()
        if self._committed().isEmpty():
            return None
        return log.current(self._committed().select(BATCH_SEQ, ATTEMPT)).drop(DATE_COL)

    def compact(self) -> int | None:
        """Fold the committed runs into the fact's base."""
        log = self._log()
        return log.compact(self._committed().select(BATCH_SEQ, ATTEMPT)) if log.exists() else None
