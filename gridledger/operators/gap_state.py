"""Gaps of a fact kept up to date batch by batch, without reading the fact again.

``quality.detect_gaps`` cuts time into buckets as wide as the greatest allowed distance and needs only the first and
the last reading of every (series, bucket). Both merge by ``min`` and ``max`` in any order, and a reading that arrives
twice changes nothing, so they can be kept as a log of their own:

    buckets/_batch_seq=<n>/_attempt=<k>   (series, group, bucket) -> first and last reading of one attempt's rows
    groups/_fold=<n>                      (series, group of ``fanout`` buckets) -> first, last, the gaps inside
    folded/_fold=<n>                      the attempts that the groups of fold n took in; written last
    seeds/<name>, seed                    the buckets of a fact that is older than its gap state, if it is

A check reads the group summaries (one row per ``fanout`` buckets) and, for the attempts that no fold has taken in yet,
the bucket rows of the groups that these attempts touch: their gaps are found anew from all committed bucket rows of the
group. A group without new rows keeps its summary, and the hole between two neighbouring groups follows from their first
and last readings, so nothing else is read. The result is that of ``detect_gaps`` over the fact's current rows, whatever
the order in which batches commit: a batch that commits late is an attempt not yet folded, and attempts that died are in
no list of committed ones.

The fact's key must end with the timestamp (an upsert then replaces values, never readings). Rows without a timestamp
are in no gap and are left out; a NULL series is a series. An empty state has no gaps.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .commits import create_if_absent, path_exists, read_text
from .quality import _micros
from .upsert import ATTEMPT, BATCH_SEQ, attempt_filter, only_attempts, write_batch

FANOUT = 1024


class GapState:
    """The gap state of one fact under ``root`` (a shared path)."""

    def __init__(self, spark: SparkSession, root: str, series: Sequence[str], ts_col: str, max_gap_seconds: int = 3600,
                 fanout: int = FANOUT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.series = list(series)
        self.ts_col = ts_col
        self.gap_us = int(max_gap_seconds) * 1_000_000
        self.fanout = int(fanout)

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _has(self, name: str) -> bool:
        return path_exists(self.spark, self._path(name))

    def _read(self, name: str) -> DataFrame | None:
        return self.spark.read.parquet(self._path(name)) if self._has(name) else None

    # ------------------------------------------------------------------ writing

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        """First and last reading per (series, bucket): combined before the shuffle, as in ``detect_gaps``."""
        bucket = F.floor(_micros(self.ts_col) / F.lit(self.gap_us))
        found = rows.filter(F.col(self.ts_col).isNotNull()).select(*self.series, F.col(self.ts_col).alias("_ts"), bucket.alias("_bucket"))
        merged = found.groupBy(*self.series, "_bucket").agg(F.min("_ts").alias("_lo"), F.max("_ts").alias("_hi"))
        return merged.withColumn("_group", F.floor(F.col("_bucket") / F.lit(self.fanout)))

    def seeded(self) -> bool:
        return self._has("seed")

    def seed(self, current: DataFrame | None) -> None:
        """Start the state of a fact that has rows already (None: it has none); later calls change nothing.

        The one full read of the fact. Of two writers that start at once, the first to finish counts.
        """
        if self._has("seed"):
            return
        name = ""
        if current is not None:
            name = uuid.uuid4().hex
            self._bucketed(current).write.parquet(self._path(f"seeds/{name}"))
        create_if_absent(self.spark, self._path("seed"), name)

    def append(self, rows: DataFrame, batch_seq: int, attempt: int = 0) -> None:
        """Add the readings of one attempt; writing the same attempt again replaces them."""
        by_group = self._bucketed(rows).sortWithinPartitions("_group")       # row groups are skipped by their range
        write_batch(by_group, self._path("buckets"), batch_seq, attempt=attempt)

    # ------------------------------------------------------------------ reading

    def _new(self, committed: DataFrame) -> DataFrame:
        pairs = committed.select(F.col(BATCH_SEQ).cast("bigint"), F.col(ATTEMPT).cast("bigint")).distinct()
        done = self._read("folded")
        return pairs if done is None else pairs.join(done.select(BATCH_SEQ, ATTEMPT), [BATCH_SEQ, ATTEMPT], "left_anti")

    def _seeded(self) -> DataFrame | None:
        name = read_text(self.spark, self._path("seed")) if self._has("seed") else ""
        return self._read(f"seeds/{name}") if name else None

    def _summaries(self, buckets: DataFrame) -> DataFrame:
        """One row per (series, group) of bucket rows: first and last reading, and the gaps inside the group.

        A task holds ``fanout`` buckets of a group at most; all steps share one shuffle of the merged buckets.
        """
        keys = [*self.series, "_group"]
        merged = buckets.groupBy(*keys, "_bucket").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
        before = F.lag("_hi").over(Window.partitionBy(*keys).orderBy("_bucket"))
        pair = F.when(self._is_gap(F.col("_prev"), F.col("_lo")), F.struct(F.col("_prev").alias("prev"), F.col("_lo").alias("next")))
        return (merged.withColumn("_prev", before).groupBy(*keys)
                .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), F.sort_array(F.collect_list(pair)).alias("_gaps")))

    def _is_gap(self, prev: Column, after: Column) -> Column:
        return prev.isNotNull() & (_micros(after) - _micros(prev) > F.lit(self.gap_us))

    def _touched(self, committed: DataFrame) -> DataFrame | None:
        """Summaries, from all committed bucket rows, of the groups that hold rows of attempts not folded yet."""
        log, seed = self._read("buckets"), self._seeded()
        new = None if log is None else only_attempts(log, self._new(committed)).select("_group")
        if seed is not None and not self._has("folded"):
            new = seed.select("_group") if new is None else new.union(seed.select("_group"))
        if new is None:
            return None
        low, high = new.agg(F.min("_group"), F.max("_group")).first()
        if low is None:
            return None
        rows = [] if log is None else [attempt_filter(committed)(log)]
        rows += [] if seed is None else [seed]
        near = F.col("_group").between(int(low), int(high))      # reaches the scan; the semi join is exact
        parts = [r.filter(near).select(*self.series, "_group", "_bucket", "_lo", "_hi") for r in rows]
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return self._summaries(every.join(new.distinct(), "_group", "left_semi"))

    def groups(self, committed: DataFrame) -> DataFrame | None:
        """The newest summary of every (series, group): folded ones, and those of groups touched since."""
        columns = [*self.series, "_group", "_lo", "_hi", "_gaps"]
        parts = []
        if self._has("folded") and self._has("groups"):
            # folds are numbered one by one: a fold that died has no list, and its number is above all that do
            last = self._read("folded").agg(F.max("_fold")).first()[0]
            parts.append(self._read("groups").filter(F.col("_fold") <= int(last)).select(*columns, F.col("_fold").cast("bigint")))
        touched = self._touched(committed)
        if touched is not None:
            parts.append(touched.select(*columns, F.lit(2 ** 62).alias("_fold")))
        if not parts:
            return None
        every = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        newest = every.groupBy(*self.series, "_group").agg(F.max_by(F.struct("_lo", "_hi", "_gaps"), "_fold").alias("_g"))
        return newest.select(*self.series, "_group", "_g.*")

    def _between(self, groups: DataFrame) -> DataFrame:
        """Holes between the last reading of a group and the first of the series' next one."""
        before = F.lag("_hi").over(Window.partitionBy(*self.series).orderBy("_group"))
        return groups.select(*self.series, before.alias("prev"), F.col("_lo").alias("next")).filter(self._is_gap(F.col("prev"), F.col("next")))

    def gaps(self, committed: DataFrame, prev_name: str = "prev_ts", next_name: str = "next_ts") -> DataFrame:
        """The holes of every series, as ``detect_gaps`` gives them: ``series + [prev_ts, next_ts, gap_seconds]``."""
        groups = self.groups(committed)
        if groups is None:
            known = self._read("buckets")
            known = known or self.spark.createDataFrame([], ", ".join([*[f"`{c}` string" for c in self.series], "_lo timestamp"]))
            holes = known.select(*self.series, F.col("_lo").alias("prev"), F.col("_lo").alias("next")).limit(0)
        else:
            inside = groups.select(*self.series, F.explode("_gaps").alias("_p")).select(*self.series, "_p.prev", "_p.next")
            holes = inside.unionByName(self._between(groups))
        seconds = (_micros("next") - _micros("prev")) / F.lit(1_000_000)
        return holes.select(*self.series, F.col("prev").alias(prev_name), F.col("next").alias(next_name), seconds.alias("gap_seconds"))

    def fold(self, committed: DataFrame, least: int = 1, take_over: bool = False) -> bool:
        """Take the committed attempts into the group summaries; False if they are fewer than ``least``, or another run is at it.

        One fold runs at a time: it claims the next fold number (``take_over`` claims it from one that died). Checks do
        not depend on it, they only read more bucket rows without it.
        """
        done = self._read("folded")
        number = 0 if done is None else done.agg(F.max("_fold")).first()[0] + 1
        # what is folded is fixed by this list: attempts that commit from now on wait for the next fold
        pairs = [(r[0], r[1]) for r in self._new(committed).collect()]
        if len(pairs) < least:
            return False
        if not create_if_absent(self.spark, self._path(f"claims/{number}"), "") and not take_over:
            return False
        schema = f"{BATCH_SEQ} bigint, {ATTEMPT} bigint"
        new = self.spark.createDataFrame(pairs, schema)
        held = new if done is None else new.unionByName(done.select(BATCH_SEQ, ATTEMPT))
        touched = self._touched(held)
        if touched is not None:
            touched.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._path(f"groups/_fold={number}"))
        new.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(self._path(f"folded/_fold={number}"))
        return True
