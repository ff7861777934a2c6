"""Latest/first row per key as an aggregate, not a window.

``row_number() over (partition by key order by seq desc) = 1`` sends every
row of a key to one task: a key holding a third of the data becomes a third
of the job in a single sort. ``max_by(struct(row), struct(order))`` is an
aggregate, so Spark computes it partially on the map side first: at most
one row per key per input partition crosses the shuffle, whatever the skew.
The order columns must end in a unique tie-breaker for a deterministic pick.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], latest: bool) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).dropDuplicates(keys)
    agg = F.max_by if latest else F.min_by
    picked = agg(F.struct(*[F.col(c) for c in rest]),
                 F.struct(*[F.col(c) for c in order_cols])).alias("_row")
    return (df.groupBy(*keys).agg(picked)
              .select(*keys, "_row.*")
              .select(*df.columns))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the greatest ``order_cols``."""
    return _pick(df, keys, order_cols, latest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_cols``."""
    return _pick(df, keys, order_cols, latest=False)
