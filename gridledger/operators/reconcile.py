"""Cross-source reconciliation and incremental re-pull windows."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Reconciliation outcomes.
MATCH = "match"
MISMATCH = "mismatch"
ONLY_LEFT = "only_left"
ONLY_RIGHT = "only_right"


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], value_col: str,
              tolerance: float = 0.0) -> DataFrame:
    """Full outer join of two sources on ``keys`` comparing one measure.

    ``match`` when both values are within ``tolerance`` (both NULL also
    matches), ``mismatch`` otherwise, ``only_left`` / ``only_right`` when
    the key is missing on one side. Keys are coalesced from both sides.
    """
    keys = list(keys)
    l = left.select(*keys, F.col(value_col).alias("left_value"), F.lit(True).alias("_l"))
    r = right.select(*keys, F.col(value_col).alias("right_value"), F.lit(True).alias("_r"))
    j = l.join(r, keys, "full_outer")
    diff = F.col("left_value") - F.col("right_value")
    same = (F.col("left_value").isNull() & F.col("right_value").isNull()) | \
           F.coalesce(F.abs(diff) <= F.lit(tolerance), F.lit(False))
    status = (F.when(F.col("_r").isNull(), F.lit(ONLY_LEFT))
               .when(F.col("_l").isNull(), F.lit(ONLY_RIGHT))
               .when(same, F.lit(MATCH))
               .otherwise(F.lit(MISMATCH)))
    return j.select(*keys, "left_value", "right_value", diff.alias("difference"),
                    status.alias("reconcile_status"))


def incremental_window(df: DataFrame, ts_col: str, watermark, overlap_hours: int, keep_undated: bool = False) -> DataFrame:
    """Rows to re-pull: ``ts >= watermark - overlap`` (late revisions inside the overlap are re-read).

    ``watermark`` is a literal or a Column (e.g. a scalar aggregate joined in).
    Rows without a timestamp are on no side of it: they are left out unless ``keep_undated``.
    """
    wm = watermark if isinstance(watermark, Column) else F.lit(watermark).cast(df.schema[ts_col].dataType)
    late = F.col(ts_col) >= wm - F.expr(f"INTERVAL {int(overlap_hours)} HOURS")
    return df.filter(F.col(ts_col).isNull() | late if keep_undated else late)
