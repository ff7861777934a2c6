"""Declarative data contracts and the accept/quarantine split.

A contract is a column set plus a list of row rules. ``flag`` adds one
``rejection_reason`` column (all failing rule ids joined by ``'; '``, NULL
when the row passes) in a single projection; ``split`` derives both outputs
from that one flagged frame, so rows are validated exactly once and every
input row lands on exactly one side.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import Rule, any_failure, reason_column

REASON = "rejection_reason"
REJECTED = "_rejected"


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[str, ...]
    rules: tuple[Rule, ...]
    strict: bool = False          # extra columns fail the whole file
    optional: tuple[str, ...] = field(default_factory=tuple)

    def reason(self) -> Column:
        return reason_column(self.rules)


def flag(df: DataFrame, contract: Contract, reason_col: str = REASON) -> DataFrame:
    """Add the reason string and a boolean ``_rejected`` (OR of the rule predicates).

    The split filters on the boolean: when Catalyst pushes that filter below the
    projection it inlines a few comparisons, not the reason-string construction.
    """
    return (df.withColumn(reason_col, contract.reason())
              .withColumn(REJECTED, any_failure(contract.rules)))


def accepted(flagged: DataFrame, reason_col: str = REASON) -> DataFrame:
    return flagged.filter(~F.col(REJECTED)).drop(reason_col, REJECTED)


def rejected(flagged: DataFrame, reason_col: str = REASON) -> DataFrame:
    return flagged.filter(F.col(REJECTED)).drop(REJECTED)


def split(df: DataFrame, contract: Contract, reason_col: str = REASON,
          persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) from one validation pass.

    The flagged frame is persisted (memory, spilling to disk) so the two
    consumers do not re-scan and re-validate; batch ingest instead writes the
    flagged frame once partitioned by outcome (see ``plans.ingest``).
    """
    flagged = flag(df, contract, reason_col)
    if persist:
        flagged = flagged.persist(StorageLevel.MEMORY_AND_DISK)
    return accepted(flagged, reason_col), rejected(flagged, reason_col)


def column_set_reason(header: Column, contract: Contract) -> Column:
    """Schema-level check of one file's header (an array of column names).

    Missing required columns always fail; extra columns fail only for a
    strict contract. Returns NULL when the header is acceptable.
    """
    expected = F.array(*[F.lit(c) for c in contract.columns])
    allowed = F.array(*[F.lit(c) for c in contract.columns + contract.optional])
    missing = F.array_except(expected, header)
    extra = F.array_except(header, allowed)
    missing_txt = F.when(F.size(missing) > 0,
                         F.concat(F.lit("missing columns: "), F.array_join(F.array_sort(missing), ",")))
    extra_txt = (F.when(F.size(extra) > 0,
                        F.concat(F.lit("unexpected columns: "), F.array_join(F.array_sort(extra), ",")))
                 if contract.strict else F.lit(None).cast("string"))
    joined = F.concat_ws("; ", missing_txt, extra_txt)
    return F.when(joined == "", F.lit(None).cast("string")).otherwise(joined)


def ordered_columns(contract: Contract) -> Sequence[str]:
    return list(contract.columns) + list(contract.optional)
