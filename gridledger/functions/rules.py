"""Declarative row rules.

A rule is ``(rule_id, failure_predicate)``. Predicates are ordinary Column
expressions, so a whole contract compiles into one projection that stays
inside whole-stage codegen. SQL three-valued logic is handled here once:
a comparison against NULL is NULL, which must *pass* range and enum checks
(nullability is its own rule), so every failure predicate is wrapped in
``coalesce(p, false)``.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


# Text tokens a pandas CSV reader treats as missing (its default NA set).
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def null_tokens_to_null(col) -> Column:
    """Map missing-value tokens to SQL NULL (applied to raw CSV text at scan time)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


@dataclass(frozen=True)
class Rule:
    """``fails`` is a Column, or a zero-argument callable building one.

    The callable form lets contracts be declared at import time, before a
    SparkContext exists; the Column is built when the contract is applied.
    """
    rule_id: str
    fails: object  # Column | Callable[[], Column]; TRUE when the row violates the rule

    def predicate(self) -> Column:
        return self.fails() if callable(self.fails) and not isinstance(self.fails, Column) else self.fails

    def failure(self) -> Column:
        return F.coalesce(self.predicate(), F.lit(False))


def not_null(col: str) -> Rule:
    return Rule(f"{col}:not_null", lambda: F.col(col).isNull())


def ge(col: str, bound) -> Rule:
    return Rule(f"{col}:ge({bound})", lambda: F.col(col) < F.lit(bound))


def le(col: str, bound) -> Rule:
    return Rule(f"{col}:le({bound})", lambda: F.col(col) > F.lit(bound))


def in_range(col: str, lo, hi) -> Rule:
    return Rule(f"{col}:in_range({lo},{hi})",
                lambda: (F.col(col) < F.lit(lo)) | (F.col(col) > F.lit(hi)))


def isin(col: str, allowed: Iterable) -> Rule:
    allowed = sorted(allowed)
    return Rule(f"{col}:isin({','.join(map(str, allowed))})",
                lambda: ~F.col(col).isin(*allowed))


def is_nan_text(col) -> Column:
    """TRUE for text that a number parser reads as NaN, which stands for a missing number."""
    c = F.col(col) if isinstance(col, str) else col
    return F.lower(F.trim(c)).rlike(r"^[+-]?nan$")


def not_missing(col: str) -> Rule:
    """``not_null`` for numbers that come as text of a typed format: NaN is as missing as NULL."""
    return Rule(f"{col}:not_null", lambda: F.col(col).isNull() | is_nan_text(col))


def coerced(raw_col: str, typed_col: str, type_name: str) -> Rule:
    """Raw text was present (and not a missing-value token) but did not coerce to the type."""
    return Rule(f"{typed_col}:coerce({type_name})",
                lambda: F.col(raw_col).isNotNull() & ~F.col(raw_col).isin(*NULL_TOKENS)
                & F.col(typed_col).isNull())


def coerced_value(raw_col: str, typed_col: str, type_name: str) -> Rule:
    """``coerced`` for typed formats (JSON), which have a null of their own: only NaN is missing, ``"N/A"`` is an error."""
    return Rule(f"{typed_col}:coerce({type_name})",
                lambda: F.col(raw_col).isNotNull() & ~is_nan_text(raw_col) & F.col(typed_col).isNull())


def try_number(col, type_name: str = "double") -> Column:
    """``try_cast`` text to a number; NaN becomes NULL (NaN > x is TRUE in Spark)."""
    v = F.expr(f"try_cast(`{col}` as {type_name})") if isinstance(col, str) else col.try_cast(type_name)
    if type_name in ("double", "float"):
        return F.when(F.isnan(v), F.lit(None).cast(type_name)).otherwise(v)
    return v


def reason_column(rules: Iterable[Rule]) -> Column:
    """All failing rule ids of a row joined by ``'; '``; NULL when none fail.

    ``concat_ws`` skips NULL arguments, so each rule contributes its id only
    when its failure predicate is TRUE.
    """
    rules = list(rules)
    return F.nullif(F.concat_ws("; ", *[F.when(r.failure(), F.lit(r.rule_id)) for r in rules]), F.lit(""))


def any_failure(rules: Iterable[Rule]) -> Column:
    """TRUE when at least one rule fails: the cheap predicate used to split rows."""
    preds = [r.failure() for r in rules]
    if not preds:
        return F.lit(False)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out
