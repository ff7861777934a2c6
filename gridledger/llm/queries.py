"""Registered queries of this subpackage: one per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (collocations, decontaminate, hilbert, language, mergepath, near_dedup, packing, pii, quality, secrets, simhash, token_counts, toxicity)
from .common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities and the decision of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of 1024-token sequences."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal-data spans of every document."""
    return pii.scan(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return simhash.fingerprint_documents(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) pair with a shingle containment at the threshold or above."""
    pairs = decontaminate.containment_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", "n_shingles", "n_found", "containment")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return language.predict(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count of every document."""
    return token_counts.count_documents(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two and three words."""
    return collocations.mine(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of both tokenizers' tokens in every document."""
    return mergepath.align_documents(table(spark, sf_dir, "documents"))


def op13_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document along a Hilbert curve over language, source and size."""
    return hilbert.assign(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_toxicity, op2_secrets, op3_packing, op4_pii, op5_simhash, op6_decontamination, op7_language, op8_near_dedup,
    op9_quality, op10_token_counts, op11_collocations, op12_alignment, op13_hilbert)}

_SHINGLES_SQL = """
  SELECT {id}, CASE WHEN len(w) = 0 THEN []
                    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                    ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM (SELECT {id}, regexp_extract_all(lower(coalesce(text, '')), '(?:[A-Za-z0-9_]|[^\\x00-\\x7F])+') AS w FROM {table})"""

ORACLE_SQL: dict[str, str] = {
    "op6_decontamination": f"""
WITH d AS ({_SHINGLES_SQL.format(id="doc_id", table="documents")}),
b AS ({_SHINGLES_SQL.format(id="item_id", table="benchmark")}),
ds AS (SELECT doc_id, unnest(s) AS x FROM d),
bs AS (SELECT item_id, len(s) AS n, unnest(s) AS x FROM b),
p AS (SELECT doc_id, item_id, n, count(*) AS f FROM ds JOIN bs USING (x) GROUP BY ALL)
SELECT doc_id, item_id, CAST(n AS BIGINT) AS n_shingles, CAST(f AS BIGINT) AS n_found, f / n AS containment
FROM p WHERE f >= 0.8 * n""",
    "op11_collocations": collocations.SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
