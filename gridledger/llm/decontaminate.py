"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Items and documents are sets of five-word shingles. Under a random order of all shingles, an item's minimum lies in a
document with a probability equal to the item's containment in it, however long the document is; so an item keeps the
minima of several orders, and a document looks them up among all of its shingles. Items are partitioned by size (powers
of two): each partition has its own number of orders, more for larger items, and a document becomes a candidate of an
item at a number of its minima that a containment at the threshold misses with a probability below ``MISS``.

A document is read once. A bitmap of fixed size over all minima's hashes decides which of its shingles may be minima;
documents with too few are done (the bitmap only errs towards keeping). The kept hits are joined to the minima by hash,
counted per (document, item), and candidates are verified on the words themselves: the share of the item's distinct
shingles that occur in the whole document must reach the threshold.

Defined cases: NULL and empty texts are in nothing; an item of fewer than five words is one shingle of all its words and
only found in documents equal to it up to case and punctuation; repeated documents and items give a pair each (per row);
items without words match nothing; NULL ids are kept in pairs; an empty table on either side gives no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import MULTIPLIER, mix, shingle_hashes, text_hashes, words

SHINGLE = 5
CONTAINMENT = 0.8
MISS = 1e-6
BITMAP_BITS = 26               # 8 MB, whatever the number of items


def minima(shingles: np.ndarray, permutations: int) -> np.ndarray:
    """Distinct shingle hashes that are the minimum of some of the orders; an order is a salted mix of the hash."""
    distinct = np.unique(shingles)
    if not len(distinct):
        return distinct
    salts = mix(np.arange(1, permutations + 1, dtype=np.uint64) * np.uint64(MULTIPLIER))
    return np.unique(distinct[[int(np.argmin(mix(distinct ^ s))) for s in salts]])


def size_partition(n_shingles: int) -> int:
    """Items of 2**p to 2**(p+1)-1 distinct shingles share partition p."""
    return max(0, n_shingles.bit_length() - 1)


def permutations_of(partition: int) -> int:
    """Orders for items of a size partition: enough to hold half of a small item, 64 at most."""
    return min(64, max(16, 8 * (partition + 1)))


def needed(n_minima: int, threshold: float = CONTAINMENT, miss: float = MISS) -> int:
    """Minima (of an item with ``n_minima`` distinct ones) that a document must hold to be a candidate.

    Distinct minima are a random subset of the item's shingles; the binomial bound is above the exact hypergeometric tail.
    """
    tail, count = 0.0, 0
    while count < n_minima:
        tail += comb(n_minima, count) * threshold**count * (1 - threshold) ** (n_minima - count)
        if tail > miss:
            break
        count += 1
    return max(1, count)


def contained(item_words: list[str], doc_words: list[str], size: int = SHINGLE) -> tuple[int, int]:
    """Distinct shingles of the item, and how many of them occur in the document; on the words themselves."""
    cut = lambda w: {tuple(w[i:i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    item = cut(item_words)
    return len(item), len(item & cut(doc_words))


def item_minima(items: DataFrame, key: str = "item_id", threshold: float = CONTAINMENT) -> DataFrame:
    """``item, item_key, n_shingles, partition, n_needed, minimum``: one row per distinct minimum of every item."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for item_key, text in zip(pdf["item_key"], pdf["text"].fillna(""), strict=True):
                s = shingle_hashes(text_hashes(text), SHINGLE)
                partition = size_partition(len(np.unique(s)))
                m = minima(s, permutations_of(partition))
                rows += [(item_key, partition, needed(len(m), threshold), int(v)) for v in m.view(np.int64)]
            yield pd.DataFrame(rows, columns=["item_key", "partition", "n_needed", "minimum"])

    return items.select("item_key", "text").mapInPandas(run, "item_key string, partition int, n_needed int, minimum long")


def row_key(*columns: Column) -> Column:
    """Tells different rows apart, equal rows together."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(c.cast("string"), F.lit("\x1e")) for c in columns]), 256)


def bitmap_of(sketches: DataFrame) -> np.ndarray:
    """Bits of the minima's top hash bits; at most ``2**BITMAP_BITS`` positions, gathered as one number per used word."""
    positions = sketches.select(F.shiftrightunsigned("minimum", 64 - BITMAP_BITS).alias("p"))
    words64 = (positions.groupBy(F.shiftright("p", 6).alias("w"))
               .agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("b")).toPandas())
    bits = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    bits[words64["w"].to_numpy(np.int64)] = words64["b"].to_numpy(np.int64).view(np.uint64)
    return bits


def containment_pairs(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT, item_id: str = "item_id") -> DataFrame:
    """``doc_id, text_sha256, item_id, n_shingles, n_found, containment`` of every pair at or above the threshold."""
    frame = common.id_text(docs)
    spark = frame.sparkSession
    benchmark = common.cut_lineage(items.select(F.col(item_id).alias("item_id"), F.col("text").cast("string").alias("text"))
                                   .withColumn("item_key", row_key(F.col("item_id"), F.col("text"))))
    sketches = common.cut_lineage(item_minima(benchmark.select("item_key", "text").distinct(), threshold=threshold))
    least = sketches.agg(F.min("n_needed")).first()[0]
    schema = "doc_key string, doc_id long, text string, hits array<long>"
    if least is None:
        hits = spark.createDataFrame([], schema)
    else:
        bitmap = spark.sparkContext.broadcast(bitmap_of(sketches))
        hits = common.written(frame.mapInPandas(_hits(bitmap, least), "doc_id long, text string, hits array<long>")
                              .withColumn("doc_key", row_key(F.col("doc_id"), F.col("text")))
                              .select("doc_key", "doc_id", "text", "hits"), "hits")
    found = hits.select("doc_key", F.explode("hits").alias("minimum")).distinct()
    candidates = (found.join(sketches, "minimum").groupBy("doc_key", "item_key", "n_needed").agg(F.count("*").alias("n"))
                  .where("n >= n_needed").select("doc_key", "item_key"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [contained(words(i), words(d)) for i, d in zip(pdf["item_text"], pdf["text"], strict=True)]
            yield pdf[["doc_key", "item_key"]].assign(n_shingles=[r[0] for r in rows], n_found=[r[1] for r in rows])

    texts = hits.select("doc_key", "text").dropDuplicates(["doc_key"])
    item_texts = benchmark.select("item_key", F.col("text").alias("item_text")).dropDuplicates(["item_key"])
    verified = (candidates.join(texts, "doc_key").join(item_texts, "item_key")
                .mapInPandas(verify, "doc_key string, item_key string, n_shingles long, n_found long")
                .where(F.col("n_found") >= threshold * F.col("n_shingles")))
    # one row per pair of given rows: repeated documents and items come back here
    return (verified.join(hits.select("doc_key", "doc_id", F.sha2("text", 256).alias("text_sha256")), "doc_key")
            .join(benchmark.select("item_key", "item_id"), "item_key")
            .select("doc_id", "text_sha256", "item_id", "n_shingles", "n_found", (F.col("n_found") / F.col("n_shingles")).alias("containment")))


def _hits(bitmap: object, least: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = bitmap.value
        for pdf in batches:
            keep, hits = [], []
            for i, text in enumerate(pdf["text"]):
                s = shingle_hashes(text_hashes(None if pd.isna(text) else text), SHINGLE)
                top = s >> np.uint64(64 - BITMAP_BITS)
                may = s[(bits[top >> np.uint64(6)] >> (top & np.uint64(63)) & np.uint64(1)).astype(bool)]
                if len(may) >= least:
                    may = np.unique(may)
                    if len(may) >= least:
                        keep.append(i)
                        hits.append(may.view(np.int64))
            out = pdf.iloc[keep].copy()
            out["doc_id"] = out["doc_id"].astype("Int64").astype(object).where(out["doc_id"].notna(), None)
            yield out.assign(hits=pd.Series(hits, index=out.index, dtype=object))

    return run


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = CONTAINMENT) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    bad = containment_pairs(docs, items, threshold).select(F.col("doc_id").alias("__bad_id"), F.col("text_sha256").alias("__bad_text")).distinct()
    here = docs["doc_id"].cast("long").eqNullSafe(F.col("__bad_id")) & (F.sha2(docs["text"].cast("string"), 256) == F.col("__bad_text"))
    return docs.join(bad, here, "left_anti")
