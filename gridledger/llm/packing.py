"""Best-fit packing by minimum bin slack over the histogram of piece lengths.

A document's ids are cut only if they exceed the sequence length: its first piece takes the remainder, all others are
full sequences. Lengths lie between 1 and the sequence length, so the multiset of all pieces is a histogram of at most
that many counts, whatever the number of documents. Per bin, a subset-sum dynamic program over a bitset finds the
fullest feasible combination of the available lengths (the largest lengths among equally full ones); it is removed as
often as the counts allow, which is one bin or a million bins with the same combination. Plans are made in several ways
and the one with the fewest bins is kept: with the largest length left fixed in each bin (so that none is left without
fillers at the end), with a few tokens of slack allowed where that takes fewer pieces, and without either. The plan (a few thousand runs of
equal bins, bounded by the sequence length alone) is then joined back: the pieces of each length are numbered by hash
buckets and counts, never by one task per length, and the r-th piece of a length takes the r-th slot of that length.

Defined cases: NULL and empty texts hold the end token alone; repeated rows are pieces of their own (told apart by their
number within equal rows); an empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

LENGTH = 1024
END_ID = 2
TOKENIZER = "byte_bpe_50k.json"
BUCKET_ROWS = 2_000           # pieces per numbering bucket, on average


class Encoder:
    """Ids of the byte-level vocabulary in a ``tokenizers`` file.

    The vocabulary is read from the file; encoding goes through tiktoken, which gives the same ids several times faster
    (tested against the tokenizers library). Special strings inside a text become their special ids, as there.
    """

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]      # bytes written as themselves
        hidden = [b for b in range(256) if b not in set(visible)]
        to_byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(to_byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encoding = tiktoken.Encoding("pieces", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The encoder of a file, loaded once per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def ids(self, text: str) -> bytes:
        """Little-endian uint32 ids of a whole text."""
        return self.encoding.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = Encoder.of(path), np.array([end_id], dtype="<u4").tobytes()
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                ids = encoder.ids("" if pd.isna(text) else text) + end
                at, n = 0, len(ids) // 4
                size = n % length or length
                for piece in range(-(-n // length)):
                    rows.append((None if pd.isna(doc_id) else int(doc_id), piece, at, size, zlib.crc32(ids[4 * at:4 * (at + size)])))
                    at, size = at + size, length
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"]).astype({"doc_id": object})

    return common.id_text(docs).mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- the plan


@dataclass
class Plan:
    """Slots as arrays sorted by (length, first rank): ranks first .. first+count-1 of a length go to consecutive bins."""

    length: np.ndarray
    first: np.ndarray
    bin: np.ndarray
    offset: np.ndarray
    bins: int


SLACKS = (0, 1, 2, 4, 8)      # tokens that a bin may be less full than it could be, if that takes fewer pieces


def fullest(lengths: list[int], counts: dict[int, int], capacity: int, slack: int = 0) -> list[tuple[int, int]]:
    """The fullest combination of available lengths as (length, times), larger lengths preferred among equals.

    ``lengths`` ascends. A bitset holds the reachable sums; it is kept after every length, so that the combination can be
    read back from the largest length down. With ``slack``, the one with the fewest pieces among the sums that are short
    of the fullest by ``slack`` at most.
    """
    layers, sums = [], 1
    mask = (1 << (capacity + 1)) - 1
    for length in lengths:
        layers.append(sums)
        left, step = min(counts[length], capacity // length), 1
        while left > 0:                 # multiplicities by binary splitting
            take = min(step, left)
            sums |= (sums << (take * length)) & mask
            left, step = left - take, 2 * step

    def read_back(total: int) -> list[tuple[int, int]]:
        out = []
        for length, below in zip(reversed(lengths), reversed(layers), strict=True):
            most = min(counts[length], total // length)
            times = next(t for t in range(most, -1, -1) if below >> (total - t * length) & 1)
            if times:
                out.append((length, times))
                total -= times * length
        return out

    best = sums.bit_length() - 1
    sets = [read_back(total) for total in range(best, max(0, best - slack) - 1, -1) if sums >> total & 1]
    return min(sets, key=lambda c: sum(times for _, times in c))


def plan_runs(histogram: dict[int, int], capacity: int, seeded: bool, slack: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations and how many bins have each; ``seeded`` fixes the largest length left in every bin."""
    counts = {k: v for k, v in histogram.items() if v > 0}
    runs = []
    while counts:
        combination = []
        if seeded:
            seed = max(counts)
            rest = {**counts, seed: counts[seed] - 1}
            fitting = [k for k in sorted(rest) if rest[k] and k <= capacity - seed]
            fill = dict(fullest(fitting, rest, capacity - seed, slack)) if fitting else {}
            combination = [(seed, 1 + fill.pop(seed, 0)), *fill.items()]
        else:
            combination = fullest(sorted(counts), counts, capacity, slack)
        repeat = min(counts[length] // times for length, times in combination)
        for length, times in combination:
            counts[length] -= times * repeat
            if not counts[length]:
                del counts[length]
        runs.append((combination, repeat))
    return runs


def plan_bins(histogram: dict[int, int], capacity: int = LENGTH) -> Plan:
    """Minimum bin slack over a histogram; equal bins are made in one step, as many as the counts allow.

    The work depends on the number of lengths, not of pieces. No further plan is made once one has as few bins as all
    tokens fill.
    """
    least = -(-sum(k * v for k, v in histogram.items()) // capacity)
    runs: list[tuple[list[tuple[int, int]], int]] = []
    for n, (seeded, slack) in enumerate([*((True, s) for s in SLACKS), (False, 0)]):
        found = plan_runs(histogram, capacity, seeded, slack)
        if n == 0 or sum(r for _, r in found) < sum(r for _, r in runs):
            runs = found
        if sum(r for _, r in runs) <= least:
            break
    used = dict.fromkeys(histogram, 0)
    slots: list[tuple[int, int, int, int]] = []
    bins = 0
    for combination, repeat in runs:
        offset = 0
        for length, times in combination:
            for _ in range(times):
                slots.append((length, used[length], bins, offset))
                used[length] += repeat
                offset += length
        bins += repeat
    slots.sort()
    columns = np.array(slots, dtype=np.int64).reshape(-1, 4).T
    return Plan(*columns, bins=bins)


def numbered(frame: DataFrame, buckets: int) -> DataFrame:
    """Adds ``rank``: 0, 1, 2 ... within each length, in hash buckets with offsets from an aggregate of the buckets."""
    keyed = frame.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)).cast("int"))
    sizes = keyed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("skip", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("inner", F.row_number().over(inside) - 1)
    return ranked.join(offsets, ["length", "bucket"]).withColumn("rank", F.col("skip") + F.col("inner")).drop("bucket", "skip", "inner")


def pack(docs: DataFrame, length: int = LENGTH, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece, with ``sequence_id`` and the gapless ``offset`` there."""
    table = common.written(pieces(docs, length, end_id, path), "pieces")
    histogram = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = plan_bins(histogram, length)
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    buckets = max(1, sum(histogram.values()) // BUCKET_ROWS)
    return place(numbered(table, buckets), shared)


def place(ranked: DataFrame, plan: object) -> DataFrame:
    """Slots of numbered pieces, looked up in the plan by (length, rank)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p: Plan = plan.value
        big = int(p.first.max(initial=0)) + 1
        keys = p.length * big + p.first if p.length.max(initial=0) < 2**62 // big else None
        for pdf in batches:
            length, rank = pdf["length"].to_numpy(np.int64), pdf["rank"].to_numpy(np.int64)
            if keys is None:
                raise OverflowError("more than 2**62 / length pieces")
            at = np.searchsorted(keys, length * big + np.minimum(rank, big - 1), side="right") - 1
            yield pdf.assign(sequence_id=p.bin[at] + rank - p.first[at], offset=p.offset[at])[
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInPandas(run, schema)
