"""Alignment of two tokenizers' tokens by merge-path partitioning.

Both tokenizers cut the same bytes, so their tokens' end offsets are two ascending lists. Merging the two lists walks a
path through the grid of A tokens by B tokens: every step is a pair of tokens that overlap, and a step where both ends
agree closes a group. Diagonals cut the path into pieces of equal work: a binary search on each diagonal finds where the
path crosses it, whatever lies before. A piece emits its overlaps and the groups closed in it on its own; the group that is
open at a piece's edge is stitched by its number of closed groups before.

The documents of a task are laid end to end in blocks (their last ends agree, so no group crosses documents) and a block
is cut into pieces whatever its documents' lengths: one long text is many pieces, a thousand short ones are one. Pairs are
counted once per block and document before anything is shuffled: a block sends its distinct id pairs with their document
counts, the corpus-wide counts and each A id's best come back to the block by a join on its number, and the blocks'
documents add up their links from them. Nothing is broadcast and no pair's documents meet in one task.

Defined cases: NULL and empty texts, and texts whose tokens' bytes do not spell space + text, have no tokens: zeros and an
empty digest. Rows that repeat are documents of their own. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .packing import Encoder, tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
WORK = 1 << 16                 # merge steps of a piece
BLOCK_LINKS = 1 << 21          # links of a block: it ends with the document that reaches them


# ---- the path


def crossing(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[int, int]:
    """How many ends of ``a`` and of ``b`` come first among the ``diagonal`` first of both (``a`` before ``b`` if equal)."""
    low, high = max(0, diagonal - len(b)), min(diagonal, len(a))
    while low < high:
        mid = (low + high) // 2
        if a[mid] <= b[diagonal - mid - 1]:
            low = mid + 1
        else:
            high = mid
    return low, diagonal - low


def path_pieces(a: np.ndarray, b: np.ndarray, work: int = WORK) -> list[tuple[int, int, int, int]]:
    """``(a_from, a_to, b_from, b_to)`` of the pieces: at most ``work`` ends each, found independently of one another."""
    total = len(a) + len(b)
    marks = [crossing(a, b, d) for d in range(0, total, work)] + [(len(a), len(b))]
    return [(i, k, j, m) for (i, j), (k, m) in zip(marks, marks[1:])]


@dataclass
class Overlaps:
    """Links as token numbers, and per token the number of its group."""

    a: np.ndarray
    b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    groups: int


def piece_overlaps(a: np.ndarray, b: np.ndarray, piece: tuple[int, int, int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps that end in a piece, as token numbers, and the ends at which both tokens end.

    An overlap ends where one of its tokens ends. If both do and the piece's edge parts them, the piece with A's end
    (the first of equal ends) has it.
    """
    i, k, j, m = piece
    own_a, own_b = a[i:k], b[j:m]
    left = own_b if i == 0 or not len(own_b) or own_b[0] != a[i - 1] else own_b[1:]
    ends = np.union1d(own_a, left)
    # the token that holds a position ends at it or next after it: at most one beyond the piece's own
    at_a = i + np.searchsorted(own_a, ends)
    at_b = j + np.searchsorted(own_b, ends)
    shared = ends[(at_b < len(b)) & (at_a < len(a)) & (a[np.minimum(at_a, len(a) - 1)] == ends) & (b[np.minimum(at_b, len(b) - 1)] == ends)]
    return at_a, at_b, shared


def align(a: np.ndarray, b: np.ndarray, work: int = WORK) -> Overlaps:
    """All overlaps and groups of two ascending lists of ends with the same last end."""
    links_a, links_b, group_a, group_b = [], [], np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    closed = 0
    for piece in path_pieces(a, b, work):
        i, k, j, m = piece
        at_a, at_b, shared = piece_overlaps(a, b, piece)
        links_a.append(at_a)
        links_b.append(at_b)
        # a group's number: the shared ends before the token's own; those of earlier pieces stitch it to them
        group_a[i:k] = closed + np.searchsorted(shared, a[i:k])
        # an end that A's part closed in the piece before belongs to that group
        late = np.array([], np.int64) if i == 0 or j == m or b[j] != a[i - 1] else b[j:j + 1]
        group_b[j:m] = closed + np.searchsorted(shared, b[j:m])
        if len(late):
            group_b[j] = closed - 1
        closed += len(shared)
    join = (lambda x: np.concatenate(x).astype(np.int64)) if links_a else (lambda x: np.array([], np.int64))
    return Overlaps(join(links_a), join(links_b), group_a, group_b, closed)


# ---- token bytes


class PieceBytes:
    """Encoding and token bytes of a sentencepiece model with byte fallback."""

    _loaded: dict[str, PieceBytes] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(x) for x in self.bytes], dtype=np.int64)

    @classmethod
    def of(cls, path: str) -> PieceBytes:
        """The model of a file, loaded once per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]


class ByteLevel:
    """Encoding and token bytes of a byte-level vocabulary in a ``tokenizers`` file."""

    _loaded: dict[str, ByteLevel] = {}

    def __init__(self, path: str):
        self.encoding = Encoder.of(path).encoding
        self.bytes = [b""] * self.encoding.n_vocab
        for token in self.encoding.token_byte_values():
            self.bytes[self.encoding.encode_single_token(token)] = token
        self.lengths = np.array([len(x) for x in self.bytes], dtype=np.int64)

    @classmethod
    def of(cls, path: str) -> ByteLevel:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text in which special strings are plain text."""
        return np.array(self.encoding.encode_ordinary(text), dtype=np.int64)


def tokens(text: str | None, a: ByteLevel, b: PieceBytes) -> tuple[np.ndarray, np.ndarray] | None:
    """Ids of both tokenizers, or None where the text has no tokens by the rules above."""
    if not text:
        return None
    spelled = (" " + text).encode("utf-8", "surrogatepass")
    ids_b = b.model.encode(text)
    if b"".join(map(b.bytes.__getitem__, ids_b)) != spelled:
        return None
    ids_a = a.ids(" " + text)
    if b"".join(map(a.bytes.__getitem__, ids_a.tolist())) != spelled:
        return None
    return ids_a, np.array(ids_b, dtype=np.int64)


# ---- blocks


def varints(values: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Values as little-endian base-128 numbers, and the offset after each."""
    values = values.astype(np.uint64)
    width = np.ones(len(values), np.int64)
    for n in range(1, 10):
        width += values >= np.uint64(1) << np.uint64(7 * n)
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for n in range(int(width.max()) if len(width) else 0):
        has = width > n
        more = (width[has] > n + 1).astype(np.uint8) << 7
        out[(ends - width)[has] + n] = ((values[has] >> np.uint64(7 * n)) & np.uint64(127)).astype(np.uint8) | more
    return out.tobytes(), ends


def from_varints(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.array([], np.int64)
    last = raw < 128
    starts = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.concatenate([starts, [len(raw)]])))
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts)


#: ids with the mark that follows them: ``,`` within a list, ``|`` after A's last, ``;`` after B's last
_MARKS = (",", "|", ";")
_NUMBERS: list[str] = []


def group_texts(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, last_a: np.ndarray,
                last_b: np.ndarray) -> list[str]:
    """Tokens with their marks in the order of groups, A's before B's."""
    while len(_NUMBERS) < 3 * (1 + max(int(ids_a.max()), int(ids_b.max()))):
        _NUMBERS.extend(f"{len(_NUMBERS) // 3}{m}" for m in _MARKS)
    codes = np.concatenate([3 * ids_a + last_a, 3 * ids_b + 2 * last_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    return list(map(_NUMBERS.__getitem__, codes[order].tolist()))


BLOCK_SCHEMA = ("block string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                "pairs binary, times binary, a array<int>, b array<int>, docs array<int>")


def block_rows(block: str, docs: list[tuple], work: int, size_b: int) -> pd.DataFrame:
    """A row per document with its distinct pairs (numbered within the block) and a last row with the block's pairs."""
    full = [i for i, d in enumerate(docs) if d[1] is not None]
    rows = [[block, d[0], 0, 0, 0, 0, "", b"", b"", None, None, None] for d in docs]
    if full:
        ids_a = np.concatenate([docs[i][1] for i in full])
        ids_b = np.concatenate([docs[i][2] for i in full])
        n_a = np.array([len(docs[i][1]) for i in full])
        n_b = np.array([len(docs[i][2]) for i in full])
        found = align(np.cumsum(np.concatenate([docs[i][3] for i in full])), np.cumsum(np.concatenate([docs[i][4] for i in full])), work)
        first_a, first_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        # a link's document: that of its A token
        cut = np.searchsorted(found.a, first_a)
        owner = np.repeat(np.arange(len(full)), np.diff(cut))
        pair, local = np.unique(ids_a[found.a] * size_b + ids_b[found.b], return_inverse=True)
        both, times = np.unique(owner * len(pair) + local, return_counts=True)
        who, which = both // len(pair), both % len(pair)
        bounds = np.searchsorted(who, np.arange(len(full) + 1))
        gap = np.diff(which, prepend=-1)
        gap[bounds[:-1]] = which[bounds[:-1]] + 1
        gaps, gap_ends = varints(gap - 1)
        repeats, repeat_ends = varints(times)
        edge = np.concatenate([[0], gap_ends])[bounds]
        repeat_edge = np.concatenate([[0], repeat_ends])[bounds]
        last_a = np.diff(found.group_a, append=-1) != 0
        last_b = np.diff(found.group_b, append=-1) != 0
        groups = np.concatenate([[0], found.group_a[first_a[1:] - 1] + 1])
        for k, i in enumerate(full):
            sa, sb = slice(first_a[k], first_a[k + 1]), slice(first_b[k], first_b[k + 1])
            text = "".join(group_texts(ids_a[sa], ids_b[sb], found.group_a[sa], found.group_b[sb], last_a[sa], last_b[sb]))[:-1]
            rows[i][2:9] = [int(n_a[k]), int(n_b[k]), int(groups[k + 1] - groups[k]), int(cut[k + 1] - cut[k]),
                            hashlib.sha256(text.encode()).hexdigest(), gaps[edge[k]:edge[k + 1]], repeats[repeat_edge[k]:repeat_edge[k + 1]]]
        rows.append([block, None, None, None, None, None, None, None, None, (pair // size_b).astype(np.int32),
                     (pair % size_b).astype(np.int32), np.bincount(which, minlength=len(pair)).astype(np.int32)])
    out = pd.DataFrame(rows, columns=[c.split()[0] for c in BLOCK_SCHEMA.split(", ")], dtype=object)
    return out


def blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, work: int = WORK,
           block_links: int = BLOCK_LINKS) -> DataFrame:
    """Aligned documents in blocks, as a table of the shared folder: a row per document and one per block with its pairs."""
    path_a, path_b = path_a or tokenizer_path(TOKENIZER_A), path_b or tokenizer_path(TOKENIZER_B)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b = ByteLevel.of(path_a), PieceBytes.of(path_b)
        part = TaskContext.get().partitionId()
        held, links, number = [], 0, 0
        for pdf in batches:
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"], strict=True):
                found = tokens(None if pd.isna(text) else text, a, b)
                key = None if pd.isna(doc_id) else int(doc_id)
                if found is None:
                    held.append((key, None))
                else:
                    held.append((key, *found, a.lengths[found[0]], b.lengths[found[1]]))
                    links += len(found[0]) + len(found[1])
                if links >= block_links or len(held) >= block_links // 64:
                    yield block_rows(f"{part}-{number}", held, work, len(b.bytes))
                    held, links, number = [], 0, number + 1
        if held:
            yield block_rows(f"{part}-{number}", held, work, len(b.bytes))

    return common.written(common.id_text(docs).mapInPandas(run, BLOCK_SCHEMA), "aligned-blocks")


# ---- corpus-wide counts


def pair_rows(aligned: DataFrame) -> DataFrame:
    """``block, nr, a, b, docs``: the distinct pairs of every block."""
    zipped = F.posexplode(F.arrays_zip("a", "b", "docs")).alias("nr", "p")
    return aligned.where(F.col("a").isNotNull()).select("block", zipped).select("block", "nr", "p.a", "p.b", "p.docs")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, n, best``: documents that hold the pair linked, and whether no pair of the A id is in more."""
    counted = rows.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    # an A id has at most as many pairs as B has ids
    return counted.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("a")))


def align_documents(docs: DataFrame, **options) -> DataFrame:
    """Token, group and link counts of every document, its groups' digest, and its links against the corpus-wide counts."""
    aligned = blocks(docs, **options)
    pairs = pair_rows(aligned)
    counts = common.written(pair_counts(pairs), "pair-counts")
    known = pairs.join(counts, ["a", "b"]).select(F.col("block").alias("of_block"), "nr", "n", "best")
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]
    per_doc = aligned.where(F.col("n_a").isNotNull()).select("block", *columns)

    def add_up(docs_of: pd.DataFrame, counts_of: pd.DataFrame) -> pd.DataFrame:
        n = np.zeros(len(counts_of), np.int64)
        best = np.zeros(len(counts_of), bool)
        at = counts_of["nr"].to_numpy()
        n[at], best[at] = counts_of["n"].to_numpy(), counts_of["best"].to_numpy()
        rows = []
        for pairs_of, times_of in zip(docs_of["pairs"], docs_of["times"], strict=True):
            which, times = np.cumsum(from_varints(pairs_of) + 1) - 1, from_varints(times_of)
            rows.append((int(times[best[which]].sum()), int((times * n[which]).sum())))
        out = docs_of[columns[:-2]].copy()
        out["doc_id"] = docs_of["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None)
        out["n_best"], out["count_sum"] = [r[0] for r in rows], [r[1] for r in rows]
        return out

    out_schema = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    # a block is bounded by its links: both sides of a group are
    done = per_doc.groupBy("block").cogroup(known.groupBy("of_block")).applyInPandas(add_up, out_schema)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
