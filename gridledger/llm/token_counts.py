"""Token counts by prefix dynamic programming: the exact count at every prefix, so that budgets need no second encoding.

For byte-pair encoding, the tokens of a prefix end in the one vocabulary piece that (a) is a suffix of the prefix and
(b) stays as it is when encoded together with the last token of what comes before it. So, from left to right, each
position needs only the last token of every earlier prefix: ``count[i] = count[i - len(piece)] + 1``. Characters outside
the vocabulary stand alone and cost their UTF-8 bytes. An Aho-Corasick automaton lists the pieces that end at a position.
No piece holds a space after another character, or a letter next to another kind of character (checked when a model is
loaded), so the recurrence restarts there, and the arrays of such units are shared by all texts through a bounded cache.
A document's prefix counts are its units' arrays on top of the sums before them.

Counts are those of the sentencepiece model (a space put in front, spaces as ``▁``, nothing else normalised); a model
with another normaliser, unit rule or kind is refused.

Defined cases: NULL text is empty; an empty text has no tokens; repeated rows get the same result each; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CACHE_UNITS = 500_000
CACHED_LENGTH = 40             # longer units are computed each time
CACHED_PAIRS = 1_000_000
SPACE = "▁"
OTHER = -1                     # last "token" of a prefix that ends in a character outside the vocabulary


class PrefixCounter:
    """Prefix token counts of one sentencepiece byte-pair model."""

    _loaded: dict[str, PrefixCounter] = {}

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(self.model.get_piece_size())
               if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        self.names = {i: self.model.id_to_piece(i) for i in ids}
        self.rank = {self.names[i]: -self.model.get_score(i) for i in ids}      # lower ranks merge first
        if any(re.search("[^▁]▁", p) for p in self.rank) or "".join(self.model.encode("ﬁ  x ", out_type=str)) != "▁ﬁ▁▁x▁":
            raise ValueError("the model normalises text or joins pieces across spaces")
        # pieces that are tokens at all: a piece's own text must encode to it
        self.pieces = {p: i for i, p in self.names.items() if self.merged(p) == [p]}
        self.suffixes = ahocorasick.Automaton()
        for p, i in self.pieces.items():
            self.suffixes.add_word(p, (i, len(p)))
        self.suffixes.make_automaton()
        self.unit = self._unit_pattern()
        self.pairs: dict[int, bool] = {}
        self.units: dict[str, bytes | list[int]] = {}

    def _unit_pattern(self) -> re.Pattern:
        """Units: leading spaces with letters, or with other characters; without the split by kind if a piece mixes them."""
        letters = {c for p in self.rank for c in p if c.isalpha()}
        if any((a in letters) != (b in letters) and a != SPACE for p in self.rank for a, b in zip(p, p[1:], strict=False)):
            return re.compile(r"▁*[^▁]+|▁+")
        group = "".join(map(re.escape, sorted(letters)))
        return re.compile(f"▁*[{group}]+|▁*[^▁{group}]+|▁+")

    @classmethod
    def of(cls, path: str) -> PrefixCounter:
        """Loaded once per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def merged(self, symbols: str) -> list[str]:
        """Byte-pair merges of a short string, by piece rank and then from the left."""
        parts, rank = list(symbols), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stays(self, left: int, right: int) -> bool:
        """Whether two adjacent tokens are what their joined text encodes to."""
        key = left << 32 | right
        got = self.pairs.get(key)
        if got is None:
            got = self.merged(self.names[left] + self.names[right]) == [self.names[left], self.names[right]]
            if len(self.pairs) < CACHED_PAIRS:
                self.pairs[key] = got
        return got

    def unit_counts(self, unit: str) -> bytes | list[int]:
        """Token count of every prefix of a unit, from one character to all."""
        got = self.units.get(unit)
        if got is not None:
            return got
        pairs, n = self.pairs, len(unit)
        counts, last, settled = [0] * (n + 1), [OTHER] * (n + 1), 0
        for end, (piece, size) in self.suffixes.iter(unit):
            end += 1
            if end == settled:
                continue
            while settled < end - 1:            # characters that end no piece
                counts[settled + 1] = counts[settled] + len(unit[settled].encode("utf-8", "surrogatepass"))
                settled += 1
            before = last[end - size]
            if before != OTHER:
                valid = pairs.get(before << 32 | piece)
                if not (self.stays(before, piece) if valid is None else valid):
                    continue
            counts[end], last[end], settled = counts[end - size] + 1, piece, end
        while settled < n:
            counts[settled + 1] = counts[settled] + len(unit[settled].encode("utf-8", "surrogatepass"))
            settled += 1
        del counts[0]
        if n <= CACHED_LENGTH and len(self.units) < CACHE_UNITS:
            self.units[unit] = bytes(counts) if counts[-1] < 256 else counts
        return counts

    def split(self, text: str) -> list[str]:
        return self.unit.findall((SPACE + text).replace(" ", SPACE)) if text else []

    def count(self, text: str) -> int:
        return sum([self.unit_counts(u)[-1] for u in self.split(text)])

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact token count of ``text[:i]`` for every i from 0 to its length."""
        parts, base = [np.zeros(0, dtype=np.int64)], 0
        for u in self.split(text):
            c = self.unit_counts(u)
            parts.append(base + np.array(list(c), dtype=np.int64))
            base += c[-1]
        out = np.concatenate(parts)
        if len(out):
            out[0] = 0                 # the space put in front of an empty prefix is no token
        else:
            out = np.zeros(1, dtype=np.int64)
        return out

    def fits(self, text: str, budget: int) -> int:
        """Length of the longest prefix with at most ``budget`` tokens."""
        counts = self.prefix_counts(text)
        return int(np.flatnonzero(counts <= budget)[-1])


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def unit_table(counter: PrefixCounter, text: str) -> tuple[list[int], list[int]]:
    """Character ends of a text's units and the exact counts there: the stored form of the prefix counts."""
    ends, counts, at, total = [], [], -1, 0
    for u in counter.split(text):
        at, total = at + len(u), total + counter.unit_counts(u)[-1]
        ends.append(at)
        counts.append(total)
    return ends, counts


def count_documents(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` and ``fit_chars``, the longest prefix within the limit, per document."""
    path = path or model_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PrefixCounter.of(path)
        for pdf in batches:
            rows = []
            for text in pdf["text"].fillna(""):
                total, chars, fit = 0, -1, -1
                for u in counter.split(text):
                    c = counter.unit_counts(u)
                    if fit < 0 and total + c[-1] > limit:
                        fit = chars + max((i + 1 for i, n in enumerate(c) if total + n <= limit), default=0)
                    total, chars = total + c[-1], chars + len(u)
                rows.append((len(text.encode("utf-8", "surrogatepass")), total, total > limit, len(text) if fit < 0 else max(fit, 0)))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_tokens", "over_limit", "fit_chars"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    return common.id_text(docs).mapInPandas(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def prefix_tables(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ends, counts``: the stored prefix counts at every unit's end, one row per document."""
    path = path or model_path()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = PrefixCounter.of(path)
        for pdf in batches:
            tables = [unit_table(counter, t) for t in pdf["text"].fillna("")]
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None),
                                "ends": [t[0] for t in tables], "counts": [t[1] for t in tables]})

    return common.id_text(docs).mapInPandas(run, "doc_id long, ends array<long>, counts array<long>")


def tokens_within(tables: DataFrame, budgets: list[int]) -> DataFrame:
    """Per document and budget, the last unit end with at most that many tokens (0: not even the first unit)."""
    asked = [F.struct(F.lit(b).cast("long").alias("budget"),
                      F.coalesce(F.element_at("ends", F.nullif(F.size(F.filter("counts", lambda c, b=b: c <= b)), F.lit(0))), F.lit(0)).alias("chars"))
             for b in budgets]
    return tables.select("doc_id", F.inline(F.array(*asked)))
