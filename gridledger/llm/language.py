"""Language by cross-parsing: how few phrases of a language's labelled text does a document need?

Per language, a suffix automaton of a bounded sample of labelled text knows every substring of it. A document is parsed
greedily: each phrase is the longest match from where the last one ended. Phrases per character estimate the
cross-entropy to that language; the language with the fewest wins. All languages and many text segments are parsed at
once, as lanes that take one step of their automaton per character in numpy. A long text is parsed in segments of
``SEGMENT`` characters, all of them, which adds at most one phrase per segment in every language alike.

Characters are lower-cased and mapped to a small alphabet: the sample's most frequent letters, one separator for all
that is no letter, and one code for other letters, which no automaton can match.

Defined cases: NULL text, and text without a letter, is ``und`` with score 0; ties go to the alphabetically first
language; without labelled text everything is ``und``; repeated rows get the same result each; rows with a NULL id are
scored, but never learned from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

LETTER = re.compile(r"[^\W\d_]")
SAMPLE_CHARS = 24_000          # bound of the labelled text per language
SAMPLE_DOCS = 60               # bound of the labelled documents per language
LETTERS = 61                   # letters that the alphabet keeps
SEGMENT = 2048
LANES = 2048
SHARPNESS = 12.0
UNKNOWN, SEPARATOR = 0, 1


class SuffixAutomaton:
    """Automaton of all substrings of a code sequence, as a dense transition table (state 0: dead, 1: start)."""

    def __init__(self, codes: np.ndarray, alphabet: int):
        link, length, moves = [0, 0], [0, 0], [{}, {}]
        last = 1
        for c in codes.tolist():
            cur = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p and c not in moves[p]:
                moves[p][c] = cur
                p = link[p]
            if not p:
                link[cur] = 1
            else:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[cur] = copy
            last = cur
        self.table = np.zeros((len(moves), alphabet), dtype=np.int32)
        for state, out in enumerate(moves):
            for c, to in out.items():
                self.table[state, c] = to
        self.table[:, UNKNOWN] = 0


class CrossParser:
    """Automata of several languages over one alphabet."""

    _built: dict[str, CrossParser] = {}

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        counts = Counter(c for t in samples.values() for c in t.lower() if LETTER.match(c))
        self.codes = {c: i + 2 for i, (c, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:LETTERS])}
        self.alphabet = len(self.codes) + 2
        self._points = np.zeros(0x110000, dtype=np.uint8)
        for c, i in self.codes.items():
            self._points[ord(c)] = i
        self._known = np.zeros(0x110000, dtype=bool)
        tables, self.starts, size = [], [], 0
        for name in self.languages:
            t = SuffixAutomaton(self.encode(samples[name]), self.alphabet).table
            tables.append(np.where(t > 0, t + size, 0))
            self.starts.append(size + 1)
            size += len(t)
        # one table for all languages; state * alphabet + code is the place of a move, states are stored multiplied
        self.moves = (np.vstack(tables).astype(np.int64) * self.alphabet).ravel().astype(np.int32) if tables else np.zeros(0, np.int32)

    @classmethod
    def of(cls, samples: dict[str, str]) -> CrossParser:
        """Built once per Python worker and sample."""
        key = common.sha256_hex(repr(sorted(samples.items())))
        if key not in cls._built:
            cls._built.clear()
            cls._built[key] = cls(samples)
        return cls._built[key]

    def encode(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        new = np.unique(points[~self._known[points]])
        for p in new.tolist():          # each code point is classified once
            if not self._points[p] and not LETTER.match(chr(p)):
                self._points[p] = SEPARATOR
            self._known[p] = True
        return self._points[points]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of phrases of every text in every language."""
        out = np.zeros((len(texts), len(self.languages)))
        segments = []
        for i, t in enumerate(texts):
            codes = self.encode(t)
            segments += [(i, codes[a:a + SEGMENT]) for a in range(0, len(codes), SEGMENT)]
        segments.sort(key=lambda s: -len(s[1]))
        for k in range(0, len(segments), LANES):
            part = segments[k:k + LANES]
            owner = np.array([i for i, _ in part])
            np.add.at(out, owner, self._parse([c for _, c in part]))
        return out

    def _parse(self, codes: list[np.ndarray]) -> np.ndarray:
        """Phrases per segment and language; segments come longest first."""
        n, most = len(codes), len(codes[0])
        size = np.array([len(c) for c in codes])
        grid = np.zeros((most, n), dtype=np.int32)
        grid.T[np.arange(most)[None, :] < size[:, None]] = np.concatenate(codes)
        alive = np.searchsorted(-size, -np.arange(most), side="left")     # lanes longer than t
        counts = np.zeros((n, len(self.languages)), dtype=np.int32)
        for j, start in enumerate(self.starts):
            root = np.int32(start * self.alphabet)
            state = np.full(n, root, dtype=np.int32)
            count = np.zeros(n, dtype=np.int32)
            for t in range(most):
                m = alive[t]
                code = grid[t, :m]
                to = self.moves[state[:m] + code]
                ended = np.flatnonzero(to == 0)
                if len(ended):
                    again = self.moves[root + code[ended]]
                    # an open phrase ends here; a character that no phrase can hold is one of its own
                    count[ended] += (state[ended] != root) + (again == 0).astype(np.int32)
                    to[ended] = np.where(again == 0, root, again)
                state[:m] = to
            counts[:, j] = np.maximum(count + (state != root), 1)
        return counts

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Winning language and its score (the share of its weight, from normalised phrase counts)."""
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        at = [i for i, t in enumerate(texts) if t and LETTER.search(t)]
        if not self.languages or not at:
            return out
        counts = self.phrases([texts[i] for i in at])
        best = counts.argmin(axis=1)
        weight = (counts.min(axis=1, keepdims=True) / counts) ** SHARPNESS
        for i, b, w in zip(at, best, weight, strict=True):
            out[i] = (self.languages[b], float(w[b] / w.sum()))
        return out


def samples(docs: DataFrame, modulus: int = 4, remainder: int = 2, max_docs: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text per language from documents outside the held-out fold: whole texts, by a hash of the id, up to a bound.

    The ids are ranked without their texts; text is read for the chosen ones alone and cut at the bound of the sample.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"))
    usable = rows.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~common.held_out(F.col("doc_id"), modulus, remainder))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = usable.distinct().withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= max_docs)
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                         F.substring(F.col("text").cast("string"), 1, max_chars).alias("text"))
             .join(F.broadcast(chosen), ["doc_id", "lang"]).where(F.col("text").isNotNull()))
    out: dict[str, str] = {}
    for r in texts.orderBy("lang", "rank", "text").toLocalIterator():
        got = out.get(r["lang"], "")
        if len(got) < max_chars:
            out[r["lang"]] = (got + "\n" + r["text"])[:max_chars]
    return out


def predict(docs: DataFrame, learned: dict[str, str] | None = None, modulus: int = 4, remainder: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document; learned from the documents outside the fold."""
    learned = samples(docs, modulus, remainder) if learned is None else learned
    frame = common.id_text(docs)
    shared = frame.sparkSession.sparkContext.broadcast(learned)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = CrossParser.of(shared.value)
        for texts in batches:
            whole = [None if pd.isna(t) else t for t in texts]
            rows = [r for i in range(0, len(whole), 1024) for r in parser.predict(whole[i:i + 1024])]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return frame.select("doc_id", common.held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), run("text").alias("p")) \
                .select("doc_id", "held_out", "p.lang_pred", "p.score")
