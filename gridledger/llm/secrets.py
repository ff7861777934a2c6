"""Secret scan: fixed patterns, plus tokens that look random to a pair of character Markov models.

Base spans come from three patterns (``assign``, ``access``, ``hex``). The method adds ``random`` spans: every run of at
least ``MIN_TOKEN`` token characters is scored by two first-order character Markov models, one of random strings, one of
ordinary identifiers; a run is a secret where the log-likelihood ratio, in total and per character, is high. Both models
are trained from labelled samples: random strings are the values that the base patterns find in a bounded sample of
documents plus generated strings over the usual alphabets, ordinary ones are the sample's other words and numbers.

Defined cases: NULL text is empty; an empty text has no spans; repeated rows get the same result each; an empty table
trains on the generated strings alone. Added spans never overlap base spans and the whole text is scanned.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# The contract's patterns, in the listed order of kinds.
KINDS = {"assign": 0, "access": 1, "hex": 2, "random": 3}
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
MIN_TOKEN = 16
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
SAMPLE_DOCS = 2000             # bound of the documents that a fit reads
GENERATED = 4000
MIN_TOTAL, MIN_PER_CHAR = 8.0, 0.35

_CODE = np.full(256, len(ALPHABET), dtype=np.int64)
for _i, _c in enumerate(ALPHABET):
    _CODE[ord(_c)] = _i
SIZE = len(ALPHABET) + 1       # the last code: start of a string


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans; leftmost non-overlapping per kind, failing matches dropped."""
    out: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    # a maximal run shorter than 24 fails as a whole, so the quantifier may state the length
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def codes(token: str) -> np.ndarray:
    return _CODE[np.frombuffer(token.encode("ascii", "replace"), dtype=np.uint8)]


def pair_counts(tokens: list[str]) -> np.ndarray:
    """Transition counts of first-order chains, with a start state."""
    counts = np.zeros((SIZE, SIZE))
    for t in tokens:
        c = codes(t)
        np.add.at(counts, (np.concatenate([[SIZE - 1], c[:-1]]), c), 1)
    return counts


@dataclass
class MarkovPair:
    """Log-likelihood ratio of each transition: random strings against ordinary identifiers."""

    ratio: np.ndarray

    def score(self, token: str) -> float:
        c = codes(token)
        return float(self.ratio[np.concatenate([[SIZE - 1], c[:-1]]), c].sum())

    def is_secret(self, token: str) -> bool:
        """Random-looking, with letters and digits: words and plain numbers are never secrets."""
        if not (any(ch.isdigit() for ch in token) and any(ch.isalpha() for ch in token)):
            return False
        s = self.score(token)
        return s >= MIN_TOTAL and s >= MIN_PER_CHAR * len(token)


def train(random_counts: np.ndarray, ordinary_counts: np.ndarray) -> MarkovPair:
    def log_p(counts: np.ndarray) -> np.ndarray:
        smooth = counts + 0.5
        return np.log(smooth / smooth.sum(axis=1, keepdims=True))

    return MarkovPair(log_p(random_counts) - log_p(ordinary_counts))


def generated_tokens(n: int = GENERATED, seed: int = 7) -> tuple[list[str], list[str]]:
    """Labelled strings of both kinds: random ones over usual alphabets; numbers and joined, cased words."""
    rng = random.Random(seed)
    sets = [ALPHABET[26:36] + "0123456789", "0123456789abcdef", ALPHABET[26:62], ALPHABET[:62], ALPHABET[:64], ALPHABET[:26] + ALPHABET[52:62]]
    strings = ["".join(rng.choices(rng.choice(sets), k=rng.randint(16, 48))) for _ in range(n)]
    syllables = [a + b for a in "bcdfghlmnprstvw" for b in ("a", "e", "i", "o", "u", "an", "er", "in", "on", "es")]
    plain = []
    for _ in range(n):
        parts = ["".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(2, 5))]
        style = rng.randrange(4)
        plain.append("_".join(parts) if style == 0 else "-".join(parts) if style == 1
                     else "".join(p.title() for p in parts) if style == 2 else f"{'_'.join(parts)}_{rng.randrange(1000)}")
    return strings, plain + [str(rng.randrange(10 ** rng.randint(4, 18))) for _ in range(n // 4)]


def fit(docs: DataFrame, max_docs: int = SAMPLE_DOCS) -> MarkovPair:
    """Models from a bounded sample of documents; transition counts alone reach the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values, other = [], []
            for text in pdf["text"].fillna(""):
                spans = base_spans(text)
                values += [ASSIGN.match(text[a:b])[2] if k == "assign" else text[a:b] for k, a, b in spans]
                covered = sorted((a, b) for _, a, b in spans)
                other += [m[0] for m in re.finditer(r"[A-Za-z0-9+/_=-]{4,}", text)
                          if not any(a < m.end() and m.start() < b for a, b in covered)]
            for kind, tokens in (("random", values), ("ordinary", other)):
                c = pair_counts(tokens)
                at = np.argwhere(c > 0)
                if len(at) == 0:       # a batch without strings of a kind: an empty frame has no string column
                    continue
                yield pd.DataFrame({"kind": [kind] * len(at), "a": at[:, 0], "b": at[:, 1], "n": c[at[:, 0], at[:, 1]]})

    counts = {k: np.zeros((SIZE, SIZE)) for k in ("random", "ordinary")}
    sums = (common.sample_documents(docs, max_docs).select("text").mapInPandas(count, "kind string, a int, b int, n double")
            .groupBy("kind", "a", "b").agg(F.sum("n").alias("n")))
    for r in sums.collect():           # two matrices of SIZE x SIZE at most
        counts[r["kind"]][r["a"], r["b"]] += r["n"]
    strings, plain = generated_tokens()
    ordinary = counts["ordinary"]
    generated = pair_counts(plain)
    if ordinary.sum() > 0:             # the documents' own words weigh most
        generated *= 0.2 * ordinary.sum() / generated.sum()
    return train(counts["random"] + pair_counts(strings), ordinary + generated)


def find_spans(text: str | None, model: MarkovPair) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans and added spans of a whole text."""
    text = text or ""
    base = base_spans(text)
    added = [("random", m.start(), m.end()) for m in TOKEN.finditer(text)
             if not any(a < m.end() and m.start() < b for _, a, b in base) and model.is_secret(m[0])]
    return base, added


def scan(docs: DataFrame, model: MarkovPair | None = None) -> DataFrame:
    """One row per document: counts per base kind, the base digest, all spans and the added spans' number."""
    model = model or fit(docs)
    frame = common.id_text(docs)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                base, added = find_spans(None if pd.isna(text) else text, m)
                n = [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
                rows.append((*n, common.sha256_hex(common.span_digest(base, KINDS)),
                             common.span_digest(base + added, KINDS), len(added)))
            out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    return frame.mapInPandas(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                  "spans string, n_added long")
