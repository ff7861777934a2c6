"""Personal data: fixed patterns, plus spans from a character-level BiLSTM-CRF trained on labelled spans.

Base spans are email, ip, card and phone by pattern. The tagger reads windows of ``WINDOW`` characters that overlap by
half and cover the whole text. All four kinds need a digit or an ``@``, so a window without either can only hold the
outside label and is not run. Windows are decoded one by one; their spans are then reconciled over the whole text: spans
of one kind that overlap or touch are joined, other overlaps are won by the span that lies farther from its window's
edge. A reconciled span is added if it overlaps no base span, ends at word boundaries and has its kind's evidence.

The labelled spans for training are base spans in a bounded sample of documents, with further windows around other
digits and ``@`` as negatives, and a fixed number of generated windows, so that small tables train as well.

Defined cases: NULL text is empty; an empty text has no spans; repeated rows get the same result each; an empty table
trains on the generated windows alone.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .bilstm_crf import Tagger

# The contract's patterns, in the listed order of kinds.
KINDS = {"email": 0, "ip": 1, "card": 2, "phone": 3}
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# a leftmost match of these can only begin where a run of digits begins
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SIGN = re.compile(r"[0-9@]")

WINDOW, OVERLAP = 64, 32
LABELS = 1 + 2 * len(KINDS)    # outside; begin and inside of each kind
SAMPLE_DOCS = 3000             # bounds of a fit
MAX_WINDOWS = 900
GENERATED = 300
HIDDEN = 20
# What an added span's text must show: the same checks as a base span's, on the part that the tagger marked.
EVIDENCE = {"email": lambda s: "@" in s and "." in s.partition("@")[2],
            "ip": lambda s: s.count(".") == 3 and all(p.isdecimal() and _small(p) for p in s.split(".")),
            "card": lambda s: 14 <= len(_digits(s)) <= 19 and luhn(_digits(s)),
            "phone": lambda s: 9 <= len(_digits(s)) <= 15 and not s[0].isalpha()}

_PUNCTUATION = "@._%+-() \n\t,:;|\"'#/"
_CLASS = np.full(128, 4, dtype=np.int64)
_CLASS[[ord(c) for c in "0123456789"]] = 1
_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 2
_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 3
for _i, _c in enumerate(_PUNCTUATION):
    _CLASS[ord(_c)] = 5 + _i
CLASSES = 6 + len(_PUNCTUATION)      # 0: beyond the text; the last: non-ASCII


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[str, int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text[start - 1]):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield "email", start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans; leftmost non-overlapping per kind, failing matches dropped without a retry."""
    if not SIGN.search(text):
        return []
    out = list(_emails(text))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(_small(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def classes(text: str) -> np.ndarray:
    """Class of every character, padded to one window at least."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    out = np.zeros(max(WINDOW, len(points)), dtype=np.int64)
    out[:len(points)] = np.where(points < 128, _CLASS[np.minimum(points, 127)], CLASSES - 1)
    return out


def labels(n: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    for kind, a, b in sorted(spans, key=lambda s: -KINDS[s[0]]):
        out[a:b] = 2 + 2 * KINDS[kind]
        out[a] = 1 + 2 * KINDS[kind]
    return out


def window_starts(text: str) -> list[int]:
    """Starts of the overlapping windows that hold a digit or an ``@``."""
    step, last = WINDOW - OVERLAP, max(0, len(text) - WINDOW)
    found: set[int] = set()
    for m in SIGN.finditer(text):
        first = max(0, (m.start() - WINDOW) // step + 1) * step
        found.update(min(s, last) for s in range(first, m.start() + 1, step))
    return sorted(found)


def reconcile(found: list[tuple[str, int, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of all windows, with their distance from the window's edge, to one set of disjoint spans."""
    joined: list[list] = []
    for kind, a, b, margin in sorted(found, key=lambda s: (s[0], s[1], s[2])):
        if joined and joined[-1][0] == kind and a <= joined[-1][2]:
            joined[-1][2] = max(b, joined[-1][2])
            joined[-1][3] = max(margin, joined[-1][3])
        else:
            joined.append([kind, a, b, margin])
    out: list[tuple[str, int, int]] = []
    for kind, a, b, _ in sorted(joined, key=lambda s: (-s[3], s[1], KINDS[s[0]])):
        if not any(x < b and a < y for _, x, y in out):
            out.append((kind, a, b))
    return sorted(out, key=lambda s: s[1])


def _spans_of(row: np.ndarray, start: int) -> Iterator[tuple[str, int, int, int]]:
    names, i = list(KINDS), 0
    while i < len(row):
        if row[i] == 0:
            i += 1
            continue
        kind, j = (row[i] - 1) // 2, i + 1
        while j < len(row) and row[j] == 2 + 2 * kind:
            j += 1
        yield names[kind], start + i, start + j, min(i, len(row) - j)
        i = j


def find_spans_many(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """Base and added spans of whole texts; the windows of all texts are decoded in shared batches."""
    base = [base_spans(t) for t in texts]
    found: list[list] = [[] for _ in texts]
    jobs = [(i, s) for i, t in enumerate(texts) for s in window_starts(t)]
    coded: dict[int, np.ndarray] = {}
    for k in range(0, len(jobs), 256):
        part = jobs[k:k + 256]
        for i in {i for i, _ in part}:
            if i not in coded:
                coded = {j: c for j, c in coded.items() if j >= part[0][0]}
                coded[i] = classes(texts[i])
        decoded = tagger.decode(np.stack([coded[i][s:s + WINDOW] for i, s in part]))
        for (i, s), row in zip(part, decoded, strict=True):
            found[i].extend(_spans_of(row, s))
    out = []
    for text, spans, extra in zip(texts, base, found, strict=True):
        added = [(k, a, min(b, len(text))) for k, a, b in reconcile(extra) if a < len(text)]
        added = [(k, a, b) for k, a, b in added if not any(x < b and a < y for _, x, y in spans)
                 and EVIDENCE[k](text[a:b]) and (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b].isalnum())]
        out.append((spans, added))
    return out


def generated_windows(n: int = GENERATED, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Labelled windows with one generated item between invented words; a fifth have plain numbers instead."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8)))
    num = lambda k: "".join(rng.choices("0123456789", k=k))
    xs, ys = [], []
    for i in range(n):
        item = [f"{word()}.{word()}{num(2)}@{word()}.{rng.choice(['com', 'org', 'net'])}",
                ".".join(str(rng.randrange(256)) for _ in range(4)), "", f"+{num(1)} ({num(3)}) {num(3)}-{num(4)}", num(rng.randint(1, 6))][i % 5]
        if i % 5 == 2:
            body = "4" + num(14)
            item = next(body + c for c in "0123456789" if luhn(body + c))
            if rng.random() < 0.5:
                item = " ".join(item[k:k + 4] for k in range(0, 16, 4))
        before = " ".join(word() for _ in range(6))[-rng.randint(1, 30):] + rng.choice([" ", ": ", "\n"])
        text = (before + item + rng.choice([" ", ". ", ", "]) + " ".join(word() for _ in range(12)))[:WINDOW]
        xs.append(classes(text))
        ys.append(labels(WINDOW, base_spans(text)))
    return np.stack(xs), np.stack(ys)


def fit(docs: DataFrame, max_docs: int = SAMPLE_DOCS, max_windows: int = MAX_WINDOWS, epochs: int = 10) -> Tagger:
    """A tagger trained on at most ``max_windows`` labelled windows of at most ``max_docs`` documents."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc_id, text in zip(pdf["doc_id"], pdf["text"].fillna(""), strict=True):
                starts = window_starts(text)
                if starts:
                    x, y = classes(text), labels(max(WINDOW, len(text)), base_spans(text))
                    rows += [(doc_id, s, x[s:s + WINDOW].astype(np.int8).tobytes(), y[s:s + WINDOW].astype(np.int8).tobytes())
                             for s in starts]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "x", "y"])

    windows = (common.sample_documents(docs, max_docs).mapInPandas(cut, "doc_id long, start int, x binary, y binary")
               .orderBy(F.xxhash64("doc_id", "start"), "doc_id", "start").limit(max_windows).toPandas())
    x, y = generated_windows()
    if len(windows):
        x = np.vstack([x, np.stack([np.frombuffer(b, dtype=np.int8) for b in windows["x"]])])
        y = np.vstack([y, np.stack([np.frombuffer(b, dtype=np.int8) for b in windows["y"]])])
    tagger = Tagger(CLASSES, LABELS, hidden=HIDDEN)
    tagger.train(x.astype(np.int64), y.astype(np.int64), epochs=epochs, batch=32, rate=0.03)
    return tagger


def scan(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """One row per document: counts per base kind, the base digest, all spans and the added spans' number."""
    tagger = tagger or fit(docs)
    frame = common.id_text(docs)
    shared = frame.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for base, added in find_spans_many(["" if pd.isna(t) else t for t in pdf["text"]], shared.value):
                rows.append((*[sum(s[0] == k for s in base) for k in KINDS], common.sha256_hex(common.span_digest(base, KINDS)),
                             common.span_digest(base + added, KINDS), len(added)))
            out = pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"])
            out.insert(0, "doc_id", pdf["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None))
            yield out

    return frame.mapInPandas(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                                  "spans string, n_added long")


def redact_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans make one replacement."""
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], KINDS[s[0]])):
        if a >= at:
            parts += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(parts) + text[at:]


def redacted(docs: DataFrame, tagger: Tagger | None = None, text: str = "text") -> Column:
    """The redacted text as a column of ``docs``; NULL stays NULL."""
    tagger = tagger or fit(docs)
    common.ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            whole = [None if pd.isna(t) else t for t in texts]
            spans = find_spans_many([t or "" for t in whole], shared.value)
            yield pd.Series([None if t is None else redact_text(t, b + a) for t, (b, a) in zip(whole, spans, strict=True)],
                            dtype=object)

    return run(F.col(text).cast("string"))
