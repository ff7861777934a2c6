"""Toxicity by a classifier chain: categories are predicted in turn, earlier probabilities feed later linear models.

Features of a text are its distinct lower-cased words and their prefixes of 4 to 6 letters (stems with changing endings
share a prefix), as crc32 values. A fit keeps the ``max_features`` features that separate the categories best on a
bounded labelled sample. Category by category, in order, a logistic model is fitted on those features plus the earlier
categories' probabilities. In training these are out-of-fold probabilities, so a later model never sees an earlier
one's prediction of a row that it was fitted on; in prediction they come from the models fitted on all sampled rows.

Defined cases: NULL text scores as empty text; a text without kept features gets the models' intercepts; repeated rows
score alike; without labelled rows, or with one class only, that category's probability is its constant rate.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .wordhash import words

PREFIXES = (4, 5, 6)
SAMPLE_ROWS = 4000             # bound of the labelled rows that a fit takes
MAX_FEATURES = 512
FOLDS = 4
THRESHOLD = 0.5
MIN_HITS, MIN_SHARE, MIN_PRECISION = 3, 0.0015, 0.6   # target rows (at least, of the sample) and precision of a kept feature
CACHE_WORDS = 300_000
# Severity grades derived where the label table has a single toxicity column.
GRADES = ("dense", "varied", "toxic")
VARIED_TERMS, DENSE_SHARE, TERM_PRECISION = 3, 0.02, 0.9


def word_features(word: str) -> list[int]:
    """crc32 of the whole word and of its prefixes."""
    data = word.encode("utf-8", "surrogatepass")
    return [zlib.crc32(b"w:" + data)] + [zlib.crc32(b"p:" + word[:n].encode("utf-8", "surrogatepass"))
                                        for n in PREFIXES if len(word) >= n]


def text_features(text: str | None) -> np.ndarray:
    """Distinct feature values of a whole text."""
    found: set[int] = set()
    for w in set(words(text)):
        found.update(word_features(w))
    return np.fromiter(found, dtype=np.uint32, count=len(found))


@dataclass
class Chain:
    """Fitted chain: ``weights[c]`` covers the kept features, then the probabilities of the earlier categories."""

    categories: tuple[str, ...]
    features: dict[int, int]
    weights: list[np.ndarray]
    intercepts: list[float]
    _cache: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def columns_of(self, word: str) -> tuple[int, ...]:
        got = self._cache.get(word)
        if got is None:
            if len(self._cache) >= CACHE_WORDS:
                self._cache.clear()
            got = tuple(self.features[f] for f in word_features(word) if f in self.features)
            self._cache[word] = got
        return got

    def predict(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), len(self.features)))
        for i, text in enumerate(texts):
            for w in set(words(text)):
                for j in self.columns_of(w):
                    x[i, j] = 1.0
        return self.predict_matrix(x)

    def predict_matrix(self, x: np.ndarray) -> np.ndarray:
        p = np.zeros((len(x), 0))
        for w, b in zip(self.weights, self.intercepts, strict=True):
            p = np.hstack([p, _sigmoid(np.hstack([x, p]) @ w + b)[:, None]])
        return p


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 0.5, steps: int = 150) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by accelerated gradient steps; one class only gives a constant model."""
    rate = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 1e-4
    w, b = np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    if not len(y) or y.min() == y.max():
        return w, b
    n = len(y)
    importance = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max(n - y.sum(), 1))     # classes weigh the same
    step = 1.0 / (0.25 * float(importance @ (x * x).sum(axis=1) + 1.0) + l2 / n)
    b, vw, vb, pw, pb = 0.0, w.copy(), 0.0, w, 0.0
    for t in range(steps):
        g = importance * (_sigmoid(x @ vw + vb) - y)
        w, b = vw - step * (x.T @ g + (l2 / n) * vw), vb - step * g.sum()
        k = t / (t + 3)
        vw, vb, pw, pb = w + k * (w - pw), b + k * (b - pb), w, b
    return w, float(b)


def select_features(rows: list[np.ndarray], target: np.ndarray, max_features: int) -> tuple[list[int], np.ndarray]:
    """Features that mark target rows: most of the rows that hold one are targets; largest z score first.

    Also returns the features' precision for the target.
    """
    if not rows or not target.any():
        return [], np.zeros(0)
    flat = np.concatenate(rows)
    owner = np.repeat(target.astype(np.int64), [len(r) for r in rows])
    values, inverse = np.unique(flat, return_inverse=True)
    total = np.bincount(inverse, minlength=len(values))
    hits = np.bincount(inverse, weights=owner, minlength=len(values))
    base = target.mean()
    z = (hits - total * base) / np.sqrt(np.maximum(total * base * (1 - base), 1e-9))
    z[(hits < max(MIN_HITS, MIN_SHARE * len(rows))) | (hits - 0.5 < MIN_PRECISION * total)] = -np.inf
    order = np.lexsort((values, -z))[:max_features]
    order = order[np.isfinite(z[order])]
    return [int(v) for v in values[order]], hits[order] / total[order]


def fit(feature_rows: list[np.ndarray], labels: dict[str, np.ndarray], folds: np.ndarray,
        max_features: int = MAX_FEATURES) -> Chain:
    """Fit a chain over ``labels`` (category name -> 0/1 per row, in chain order)."""
    names = tuple(labels)
    any_label = np.zeros(len(feature_rows), dtype=bool)
    for y in labels.values():
        any_label |= np.asarray(y) > 0
    kept, _ = select_features(feature_rows, any_label, max_features)
    index = {f: i for i, f in enumerate(kept)}
    x = np.zeros((len(feature_rows), len(kept)), dtype=np.float32)
    for i, row in enumerate(feature_rows):
        x[i, [index[f] for f in row.tolist() if f in index]] = 1.0
    weights, intercepts = [], []
    earlier = np.zeros((len(x), 0), dtype=np.float32)
    for name in names:
        y = np.asarray(labels[name], dtype=float)
        inputs = np.hstack([x, earlier])
        w, b = fit_logistic(inputs, y)
        weights.append(w)
        intercepts.append(b)
        if name == names[-1]:
            break
        out_of_fold = np.zeros(len(x))
        for f in np.unique(folds):
            wf, bf = fit_logistic(inputs[folds != f], y[folds != f])
            out_of_fold[folds == f] = _sigmoid(inputs[folds == f] @ wf + bf)
        earlier = np.hstack([earlier, out_of_fold[:, None].astype(np.float32)])
    return Chain(names, index, weights, intercepts)


def grades(feature_rows: list[np.ndarray], toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Severity categories from one toxicity label: many toxic terms for the text's size, several terms, any label."""
    kept, precision = select_features(feature_rows, toxic > 0, MAX_FEATURES)
    terms = {f for f, p in zip(kept, precision, strict=True) if p >= TERM_PRECISION}
    count = np.array([sum(f in terms for f in r.tolist()) for r in feature_rows], dtype=float)
    size = np.array([max(1, len(r)) for r in feature_rows], dtype=float)
    return {"dense": (toxic > 0) & (count / size >= DENSE_SHARE), "varied": (toxic > 0) & (count >= VARIED_TERMS),
            "toxic": toxic > 0}


def fit_tables(docs: DataFrame, labels: DataFrame, max_rows: int = SAMPLE_ROWS) -> Chain:
    """Fit on at most ``max_rows`` labelled documents; the features of those rows alone reach the driver."""

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"],
                                "features": [np.sort(text_features(t)).tobytes() for t in pdf["text"]]})

    sample = common.labelled_sample(docs, labels.select("doc_id", "toxic").where("toxic is not null"), max_rows)
    rows = (sample.mapInPandas(featurise, "doc_id long, toxic int, features binary").toPandas()
            .sort_values(["doc_id", "features"], kind="stable"))
    feature_rows = [np.frombuffer(b, dtype=np.uint32) for b in rows["features"]]
    folds = np.array([zlib.crc32(str(i).encode()) % FOLDS for i in rows["doc_id"]], dtype=int)
    return fit(feature_rows, grades(feature_rows, rows["toxic"].to_numpy()), folds)


def probabilities(docs: DataFrame, chain: Chain, text: str = "text") -> Column:
    """A struct column with one probability per category of ``chain``, for the named text column of ``docs``."""
    common.ship_code(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = ", ".join(f"{c} double" for c in chain.categories)

    @F.pandas_udf(schema)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for texts in batches:
            parts = [model.predict([None if pd.isna(t) else t for t in texts.iloc[i:i + 512]])
                     for i in range(0, len(texts), 512)] or [np.zeros((0, len(model.categories)))]
            yield pd.DataFrame(np.vstack(parts), columns=list(model.categories))

    return score(F.col(text).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id``, the chain's probabilities and the decision ``rejected``."""
    chain = fit_tables(docs, labels)
    frame = common.id_text(docs)
    scored = frame.select("doc_id", probabilities(frame, chain).alias("p"))
    return scored.select("doc_id", *[F.col(f"p.{c}").alias(f"p_{c}") for c in chain.categories],
                         (F.col(f"p.{chain.categories[-1]}") >= threshold).alias("rejected"))


def clean_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the chain does not reject, with all their columns."""
    chain = fit_tables(docs, labels)
    return docs.where(probabilities(docs, chain)[chain.categories[-1]] < threshold)
