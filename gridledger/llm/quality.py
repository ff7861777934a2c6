"""Quality score: random-indexing word vectors pooled per document, then a two-layer network with calibrated output.

Every token has a sparse ternary index vector that follows from its hash. A word's vector is the sum of the index
vectors of its neighbours within ``REACH`` tokens, over a bounded labelled sample, scaled to length one; words outside
the kept vocabulary share the vector of their shape (letter case, digits or symbols, and length). A document is the mean
and the spread of its tokens' vectors, with the logarithm of its token count and its share of distinct tokens. A
two-layer network on those gives a logit; a temperature fitted on rows set aside from the network's fit calibrates it.

Defined cases: NULL text scores as empty text; an empty text has its own, constant features; repeated rows score alike;
without labelled rows the score is 0.5, with one class only it is that class's smoothed rate; rows with a NULL id are
scored, but never learned from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
DIMENSIONS, NONZERO, REACH = 32, 4, 2
SAMPLE_ROWS = 5000             # bound of the labelled rows that a fit takes
VOCABULARY = 20_000            # words with vectors of their own: the most frequent of the sample
MIN_COUNT = 3
HIDDEN = 32
EPOCHS = 60
THRESHOLD = 0.3


def shape(token: str) -> str:
    """Letter case or kind of a token, and its length in steps of three."""
    kind = ("d" if token[0].isdigit() else "s" + token[0]) if not token[0].isalpha() else \
        "l" if token.islower() else "U" if token.isupper() and len(token) > 1 else "t" if token[0].isupper() else "m"
    return f"\x00{kind}{min(len(token), 18) // 3}"


def index_places(token: str) -> list[tuple[int, int]]:
    """The nonzero places of a token's index vector, with their signs."""
    out, seed = [], zlib.crc32(token.encode("utf-8", "surrogatepass"))
    for i in range(NONZERO):
        seed = (seed * 0x5851F42D4C957F2D + 0x14057B7EF767814F + i) & 0xFFFFFFFFFFFFFFFF
        out.append(((seed >> 33) % DIMENSIONS, 1 if seed >> 63 else -1))
    return out


def index_vector(token: str) -> np.ndarray:
    v = np.zeros(DIMENSIONS, dtype=np.int64)
    for at, sign in index_places(token):
        v[at] += sign
    return v


def context_sums(texts: list[str]) -> dict[str, tuple[int, np.ndarray]]:
    """Per word (and per shape): occurrences and summed index vectors of the neighbours."""
    ids: dict[str, int] = {}
    streams = []
    for t in texts:
        streams.append(np.array([ids.setdefault(w, len(ids)) for w in TOKEN.findall(t)], dtype=np.int64))
    if not ids:
        return {}
    index = np.stack([index_vector(w) for w in ids])
    sums, counts = np.zeros((len(ids), DIMENSIONS), dtype=np.int64), np.zeros(len(ids), dtype=np.int64)
    for s in streams:
        counts += np.bincount(s, minlength=len(ids))
        for d in range(1, REACH + 1):
            if len(s) > d:
                np.add.at(sums, s[d:], index[s[:-d]])
                np.add.at(sums, s[:-d], index[s[d:]])
    out = {w: (int(counts[i]), sums[i]) for w, i in ids.items()}
    for w, i in ids.items():
        n, v = out.get(shape(w), (0, np.zeros(DIMENSIONS, dtype=np.int64)))
        out[shape(w)] = (n + int(counts[i]), v + sums[i])
    return out


@dataclass
class Vectors:
    """Word vectors by row; tokens without a row fall back on their shape, then on their own index vector's shape row."""

    rows: dict[str, int]
    matrix: np.ndarray

    def features(self, text: str | None) -> np.ndarray:
        """Mean and spread of the token vectors of a whole text, token count and share of distinct tokens."""
        tokens = TOKEN.findall(text or "")
        out = np.zeros(2 * DIMENSIONS + 3, dtype=np.float64)
        if not tokens:
            out[-1] = 1.0
            return out
        counts: dict[str, int] = {}
        for w in tokens:
            counts[w] = counts.get(w, 0) + 1
        get, last = self.rows.get, len(self.matrix) - 1
        at = [get(w, -1) for w in counts]
        at = [get(shape(w), last) if i < 0 else i for w, i in zip(counts, at, strict=True)]
        weight = np.fromiter(counts.values(), dtype=np.float64, count=len(counts)) / len(tokens)
        v = self.matrix[at]
        mean = weight @ v
        out[:DIMENSIONS] = mean
        out[DIMENSIONS:2 * DIMENSIONS] = np.sqrt(np.maximum(weight @ (v * v) - mean * mean, 0))
        out[-3:-1] = np.log1p(len(tokens)), len(counts) / len(tokens)
        return out


def word_vectors(sample: DataFrame) -> Vectors:
    """Vectors of the sample's most frequent words and of all shapes; sums are made in Spark, VOCABULARY rows reach the driver."""
    columns = [f"v{i}" for i in range(DIMENSIONS)]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sums = context_sums(pdf["text"].tolist())
            if not sums:
                continue
            frame = pd.DataFrame(np.array([v for _, v in sums.values()], dtype=np.int64).reshape(-1, DIMENSIONS), columns=columns)
            frame.insert(0, "n", [n for n, _ in sums.values()])
            frame.insert(0, "word", list(sums))
            yield frame

    parts = sample.select("text").mapInPandas(count, "word string, n long, " + ", ".join(f"{c} long" for c in columns))
    kept = (parts.groupBy("word").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in columns])
            .where((F.col("n") >= MIN_COUNT) | F.col("word").startswith("\x00"))
            .orderBy(F.col("word").startswith("\x00").desc(), F.col("n").desc(), "word").limit(VOCABULARY).toPandas())
    matrix = kept[columns].to_numpy(np.float64)
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    return Vectors({w: i for i, w in enumerate(kept["word"])}, np.vstack([matrix, np.zeros((1, DIMENSIONS))]))


@dataclass
class Network:
    """Standardised inputs, one tanh layer, one logit, one temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -35, 35)))


def _loss(logits: np.ndarray, y: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, calibrate: np.ndarray, epochs: int = EPOCHS, seed: int = 0) -> Network:
    """Adam on the rows outside ``calibrate``; the temperature minimises the loss of the rows inside."""
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 1) / (len(y) + 2)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(rate / (1 - rate))))
    rng = np.random.default_rng(seed)
    fit_rows = np.flatnonzero(~calibrate) if (~calibrate).any() else np.arange(len(y))
    mean, scale = x[fit_rows].mean(axis=0), x[fit_rows].std(axis=0) + 1e-3
    net = Network(mean, scale, rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), 0.0)
    p = {"w1": net.w1, "b1": net.b1, "w2": net.w2, "b2": np.zeros(1)}
    m, v, step = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}, 0
    total = epochs * -(-len(fit_rows) // 64)
    for _ in range(epochs):
        order = rng.permutation(fit_rows)
        for i in range(0, len(order), 64):
            at = order[i:i + 64]
            z = (x[at] - mean) / scale
            h = np.tanh(z @ p["w1"] + p["b1"])
            error = (1 / (1 + np.exp(-np.clip(h @ p["w2"] + p["b2"], -35, 35))) - y[at]) / len(at)
            back = error[:, None] * p["w2"] * (1 - h * h)
            grads = {"w1": z.T @ back + 1e-3 * p["w1"], "b1": back.sum(axis=0), "w2": h.T @ error + 1e-3 * p["w2"], "b2": error.sum(keepdims=True)}
            step += 1
            rate = 0.01 * 0.5 * (1 + np.cos(np.pi * step / (total + 1)))
            for k, g in grads.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = p["w1"], p["b1"], p["w2"], float(p["b2"][0])
    if calibrate.any():
        logits = net.logits(x[calibrate])
        net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logits, y[calibrate], t)))
    return net


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, max_rows: int = SAMPLE_ROWS) -> tuple[Vectors, Network]:
    """Vectors and network from at most ``max_rows`` labelled documents outside the held-out fold."""
    usable = labels.select("doc_id", "quality").where(F.col("quality").isNotNull() & ~common.held_out(F.col("doc_id"), modulus, remainder))
    sample = common.cut_lineage(common.labelled_sample(docs, usable, max_rows))
    vectors = word_vectors(sample)
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "quality": pdf["quality"], "x": [shared.value.features(t) for t in pdf["text"]]})

    rows = sample.mapInPandas(featurise, "doc_id long, quality int, x array<double>").toPandas()
    rows = rows.assign(order=[zlib.crc32(np.asarray(a).tobytes()) for a in rows["x"]]).sort_values(["doc_id", "order"])
    x = np.stack(rows["x"].to_list()) if len(rows) else np.zeros((0, 2 * DIMENSIONS + 3))
    aside = np.array([zlib.crc32(b"calibrate" + str(i).encode()) % 5 == 0 for i in rows["doc_id"]], dtype=bool)
    return vectors, train(x, rows["quality"].to_numpy(np.float64), aside)


def score(docs: DataFrame, labels: DataFrame, modulus: int = 5, remainder: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    model = fit(docs, labels, modulus, remainder)
    frame = common.id_text(docs)
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vectors, network = shared.value
        for texts in batches:
            x = [vectors.features(None if pd.isna(t) else t) for t in texts]
            yield pd.Series(network.scores(np.stack(x)) if x else np.zeros(0))

    return frame.select("doc_id", common.held_out(F.col("doc_id"), modulus, remainder).alias("held_out"), run("text").alias("score")) \
                .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
