"""A character-level bidirectional LSTM with a CRF on top, in numpy: batched training and Viterbi decoding.

Inputs are integer character classes of equal-length windows (shape N x T); outputs are labels (N x T).
"""

from __future__ import annotations

import numpy as np


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logsumexp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Parameters: per direction the gates' input table, recurrence and bias; the output layer; CRF transitions."""

    def __init__(self, classes: int, labels: int, hidden: int = 16, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.hidden, self.labels = hidden, labels
        p: dict[str, np.ndarray] = {}
        for d in ("f", "b"):
            p[f"x{d}"] = rng.normal(0, 0.3, (classes, 4 * hidden))
            p[f"h{d}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            p[f"c{d}"] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])   # open forget gates
        p["o"] = rng.normal(0, 0.3, (2 * hidden, labels))
        p["ob"] = np.zeros(labels)
        p["t"] = np.zeros((labels, labels))
        p["s"] = np.zeros(labels)
        self.p = p

    # ---- the LSTM, one direction; steps run over time, all windows at once

    def _lstm(self, x: np.ndarray, d: str):
        n, t = x.shape
        h = self.hidden
        gates_in = self.p[f"x{d}"][x] + self.p[f"c{d}"]
        state, cell = np.zeros((n, h)), np.zeros((n, h))
        out, cache = np.zeros((n, t, h)), []
        for i in range(t) if d == "f" else range(t - 1, -1, -1):
            z = gates_in[:, i] + state @ self.p[f"h{d}"]
            g = _sigmoid(z[:, :3 * h])
            u = np.tanh(z[:, 3 * h:])
            previous, previous_state = cell, state
            cell = g[:, h:2 * h] * cell + g[:, :h] * u
            squashed = np.tanh(cell)
            state = g[:, 2 * h:] * squashed
            out[:, i] = state
            cache.append((i, g, u, previous, squashed, previous_state))
        return out, cache

    def _lstm_back(self, x: np.ndarray, d: str, cache: list, grad: np.ndarray, into: dict) -> None:
        n, t = x.shape
        h = self.hidden
        dh, dc = np.zeros((n, h)), np.zeros((n, h))
        backward, dz, states = self.p[f"h{d}"].T.copy(), np.zeros((n, t, 4 * h)), np.zeros((n, t, h))
        for i, g, u, previous, squashed, previous_state in reversed(cache):
            dh = dh + grad[:, i]
            gi, gf, go = g[:, :h], g[:, h:2 * h], g[:, 2 * h:]
            dc = dc + dh * go * (1 - squashed**2)
            into_gates = dz[:, i]
            into_gates[:, :h] = dc * u * gi * (1 - gi)
            into_gates[:, h:2 * h] = dc * previous * gf * (1 - gf)
            into_gates[:, 2 * h:3 * h] = dh * squashed * go * (1 - go)
            into_gates[:, 3 * h:] = dc * gi * (1 - u**2)
            states[:, i] = previous_state
            dh, dc = into_gates @ backward, dc * gf
        flat = dz.reshape(-1, 4 * h)
        into[f"x{d}"] += (x.reshape(-1)[None, :] == np.arange(len(into[f"x{d}"]))[:, None]).astype(float) @ flat
        into[f"h{d}"] += states.reshape(-1, h).T @ flat
        into[f"c{d}"] += flat.sum(axis=0)

    def emissions(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([self._lstm(x, "f")[0], self._lstm(x, "b")[0]], axis=2) @ self.p["o"] + self.p["ob"]

    # ---- the CRF

    def loss_and_grads(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
        n, t = x.shape
        hf, cf = self._lstm(x, "f")
        hb, cb = self._lstm(x, "b")
        both = np.concatenate([hf, hb], axis=2)
        e = both @ self.p["o"] + self.p["ob"]
        trans, start = self.p["t"], self.p["s"]
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = start + e[:, 0]
        for i in range(1, t):
            alpha[:, i] = _logsumexp(alpha[:, i - 1][:, :, None] + trans, 1) + e[:, i]
        for i in range(t - 2, -1, -1):
            beta[:, i] = _logsumexp(trans + (e[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
        z = _logsumexp(alpha[:, -1], 1)
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(t), y].sum(axis=1) + start[y[:, 0]] + trans[y[:, :-1], y[:, 1:]].sum(axis=1)
        de = np.exp(alpha + beta - z[:, None, None])
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        pairs = alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]
        grads["t"] += np.exp(pairs).sum(axis=(0, 1))
        np.add.at(grads["t"], (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0)
        grads["s"] += de[:, 0].sum(axis=0)
        np.add.at(grads["s"], y[:, 0], -1.0)
        de[rows, np.arange(t), y] -= 1.0
        grads["o"] = both.reshape(-1, both.shape[2]).T @ de.reshape(-1, self.labels)
        grads["ob"] = de.sum(axis=(0, 1))
        dboth = de @ self.p["o"].T
        self._lstm_back(x, "f", cf, dboth[:, :, :self.hidden], grads)
        self._lstm_back(x, "b", cb, dboth[:, :, self.hidden:], grads)
        return float((z - gold).sum()), grads

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 6, batch: int = 64, rate: float = 0.02, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; returns the mean loss of each epoch."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, history, steps = 0, [], epochs * -(-len(x) // batch)
        for _ in range(epochs):
            total, order = 0.0, rng.permutation(len(x))
            for i in range(0, len(x), batch):
                at = order[i:i + batch]
                loss, grads = self.loss_and_grads(x[at], y[at])
                total, step = total + loss, step + 1
                lr = rate * 0.5 * (1 + np.cos(np.pi * step / (steps + 1)))
                for k, g in grads.items():
                    g = g / len(at)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
            history.append(total / max(1, len(x)))
        return history

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best label sequence of every window (Viterbi)."""
        e, trans = self.emissions(x), self.p["t"]
        n, t, k = e.shape
        back = np.zeros((n, t, k), dtype=np.int8)
        score = self.p["s"] + e[:, 0]
        for i in range(1, t):
            ways = score[:, :, None] + trans
            back[:, i] = ways.argmax(axis=1)
            score = ways.max(axis=1) + e[:, i]
        out = np.zeros((n, t), dtype=np.int64)
        out[:, -1] = score.argmax(axis=1)
        for i in range(t - 1, 0, -1):
            out[:, i - 1] = back[np.arange(n), i, out[:, i]]
        return out
