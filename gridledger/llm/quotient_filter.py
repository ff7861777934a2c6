"""Counting quotient filters over packed word-id phrases, without loss.

A phrase of up to three word ids is packed into one number of ``3 * width`` bits, held as two halves. A Feistel network
permutes these numbers one to one, so that phrases spread evenly whatever the ids are. A permuted number's top bits name a
range (the unit of the shuffle), the next bits are its quotient, and all the rest is its remainder, which is kept in full:
a filter never confuses two phrases, and the permutation is undone to read the phrase back.

A filter stores its entries in order. An entry stands at its quotient's slot or, if that is taken, in the next free one;
one bit per quotient says whether it has entries, one bit per slot whether an entry is its quotient's last. A counter is
one byte, and counts above 254 go to a list. Filters of the same range are merged as sorted lists.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

U = np.uint64
# Odd multipliers of the permutation's rounds.
ROUNDS = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
MAX_WIDTH = 31
ESCAPE = 255


@dataclass(frozen=True)
class Shape:
    """Bits of a word id, of the halves of a key, and of the range number."""

    width: int
    range_bits: int

    def __post_init__(self):
        if not 1 <= self.width <= MAX_WIDTH or self.range_bits > self.half:
            raise ValueError(f"word ids of 1 to {MAX_WIDTH} bits and ranges within the upper half")

    @property
    def half(self) -> int:
        return (3 * self.width + 1) // 2

    def pack(self, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two halves of the keys of id triples (0 stands for no word)."""
        w, h = U(self.width), U(self.half)
        low = (w2.astype(U) << w) | w3.astype(U)
        return (w1.astype(U) << U(2 * self.width - self.half)) | (low >> h), low & _mask(self.half)

    def unpack(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        w, shift = U(self.width), 2 * self.width - self.half
        rest = ((high & _mask(shift)) << U(self.half)) | low
        return high >> U(shift), rest >> w, rest & _mask(self.width)

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for c in ROUNDS:
            high, low = low, high ^ _mixed(low, c, self.half)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for c in reversed(ROUNDS):
            high, low = low ^ _mixed(high, c, self.half), high
        return high, low


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _mixed(x: np.ndarray, constant: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        y = (x + U(constant >> 7)) * U(constant)
        y ^= y >> U(29)
        y *= U(constant)
    return (y >> U(64 - bits)) & _mask(bits)


@dataclass
class Entries:
    """Permuted keys in ascending order with their counts."""

    high: np.ndarray
    low: np.ndarray
    count: np.ndarray


def collect_entries(shape: Shape, high: np.ndarray, low: np.ndarray, count: np.ndarray | None = None) -> Entries:
    """Keys in any order, repeated or not, as ordered entries; counts of equal keys are added."""
    if not len(high):
        return Entries(*(np.array([], U) for _ in range(3)))
    h = shape.half
    if 2 * h <= 64:
        key = (high << U(h)) | low
        if count is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")       # inputs are sorted runs: the stable sort merges them
            key, count = key[order], count[order]
        new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        high, low = key[new] >> U(h), key[new] & _mask(h)
        total = len(key)
    else:
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        count = None if count is None else count[order]
        new = np.flatnonzero(np.concatenate([[True], (high[1:] != high[:-1]) | (low[1:] != low[:-1])]))
        total = len(high)
        high, low = high[new], low[new]
    counted = np.diff(np.concatenate([new, [total]])).astype(U) if count is None else np.add.reduceat(count, new)
    return Entries(high, low, counted)


def _to_bytes(values: np.ndarray, width: int) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _from_bytes(cells: np.ndarray) -> np.ndarray:
    whole = np.zeros((len(cells), 8), np.uint8)
    whole[:, :cells.shape[1]] = cells
    return whole.view("<u8").reshape(-1).astype(U)


@dataclass
class QuotientFilter:
    shape: Shape
    range_no: int
    quotient_bits: int
    occupied: np.ndarray          # per quotient: has entries
    run_end: np.ndarray           # per slot: the last entry of its quotient
    remainder: np.ndarray         # slots x bytes
    counter: np.ndarray           # per slot, ESCAPE where the count is in `large`
    large: np.ndarray             # counts above ESCAPE - 1, in slot order

    @classmethod
    def of(cls, shape: Shape, range_no: int, entries: Entries) -> QuotientFilter:
        n = len(entries.high)
        left = shape.half - shape.range_bits
        bits = min(left, max(0, (n * 10 // 9).bit_length()))
        rest = left - bits
        quotient = ((entries.high & _mask(left)) >> U(rest)).astype(np.int64)
        # sorted entries: each stands at its quotient or right after its predecessor
        index = np.arange(n)
        slot = np.maximum.accumulate(quotient - index) + index if n else index
        slots = int(slot[-1]) + 1 if n else 0
        occupied = np.zeros(1 << bits, bool)
        occupied[quotient] = True
        run_end = np.zeros(slots, bool)
        run_end[slot[np.flatnonzero(np.diff(quotient, append=-1) != 0)]] = True
        high_bytes, low_bytes = -(-rest // 8), -(-shape.half // 8)
        remainder = np.zeros((slots, high_bytes + low_bytes), np.uint8)
        remainder[slot, :high_bytes] = _to_bytes(entries.high & _mask(rest), high_bytes)
        remainder[slot, high_bytes:] = _to_bytes(entries.low, low_bytes)
        counter = np.zeros(slots, np.uint8)
        counter[slot] = np.minimum(entries.count, U(ESCAPE))
        return cls(shape, range_no, bits, occupied, run_end, remainder, counter, entries.count[entries.count >= ESCAPE])

    def _runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Quotients that have entries, and the first and last slot of each."""
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(quotients, np.concatenate([[-1], ends[:-1]]) + 1) if len(ends) else quotients
        return quotients, starts, ends

    def _top(self, quotient: np.ndarray) -> np.ndarray:
        rest = self.shape.half - self.shape.range_bits - self.quotient_bits
        return ((U(self.range_no) << U(self.quotient_bits)) | quotient.astype(U)) << U(rest)

    def entries(self) -> Entries:
        quotients, starts, ends = self._runs()
        if not len(ends):
            return Entries(*(np.array([], U) for _ in range(3)))
        lengths = ends - starts + 1
        first = np.cumsum(lengths) - lengths
        slot = np.arange(int(lengths.sum())) + np.repeat(starts - first, lengths)
        wide = self.remainder.shape[1] - -(-self.shape.half // 8)
        high = self._top(np.repeat(quotients, lengths)) | _from_bytes(self.remainder[slot, :wide])
        count = self.counter[slot].astype(U)
        count[count == ESCAPE] = self.large
        return Entries(high, _from_bytes(self.remainder[slot, wide:]), count)

    def count(self, w1: int, w2: int, w3: int = 0) -> int:
        """The count of one phrase, found from its quotient's run alone."""
        high, low = self.shape.permute(*self.shape.pack(*(np.array([w]) for w in (w1, w2, w3))))
        left = self.shape.half - self.shape.range_bits
        rest = left - self.quotient_bits
        if int(high[0]) >> left != self.range_no:
            return 0
        q = int(high[0] & _mask(left)) >> rest
        if not self.occupied[q]:
            return 0
        run = int(self.occupied[:q].sum())
        ends = np.flatnonzero(self.run_end)
        start = max(q, int(ends[run - 1]) + 1 if run else 0)
        wide = self.remainder.shape[1] - -(-self.shape.half // 8)
        wanted = np.concatenate([_to_bytes(high & _mask(rest), wide)[0], _to_bytes(low, self.remainder.shape[1] - wide)[0]])
        for slot in range(start, int(ends[run]) + 1):
            if (self.remainder[slot] == wanted).all():
                held = int(self.counter[slot])
                return held if held < ESCAPE else int(self.large[(self.counter[:slot] == ESCAPE).sum()])
        return 0

    def to_bytes(self) -> bytes:
        head = struct.pack("<BBIBIII", self.shape.width, self.shape.range_bits, self.range_no, self.quotient_bits, len(self.run_end),
                           self.remainder.shape[1], len(self.large))
        return b"".join([head, np.packbits(self.occupied).tobytes(), np.packbits(self.run_end).tobytes(),
                         self.remainder.tobytes(), self.counter.tobytes(), self.large.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> QuotientFilter:
        width, range_bits, range_no, bits, slots, cells, n_large = struct.unpack_from("<BBIBIII", data)
        at = struct.calcsize("<BBIBIII")
        parts = []
        for size in (-(-(1 << bits) // 8), -(-slots // 8), slots * cells, slots, 8 * n_large):
            parts.append(np.frombuffer(data, np.uint8, size, at))
            at += size
        return cls(Shape(width, range_bits), range_no, bits, np.unpackbits(parts[0], count=1 << bits).astype(bool),
                   np.unpackbits(parts[1], count=slots).astype(bool), parts[2].reshape(slots, cells), parts[3],
                   parts[4].view("<u8").astype(U))


def build(shape: Shape, w1: np.ndarray, w2: np.ndarray, w3: np.ndarray) -> Iterator[QuotientFilter]:
    """One filter per range that the phrases fall into."""
    entries = collect_entries(shape, *shape.permute(*shape.pack(w1, w2, w3)))
    ranges = (entries.high >> U(shape.half - shape.range_bits)).astype(np.int64)
    found, first = np.unique(ranges, return_index=True)
    for r, a, b in zip(found.tolist(), first, [*first[1:], len(ranges)]):
        yield QuotientFilter.of(shape, r, Entries(entries.high[a:b], entries.low[a:b], entries.count[a:b]))


def merge(filters: Iterable[QuotientFilter]) -> QuotientFilter:
    """Filters of one range as one: their ordered entries merged, counts of equal phrases added."""
    held = list(filters)
    parts = [f.entries() for f in held]
    joined = [np.concatenate([getattr(p, name) for p in parts]) for name in ("high", "low", "count")]
    return QuotientFilter.of(held[0].shape, held[0].range_no, collect_entries(held[0].shape, *joined))
