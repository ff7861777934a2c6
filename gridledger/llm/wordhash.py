"""64-bit hashes of the words of many texts at once, with numpy over the UTF-8 bytes.

A word is a run of ASCII letters, digits, ``_`` or non-ASCII bytes of the lower-cased text. Its hash is a polynomial in
the bytes modulo 2**64, taken from prefix sums, then mixed. Equal words have equal hashes everywhere; anything that
must be exact is verified on the words themselves afterwards.
"""

from __future__ import annotations

import re

import numpy as np

WORD = re.compile(r"[A-Za-z0-9_\x80-\U0010ffff]+")
MULTIPLIER = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(MULTIPLIER, -1, 2**64)
BLOCK_BYTES = 1 << 20          # bytes hashed at once: bounds the memory for very long texts

_IS_WORD = np.zeros(256, dtype=bool)
for _range in (range(48, 58), range(65, 91), range(97, 123), range(95, 96), range(128, 256)):
    _IS_WORD[list(_range)] = True


def words(text: str | None) -> list[str]:
    """The words themselves, as ``text_hashes`` sees them."""
    return WORD.findall((text or "").lower())


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64 (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP: np.ndarray = _powers(MULTIPLIER, 1)
_DOWN: np.ndarray = _powers(INVERSE, 1)


def _block_hashes(data: np.ndarray) -> np.ndarray:
    global _UP, _DOWN
    if len(_UP) < len(data) + 1:
        _UP, _DOWN = _powers(MULTIPLIER, len(data) + 1), _powers(INVERSE, len(data) + 1)
    inside = _IS_WORD[data]
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    start, end = edges[0::2], edges[1::2]
    if not len(start):
        return np.empty(0, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _UP[:len(data)], out=sums[1:])
    poly = (sums[end] - sums[start]) * _DOWN[start]
    return mix(poly ^ ((end - start).astype(np.uint64) << np.uint64(56)))


def text_hashes(text: str | None) -> np.ndarray:
    """uint64 hash of every word of the whole text, in order; long texts go block by block, cut between words."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    if len(raw) <= BLOCK_BYTES:
        return _block_hashes(np.frombuffer(raw, dtype=np.uint8))
    data, parts, at = np.frombuffer(raw, dtype=np.uint8), [], 0
    while at < len(data):
        end = min(len(data), at + BLOCK_BYTES)
        while end < len(data):          # on to the next byte outside a word
            gap = np.flatnonzero(~_IS_WORD[data[end:end + 4096]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(len(data), end + 4096)
        parts.append(_block_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_hashes(word_hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter, non-empty text is one shingle of all its words."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(MULTIPLIER) + word_hashes[i:n - size + 1 + i]
    return mix(out)
