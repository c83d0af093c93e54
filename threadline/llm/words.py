"""Words of many texts at once, as 64-bit hashes in numpy.

A word is a run of characters other than space and the controls 9 to 13, on
whole texts. The hash of a word is a polynomial over random values of its
bytes; prefix sums give all words of a batch in a few array operations. Modulo
2**64 long words can be built that collide whatever the base (letters in
Thue-Morse order and its opposite), so words beyond ``_LONG`` bytes, which are
rare, are hashed one by one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from threadline.llm.arrow import joined_bytes

_RANDOM = np.random.Generator(np.random.PCG64(20240607))
_BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_PLACES = _RANDOM.integers(1, 2**62, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG = 64
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, _INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class Words:
    """Words in text order: hash, number of the text, byte span; and word bounds of each text."""

    hashes: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # first[i]:first[i + 1] are the words of text i
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, width: int, seed: int = 0) -> np.ndarray:
        """Hash of the ``width`` words from each word on (meaningless where they leave the text)."""
        out = np.zeros(len(self.hashes), dtype=np.uint64)
        n = len(out) - width + 1
        if n > 0:
            for i in range(width):
                out[:n] += self.hashes[i : i + n] * _PLACES[seed + i]
        return mix(out)

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return self.first[self.doc + 1] - np.arange(len(self.doc))


def words_of(column: pa.Array, lower: bool = False) -> Words:
    data, starts, _ = joined_bytes(column)
    if lower:
        data = _LOWER[data]
    inside = ~_BREAK[data]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    size = 1 << max(16, int(len(data) + 1).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * down[start])
    for i in np.flatnonzero(end - start > _LONG).tolist():
        digest = hashlib.blake2b(data[start[i] : end[i]], digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    doc = np.searchsorted(starts, start, side="right") - 1
    first = np.searchsorted(start, np.append(starts, len(data)))
    return Words(hashes, doc, start, end, first, data)
