"""Words of many texts at once, as numpy arrays: where they are and 64-bit hashes of them and of runs of them.

A word is a longest run of bytes other than [\\x20\\x09-\\x0D]. These are ASCII, so cutting UTF-8 there is safe.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
#: Two odd multipliers for runs of words; both together make 128 bits.
RUN_BASES = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)
#: Bytes of words hashed at once, and so the powers that a process keeps for each multiplier (16 bytes each).
PIECE = (1 << 18) - 1

BREAKS = np.zeros(256, bool)
BREAKS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits (splitmix64)."""
    x = x + U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(base, -1, 1 << 64)
    up, down = np.full(size, base, U), np.full(size, inverse, U)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64; one table is kept for each base, longer ones are made anew."""
    if size > PIECE + 1:
        return _powers(base, size)
    if base not in _KEPT or len(_KEPT[base][0]) < size:
        _KEPT[base] = _powers(base, 1 << max(12, (max(1, size) - 1).bit_length()))
    up, down = _KEPT[base]
    return up[:size], down[:size]


@dataclass
class Words:
    """Words of a batch of texts: byte range, hash, and for each text the range of its words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # first[d]:first[d + 1] are the words of text d

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins; null counts as empty."""
    column = pa.compute.fill_null(texts, "").cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split(texts: pa.Array, lower: bool = False) -> Words:
    data, offsets = buffers(texts)
    if lower:
        data = ASCII_LOWER[data]
    starts, ends = _cut(data, offsets)
    return Words(data, starts, ends, _word_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def _cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    apart = BREAKS[data]
    begins, stops = np.empty(len(data), bool), np.empty(len(data), bool)
    begins[0] = stops[-1] = True
    begins[1:], stops[:-1] = apart[:-1], apart[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begins[inner] = True
    stops[inner - 1] = True
    return np.flatnonzero(begins & ~apart), np.flatnonzero(stops & ~apart) + 1


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of each word's bytes, in pieces so that the tables of powers stay small."""
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + PIECE, "right")))
        size = int(ends[to - 1] - base)
        up, down = powers(BYTE_BASE, size + 1)
        sums = np.zeros(size + 1, U)
        np.cumsum((data[base : base + size].astype(U) + U(1)) * up[:size], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(U))
        at = to
    return out


def run_hashes(hashes: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: int = RUN_BASES[0]) -> np.ndarray:
    """Hash of each run ``hashes[begin:end]``; the same for equal runs wherever they are."""
    up, down = powers(base, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(U))


def grams(words: Words, size: int, base: int = RUN_BASES[0]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words inside one text, and where the run begins."""
    n = len(words.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    begins = np.arange(n)
    owner = words.text_of()
    begins = begins[owner[:n] == owner[size - 1 :]]
    return run_hashes(words.hashes, begins, begins + size, base), begins


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
