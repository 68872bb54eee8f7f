"""Words of many texts at once, as arrays of positions and 64-bit hashes (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Constants of the splitmix64 finaliser.
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_TAILS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def slices(sizes: list[int], at_most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``at_most`` bytes; a longer text is a range of its own."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + size > at_most:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one byte array with a blank after each, and where each text begins."""
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), begins


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the words in ``data``, which must end with a blank."""
    space = np.concatenate(([True], _SPACE[data]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[0::2], edge[1::2]


def lowered(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: its eight-byte pieces mixed in one after the other."""
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    pieces = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
    left = ends - begins
    hashes = mix(left.astype(np.uint64) * _GOLDEN)
    at, todo = begins, np.arange(len(begins))
    while len(todo):
        piece = pieces[at] & _TAILS[np.minimum(left, 8)]
        hashes[todo] = mix(hashes[todo] + piece * _M1 + _GOLDEN)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return hashes


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    factor = 0x9E3779B97F4A7C15
    for j in range(size):
        total += hashes[j : j + n] * np.uint64(factor)
        factor = (factor * 0xD1342543DE82EF95 | 1) % 2**64
    return mix(total)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct ``size``-word shingles.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    data, begins = joined(texts)
    data = lowered(data)
    first, last = words(data)
    hashes = word_hashes(data, first, last)
    bounds = np.searchsorted(first, begins)
    every = windows(hashes, size)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= size:
            out.append(np.unique(every[lo : hi - size + 1]))
        elif hi > lo:
            out.append(windows(hashes[lo:hi], int(hi - lo)) ^ np.uint64(hi - lo))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
