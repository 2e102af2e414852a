"""Words `[^\\x20\\x09-\\x0D]+` of a text as 64-bit hashes, A-Z lower-cased, computed over whole byte arrays."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
PIECE = 1 << 20  # bytes hashed at once; longer texts are cut at white space
_ROOT = 0x9E3779B97F4A7C15 | 1

_rng = np.random.Generator(np.random.PCG64(20240229))
_letters = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_letters[65:91] = _letters[97:123]
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_letters[_space] = 0
_places = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> U64(shift))) * U64(factor)
    return x ^ (x >> U64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        inverse = pow(_ROOT, -1, 1 << 64)
        _powers[:] = [np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]).cumprod(dtype=np.uint64) for base in (_ROOT, inverse)]
    return _powers


def _piece_hashes(piece: np.ndarray) -> np.ndarray:
    blank = _space[piece]
    start = ~blank
    start[1:] &= blank[:-1]
    starts = np.flatnonzero(start)
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(piece))
    sums = np.add.reduceat(_letters[piece] * power[: len(piece)], starts)
    return mix(sums * inverse[starts])


def word_hashes(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) <= PIECE:
        return _piece_hashes(data)
    found, at = [], 0
    while at < len(data):
        stop = min(len(data), at + PIECE)
        while stop < len(data) and not _space[data[stop]]:
            stop += 1
        found.append(_piece_hashes(data[at:stop]))
        at = stop
    return np.concatenate(found)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of `size`-word windows; of a shorter text the one whole sequence; of no words none."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * _places[k]
    return np.unique(mix(total))
