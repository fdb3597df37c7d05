"""Anchors: places of a text that any two equal strings of a given length have in common."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multiplier of the rolling hash, and its inverse modulo 2**64.
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 1 << 64)
#: Bytes that are hashed at a time.
PIECE = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_FACTOR, PIECE + 1024), _powers(_INVERSE, PIECE + 1024)


def gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of the k bytes from each place of `data` on."""
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for start in range(0, n, PIECE):
        stop = min(n, start + PIECE)
        part = data[start : stop + k - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _UP[: len(part)], out=sums[1:])
        rolled = (sums[k:] - sums[:-k]) * _DOWN[: stop - start]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled ^= rolled >> np.uint64(32)
        out[start:stop] = rolled
    return out


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Where the smallest value of each run of `width` values is, the first one if several are equal."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    padded = -(-len(values) // width) * width
    blocks = np.full(padded, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[:n], forward[width - 1 : width - 1 + n])
    # The first place at or after the window's start that holds its minimum.
    changes = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    out = np.empty(n, np.int64)
    stops = np.r_[changes[1:], n]
    for a, b in zip(changes.tolist(), stops.tolist()):
        places = a + np.flatnonzero(values[a : b - 1 + width] == least[a])
        if len(places) == 1:
            out[a:b] = places[0]
        else:
            out[a:b] = places[np.searchsorted(places, np.arange(a, b))]
    return out


def anchored(data: bytes, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, its place, and the first and last start of the strings of `length` bytes it stands for.

    A string's anchor is the k bytes within it that have the smallest hash, the first if several do.
    So equal strings have equal anchors at equal distance from their starts.
    """
    values = gram_hashes(np.frombuffer(data, np.uint8), k)
    minima = window_minima(values, length - k + 1)
    if not len(minima):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    first = np.flatnonzero(np.r_[True, minima[1:] != minima[:-1]])
    last = np.r_[first[1:] - 1, len(minima) - 1]
    place = minima[first]
    return values[place], place, first, last


def segment_hash(data: bytes, first: int, last: int, length: int, place: int) -> bytes:
    """128 bits for the bytes of the strings from `first` to `last`, and where their anchor lies in them."""
    return xxhash.xxh3_128_digest(data[first : last + length], seed=place - first)
