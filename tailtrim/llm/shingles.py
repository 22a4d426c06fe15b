"""Words and word shingles of a batch of texts as 64-bit hashes, computed on whole byte arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tailtrim.llm.common import SPACES, text_slices

PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)[_LOWERED]
_STEPS = mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < length:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            factors = np.full(max(length, PIECE_BYTES + 1), base, np.uint64)
            factors[0] = 1
            both.append(np.multiply.accumulate(factors))
        _powers[:] = both
    return _powers[0], _powers[1]


def _pieces(is_space: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut a byte range at spaces into pieces of about ``PIECE_BYTES``."""
    first, size = 0, len(is_space)
    while first < size:
        last = min(first + PIECE_BYTES, size)
        if last < size:
            spaces = np.flatnonzero(is_space[first:last])
            if len(spaces):
                last = first + int(spaces[-1]) + 1
            else:
                rest = is_space[last:]
                last = last + int(rest.argmax()) if rest.any() else size
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, with A to Z as a to z, and the row each word is in."""
    is_space = IS_SPACE[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    found, places = [], []
    for first, last in _pieces(is_space):
        letters = ~is_space[first:last]
        edge = begins[first : last + 1].copy()
        edge[0] = edge[-1] = True
        before = np.r_[False, letters[:-1]] & ~edge[:-1]
        after = np.r_[letters[1:], False] & ~edge[1:]
        starts = np.flatnonzero(letters & ~before)
        ends = np.flatnonzero(letters & ~after) + 1
        power, inverse = _power_tables(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[first:last]] * power[: last - first], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)))
        places.append(starts + first)
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    places = np.concatenate(places)
    return np.concatenate(found), np.searchsorted(offsets, places, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each row; a row with fewer words is one shingle, or none."""
    hashes, rows = word_hashes(data, offsets)
    count = len(offsets) - 1
    bounds = np.searchsorted(rows, np.arange(count + 1))
    joined = np.zeros(max(len(hashes) - words + 1, 0), np.uint64)
    for j in range(words):
        joined += hashes[j : j + len(joined)] * _STEPS[j]
    joined = mixed(joined)
    sets = []
    for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if last - first >= words:
            sets.append(np.unique(joined[first : last - words + 1]))
        elif last > first:
            short = (hashes[first:last] * _STEPS[: last - first]).sum(dtype=np.uint64)
            sets.append(mixed(np.array([short + np.uint64(last - first)], np.uint64)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sets_of_column(column: pa.Array, words: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    """Shingle sets of the rows of a column, a slice at a time."""
    for rows, data, offsets in text_slices(column):
        yield rows, shingle_sets(data, offsets, words)
