"""Texts of an Arrow batch as numpy arrays: words, rolling hashes, shingles.

All of these work on UTF-8 bytes. Texts are taken in blocks of about ``BLOCK_BYTES``
(a longer text is a block of its own), so that what a task holds at a time depends
on the longest text and not on the size of a batch.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_SPACES = bytes([32, *range(9, 14)])


def _table(matches) -> np.ndarray:
    return np.array([bool(matches(b)) for b in range(256)])


IS_SPACE = _table(lambda b: b in _SPACES)
#: A-Z to a-z, all other bytes as they are.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: What separates ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
IS_SEPARATOR = _table(lambda b: b < 128 and not (48 <= b <= 57 or 97 <= b <= 122))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column without nulls, and where each text begins and ends."""
    size = len(column)
    if not size:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + size + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(data: np.ndarray, offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator:
    """``(first, last, bytes, offsets)`` of runs of texts with up to ``limit`` bytes."""
    first, texts = 0, len(offsets) - 1
    while first < texts:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), texts)
        own = offsets[first : last + 1]
        yield first, last, data[own[0] : own[-1]], own - own[0]
        first = last


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self, base):
        self.base, self.inverse = int(base), pow(int(base), -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def reach(self, size: int) -> None:
        if size > len(self.up):
            size = max(size, 2 * len(self.up))
            steps = np.full(size, self.base, _U)
            steps[0] = 1
            back = np.full(size, self.inverse, _U)
            back[0] = 1
            self.up, self.down = np.multiply.accumulate(steps), np.multiply.accumulate(back)


class Rolling:
    """Polynomial hashes modulo 2**64 of any stretch of ``data``, by prefix sums."""

    def __init__(self, data: np.ndarray, powers: "_Powers | None" = None):
        self.powers = powers or _POWERS
        self.powers.reach(len(data) + 1)
        self.prefix = np.zeros(len(data) + 1, _U)
        np.cumsum((data.astype(_U) + _U(1)) * self.powers.up[: len(data)], out=self.prefix[1:])

    def of(self, starts, ends) -> np.ndarray:
        return (self.prefix[ends] - self.prefix[starts]) * self.powers.down[starts]


_POWERS = _Powers(_BASE)
SECOND_POWERS = _Powers(0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits, one to one."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words(data, offsets, separates) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: runs of bytes that don't separate, within one text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    apart = separates[data]
    before = np.empty(len(data), bool)
    before[0], before[1:] = True, apart[:-1]
    after = np.empty(len(data), bool)
    after[-1], after[:-1] = True, apart[1:]
    begins = offsets[:-1]
    before[begins[begins < len(data)]] = True
    ends = offsets[1:]
    after[ends[ends > 0] - 1] = True
    return np.flatnonzero(~apart & before), np.flatnonzero(~apart & after) + 1


def texts_of(positions, offsets) -> np.ndarray:
    """Which text each ascending byte position lies in."""
    return np.searchsorted(offsets, positions, "right") - 1


def bounds(positions, offsets) -> np.ndarray:
    """For each text the first of its ascending ``positions``, and the end of the last."""
    return np.searchsorted(positions, offsets)


def word_hashes(data, starts, ends) -> np.ndarray:
    rolling = Rolling(data)
    return mixed(rolling.of(starts, ends) + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash for every run of ``size`` words, also across texts."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.zeros(0, _U)
    total = np.zeros(count, _U)
    for i in range(size):
        total = mixed(total + hashes[i : i + count])
    return total


def shingle_sets(data, offsets, size: int) -> list[np.ndarray]:
    """Per text, ascending distinct hashes of its shingles of ``size`` words.

    Words are parted by ASCII white space and A-Z counts as a-z. With fewer words than
    ``size`` the whole sequence is one shingle; without words the set is empty.
    """
    low = LOWER[data]
    starts, ends = words(low, offsets, IS_SPACE)
    hashes = word_hashes(low, starts, ends)
    at = bounds(starts, offsets)
    every = shingle_hashes(hashes, size)
    sets = []
    for begin, end in zip(at[:-1].tolist(), at[1:].tolist()):
        if end - begin >= size:
            sets.append(np.unique(every[begin : end - size + 1]))
        elif end > begin:
            sets.append(shingle_hashes(hashes[begin:end], end - begin) + _U(end - begin))
        else:
            sets.append(np.zeros(0, _U))
    return sets


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unites ascending half-open ranges that overlap or touch; ``starts`` ascend."""
    if not len(starts):
        return starts, ends
    reach = np.maximum.accumulate(ends)
    fresh = np.empty(len(starts), bool)
    fresh[0], fresh[1:] = True, starts[1:] > reach[:-1]
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], reach[last]
