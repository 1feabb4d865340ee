"""Anchors of the windows of a text, chosen by content alone.

Every window of ``length`` bytes has one anchor: the leftmost of its stretches of ``GRAM``
bytes with the smallest hash. Equal windows have the same anchor at the same distance,
wherever they stand. Neighbouring windows mostly share one, so anchors are few.
"""

import numpy as np

from .arrays import Rolling, mixed

GRAM = 40

_U = np.uint64
_PLACE_BITS = 21  # places within a block, which so may have up to 2 MiB
BLOCK = 1 << 20


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring values, by minima from both ends of blocks."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:count], forward[width - 1 : width - 1 + count])


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with the same anchor, in texts of up to ``BLOCK`` bytes together.

    Four arrays: the first window of each run, its last one, the anchor, and a hash of
    the anchor's bytes. No window reaches from one text into the next.
    """
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, np.zeros(0, _U)
    rolling = Rolling(data)
    places = np.arange(len(data) - GRAM + 1)
    hashes = mixed(rolling.of(places, places + GRAM))
    mask = _U((1 << _PLACE_BITS) - 1)
    # The place in the low bits makes the leftmost of equal hashes the least.
    least = window_minima((hashes & ~mask) | places.astype(_U), length - GRAM + 1)
    anchor = (least & mask).astype(np.int64)
    starts = np.arange(len(anchor))
    text = np.searchsorted(offsets, starts, "right") - 1
    inside = starts + length <= offsets[text + 1]
    fresh = np.empty(len(anchor), bool)
    fresh[0] = True
    fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
    first = np.flatnonzero(fresh & inside)
    # A run ends before the next beginning, or where its text has no further window.
    ends = np.flatnonzero(inside & np.append(fresh[1:] | ~inside[1:], True))
    return first, ends, anchor[first], hashes[anchor[first]]
