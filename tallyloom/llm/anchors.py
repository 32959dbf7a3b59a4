"""Content-defined anchors: a sparse choice of suffixes that keeps every repeated span findable.

Every window of `span` bytes is assigned the smallest hash among the `gram`-byte strings inside it
(the rightmost of equal ones). The choice depends on the window's bytes alone, so two equal windows
have their anchor at the same place: a window can only repeat where its anchor's gram repeats.
About one byte in (span - gram) / 2 is an anchor.
"""

from __future__ import annotations

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Positions of one piece of work, which takes about 150 bytes of memory each; a position fits in the low bits of a key.
PIECE = 1 << 18
_PLACE = np.uint64((1 << 21) - 1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE + (1 << 12))
        _powers[:] = [np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(size - 1, m, np.uint64)))) for m in (_MULTIPLIER, _INVERSE)]
    return _powers


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """64-bit hash of each run of `gram` bytes."""
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    hashes ^= hashes >> np.uint64(32)
    hashes *= _MIX
    hashes ^= hashes >> np.uint64(29)
    return hashes


def anchors(data: np.ndarray, valid: np.ndarray, span: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the windows at the valid places: place of the anchor, its gram's hash, first and last window.

    data: at most PIECE + span bytes; valid has a flag for each place of a window. The windows of
    one row follow each other and have the same anchor.
    """
    hashes = gram_hashes(data, gram)
    keys = (hashes & ~_PLACE) | (_PLACE - np.arange(len(hashes), dtype=np.uint64))
    width, want = 1, span - gram + 1
    while 2 * width <= want:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < want:
        keys = np.minimum(keys[: len(keys) - (want - width)], keys[want - width :])
    at = np.flatnonzero(valid)
    place = (_PLACE - (keys[at] & _PLACE)).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate((first[1:], [len(at)])) - 1 if len(first) else first
    return place[first], hashes[place[first]], at[first], at[last]
