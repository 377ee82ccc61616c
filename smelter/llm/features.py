"""n-gram indicators of whole texts, hashed, vectorised over the text's bytes."""

from __future__ import annotations

import numpy as np

CHAR_BITS, SHAPE_BITS = 16, 14
WHOLE = 64  # binned measures of the whole text
SIZE = (1 << CHAR_BITS) + (1 << SHAPE_BITS) + WHOLE

_CLASS = np.arange(256, dtype=np.uint8)  # punctuation and control characters stand for themselves
_CLASS[ord("a"):ord("z") + 1] = ord("a")
_CLASS[128:] = ord("a")
_CLASS[ord("A"):ord("Z") + 1] = ord("A")
_CLASS[ord("0"):ord("9") + 1] = ord("0")


def _slots(values: np.ndarray, width: int, bits: int) -> np.ndarray:
    """Hash slots of all runs of width values below 256."""
    if len(values) < width:
        return np.zeros(0, dtype=np.int64)
    code = np.zeros(len(values) - width + 1, dtype=np.uint64)
    for k in range(width):
        code = code * np.uint64(257) + values[k:len(values) - width + 1 + k]
    return ((code * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def indicators(text: str) -> np.ndarray:
    """Sorted distinct slots: character trigrams; 4-grams of the text's shape, in which runs of letters of one case and
    of digits are one symbol; share of distinct words and length, binned."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    mark = np.zeros(SIZE, dtype=bool)
    mark[_slots(raw, 3, CHAR_BITS)] = True
    shape = _CLASS[raw]
    if len(shape):
        same = np.concatenate([[False], (shape[1:] == shape[:-1]) & np.isin(shape[1:], (ord("a"), ord("A"), ord("0")))])
        mark[(1 << CHAR_BITS) + _slots(shape[~same], 4, SHAPE_BITS)] = True
    words = text.split()
    at = (1 << CHAR_BITS) + (1 << SHAPE_BITS)
    mark[at + min(31, int(32 * len(set(words)) / max(1, len(words))))] = True
    mark[at + 32 + min(31, int(2 * np.log2(1 + len(words))))] = True
    return np.flatnonzero(mark)
