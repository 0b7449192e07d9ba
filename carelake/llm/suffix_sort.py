"""Suffix sorting by hashes: common extensions from prefix hashes and binary search, in a mergesort."""

from __future__ import annotations

import numpy as np

from carelake.llm.arrays import Prefixes, byte_values

# Hashes to try in turn, if one should be found wrong.
KINDS = ("byte", "gram", "run", "window")


class Extensions:
    """Lengths of common beginnings of parts of a byte array."""

    def __init__(self, data: np.ndarray, kind: str):
        self.data = data
        self.prefixes = Prefixes(byte_values(data), kind)

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes from places a and b on agree, at most ``most``, by binary search."""
        low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) // 2
            same = self.prefixes.part(a, a + middle) == self.prefixes.part(b, b + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def precedes(self, a: np.ndarray, a_length: np.ndarray, b: np.ndarray, b_length: np.ndarray, ties: bool) -> np.ndarray:
        """Whether suffix a sorts before suffix b; ``ties`` is the answer for equal ones."""
        most = np.minimum(a_length, b_length)
        n = self.common(a, b, most)
        ended = n == most
        last = len(self.data) - 1
        less = self.data[np.minimum(a + n, last)] < self.data[np.minimum(b + n, last)]
        return np.where(ended, (a_length < b_length) | (ties & (a_length == b_length)), less)


def sort_suffixes(text: Extensions, starts: np.ndarray, lengths: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """The order of suffixes within groups; ``groups`` is ascending. A stable bottom-up mergesort.

    Both halves of every merge, of all groups at once, find each element's place
    in the other half by binary search, comparing suffixes by common extension.
    """
    n = len(starts)
    begin = np.searchsorted(groups, groups, side="left")
    size = np.searchsorted(groups, groups, side="right") - begin
    place = np.arange(n) - begin
    order, width = np.arange(n), 1
    widest = int(size.max()) if n else 0
    while width < widest:
        right = (place // width) % 2 == 1
        base = begin + place // (2 * width) * (2 * width)
        middle = np.minimum(base + width, begin + size)
        end = np.minimum(base + 2 * width, begin + size)
        low, high = np.where(right, base, middle), np.where(right, middle, end)
        first = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            probe = (low[open_] + high[open_]) // 2
            a, b = order[probe], order[open_]
            before = np.empty(len(open_), bool)
            for ties in (False, True):  # equal suffixes of the left half stay ahead
                own = right[open_] == ties
                before[own] = text.precedes(starts[a[own]], lengths[a[own]], starts[b[own]], lengths[b[own]], ties)
            low[open_[before]], high[open_[~before]] = probe[before] + 1, probe[~before]
        own_place = np.arange(n) - np.where(right, middle, base)
        merged = np.empty(n, np.int64)
        merged[base + own_place + (low - first)] = order
        order, width = merged, 2 * width
    return order
