"""Array helpers for tasks: words and polynomial hashes of a batch of texts.

A hash joins two polynomials over random-looking values, one modulo 2**64 and one
modulo the prime 2**31 - 1, so a substring's hash is a subtraction and a product
of prefix hashes each. Modulo a power of two alone, texts that repeat their own
complement (Thue-Morse) agree whatever the base. Hashes are the same in every
task and every run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word is a run of bytes that are none of these.
SPACES = b" \t\n\x0b\x0c\r"
# Texts are taken together until a piece has so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 600_000

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = 0x9E3779B97F4A7C15
_BASES = {"byte": 0xD6E8FEB86659FD93, "gram": 0xA0761D6478BD642F, "run": 0xE7037ED1A0B428DB, "window": 0x8EBC6AF09C88C6E3}
_WIDE = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_BYTE_VALUES = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_ODD)) | np.uint64(1)
_powers: dict[str, tuple[np.ndarray, ...]] = {}
_PRIME, _SHIFT = np.uint64((1 << 31) - 1), np.uint64(31)


def _folded(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**62 modulo the prime, up to the prime itself, which stands for 0."""
    x = (x & _PRIME) + (x >> _SHIFT)
    return (x & _PRIME) + (x >> _SHIFT)


def _ladder(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), by doubling."""
    out = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


def _small_ladder(base: int, n: int) -> np.ndarray:
    """The same modulo the prime, in half the memory."""
    out = np.ones(n, np.uint32)
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done:done + more] = _folded(out[:more] * np.uint64(pow(base, done, int(_PRIME))))
        done += more
    return out


def powers(kind: str, n: int) -> tuple[np.ndarray, ...]:
    """Powers of a base and of its inverse, at least n of each, modulo 2**64 and modulo the prime."""
    have = _powers.get(kind)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE_BYTES + 1 if kind == "byte" else 400_000)
        base = _BASES[kind]
        small = base % int(_PRIME)
        have = (_ladder(base, size), _ladder(pow(base, -1, 1 << 64), size),
                _small_ladder(small, size), _small_ladder(pow(small, -1, int(_PRIME)), size))
        if size <= 10 * PIECE_BYTES:  # an outsized text's tables are not kept
            _powers[kind] = have
    return have


class Prefixes:
    """Prefix hashes of a sequence of 64-bit values; hashes of any of its parts."""

    def __init__(self, values: np.ndarray, kind: str):
        n = len(values)
        up, self.down, small_up, self.small_down = powers(kind, n + 1)
        self.sums, self.small_sums = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint32)
        np.cumsum(values * up[:n], out=self.sums[1:])
        # Below 2**31 each, so a stretch's sums stay exact; a stretch at a time keeps the working memory small.
        for first in range(0, n, PIECE_BYTES):
            last = min(first + PIECE_BYTES, n)
            terms = _folded((values[first:last] >> np.uint64(33)) * small_up[first:last])
            self.small_sums[first + 1:last + 1] = _folded(np.cumsum(terms) + self.small_sums[first].astype(np.uint64))

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        wide = (self.sums[end] - self.sums[start]) * self.down[start]
        small = _folded(_folded(self.small_sums[end] + _PRIME - self.small_sums[start]) * self.small_down[start])
        small[small == _PRIME] = 0
        return mix(wide + small * np.uint64(_ODD))


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUES[data]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together, or one text."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of several texts; each text's first word (and the total)."""
    solid = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    left, right = edge[:-1].copy(), edge[1:].copy()
    left[1:] |= ~solid[:-1]
    right[:-1] |= ~solid[1:]
    starts, ends = np.flatnonzero(solid & left), np.flatnonzero(solid & right) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def distinct_parts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For each part of some bytes its number among the distinct ones, and these. Parts are in order and do not overlap."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    if offsets[-1] < len(data):
        steps = np.zeros(len(data) + 1, np.int8)
        steps[starts] += 1
        steps[ends] -= 1
        data = data[np.cumsum(steps[:-1], dtype=np.int8).view(bool)]
    parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    coded = parts.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def word_hashes(data: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of several texts, and each text's first word (and the total).

    A text of any length is hashed in parts that end at white space; only a single
    word longer than a part needs arrays of its own size.
    """
    if len(data) <= 2 * PIECE_BYTES:
        starts, ends, firsts = word_bounds(data, bounds)
        found = Prefixes(byte_values(_LOWER[data] if lower else data), "byte").part(starts, ends)
        return found, firsts
    spaces, cuts = np.flatnonzero(_SPACE[data]), [0]
    while cuts[-1] < len(data):
        at = np.searchsorted(spaces, cuts[-1] + PIECE_BYTES)
        cuts.append(int(spaces[at]) + 1 if at < len(spaces) else len(data))
    cuts = np.unique(np.concatenate([cuts, bounds]))
    found, firsts, total = [], np.zeros(len(bounds), np.int64), 0
    counts = {0: 0}
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = data[a:b]
        starts, ends, _ = word_bounds(part, np.array([0, len(part)]))
        found.append(Prefixes(byte_values(_LOWER[part] if lower else part), "byte").part(starts, ends))
        total += len(starts)
        counts[int(b)] = total
    firsts[:] = [counts[int(b)] for b in bounds]
    return np.concatenate(found) if found else np.zeros(0, np.uint64), firsts


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` values, the place of the smallest; the leftmost on ties.

    Values are compared by their upper 32 bits.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    low = (values & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(values), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    return (np.minimum(low[:n], low[width - span:width - span + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
