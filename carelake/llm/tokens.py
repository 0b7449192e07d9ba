"""Ids of whole texts from a public tokenizer, with a memory of segments.

Splitting a text before encoding changes nothing where the tokenizer itself
always splits: then every distinct segment is encoded once per worker.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa

from carelake.llm.arrays import Prefixes, byte_values, distinct_parts, pieces, text_bytes, word_bounds

# Segments remembered by a worker before it starts anew.
REMEMBERED = 1_000_000
# Segments handed to the tokenizer at a time.
LEARNED = 20_000
# Words encoded as one text, and marks to tell them apart by.
TOGETHER, MARKS = 64, ("\u2021", "\u00b6", "\u00a7", "^", "~", "\\")
# Bytes that white space, in the widest sense, can begin with in UTF-8.
_MAYBE_SPACE = np.zeros(256, bool)
_MAYBE_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = True


def _spaced_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segments that begin at a text's start or at a space that no white space follows."""
    begins = np.zeros(len(data) + 1, bool)
    begins[:-2] = (data[:-1] == 0x20) & ~_MAYBE_SPACE[data[1:]] if len(data) > 1 else False
    edges = bounds[:-1][np.diff(bounds) > 0]
    # A space at the end of a text is followed by another text's bytes, not its own.
    begins[bounds[1:][np.diff(bounds) > 0] - 1] = False
    begins[edges] = True
    starts = np.flatnonzero(begins[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(starts, bounds)


class Numbers:
    """Numbers 0, 1, ... of distinct 64-bit keys in the order they came.

    An open-addressing table of arrays, asked for many keys at a time. At most
    half of its places are taken, so a key is found in a few steps.
    """

    def __init__(self, most: int):
        size = 1 << (2 * most - 1).bit_length()
        self.mask, self.most, self.count = np.uint64(size - 1), most, 0
        self.keys, self.numbers = np.zeros(size, np.uint64), np.zeros(size, np.int32)  # a free place has 0, others number + 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 if unknown."""
        out, left, at = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys & self.mask
        while len(left):
            number = self.numbers[at]
            same = (number > 0) & (self.keys[at] == keys[left])
            out[left[same]] = number[same] - 1
            on = (number > 0) & ~same
            left, at = left[on], (at[on] + np.uint64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give the next numbers to distinct keys that are unknown so far."""
        own = np.arange(self.count + 1, self.count + 1 + len(keys), dtype=np.int32)
        left, at = np.arange(len(keys)), keys & self.mask
        while len(left):
            free = self.numbers[at] == 0
            self.numbers[at[free]] = own[left[free]]  # of several keys for one place one stays, the others go on
            won = self.numbers[at] == own[left]
            self.keys[at[won]] = keys[left[won]]
            left, at = left[~won], (at[~won] + np.uint64(1)) & self.mask
        self.count += len(keys)


class TokenBytes:
    """Encodes texts to ids, four bytes each in little-endian order.

    A byte-level tokenizer joins a space to the word behind it, so its texts are
    split before a space that no white space follows. One that drops white space
    and treats words apart takes the words between ASCII white space. A text that
    holds the name of a special token is encoded as a whole, as the spaces beside
    it matter. Segments are remembered by a 64-bit hash and their length.

    New words are encoded several at once with a mark behind each, because a text
    costs the tokenizer more than a word. Where the mark's id comes from a word as
    well, the words are encoded one by one.
    """

    _open: dict[str, "TokenBytes"] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        apart = self.tokenizer.encode("a  b", add_special_tokens=False).ids
        self.drops_space = apart == self.tokenizer.encode("a b", add_special_tokens=False).ids
        self.mark, self.mark_id = self._find_mark() if self.drops_space else (None, None)
        self._forget()

    def _find_mark(self) -> tuple[str | None, int | None]:
        for mark in MARKS:
            ids = self.tokenizer.encode(mark, add_special_tokens=False).ids
            if len(ids) == 1:
                return mark, ids[0]
        return None, None

    @classmethod
    def shared(cls, path: str) -> "TokenBytes":
        if path not in cls._open:
            cls._open[path] = cls(path)
        return cls._open[path]

    def _forget(self, most: int = REMEMBERED) -> None:
        self.known = Numbers(most)
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.starts, self.lengths = np.zeros(most, np.int64), np.zeros(most, np.int32)

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _singly(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum())), lengths

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words, several in a text."""
        groups = [texts[i:i + TOGETHER] for i in range(0, len(texts), TOGETHER)]
        joined = self.tokenizer.encode_batch_fast([f" {self.mark} ".join([*group, ""]) for group in groups], add_special_tokens=False)
        parts = []
        for group, encoded in zip(groups, joined):
            ids = np.array(encoded.ids, np.uint32)
            ends = np.flatnonzero(ids == self.mark_id)
            if len(ends) == len(group) and ends[-1] == len(ids) - 1:
                parts.append((np.delete(ids, ends), (np.diff(ends, prepend=-1) - 1).astype(np.int32)))
            else:
                parts.append(self._singly(group))
        return tuple(np.concatenate(part) for part in zip(*parts))

    def _learn(self, keys: np.ndarray, texts: Iterator[str]) -> None:
        """Encode and remember segments, a limited number at a time: the tokenizer's own results are large."""
        for first in range(0, len(keys), LEARNED):
            own = keys[first:first + LEARNED]
            ids, lengths = (self._singly if self.mark is None else self._together)(list(islice(texts, len(own))))
            n, at = len(ids), self.known.count
            if self.used + n > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros(max(n, len(self.ids) // 2), np.uint32)])
            self.ids[self.used:self.used + n] = ids
            self.starts[at:at + len(own)] = self.used + np.cumsum(lengths) - lengths
            self.lengths[at:at + len(own)] = lengths
            self.known.add(own)
            self.used += n

    def _piece(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts, and each text's first (and the total)."""
        starts, ends, firsts = (word_bounds if self.drops_space else _spaced_bounds)(data, bounds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        codes, distinct = distinct_parts(data, starts, ends)
        held, places = text_bytes(distinct)
        hashes = Prefixes(byte_values(held), "byte").part(places[:-1], places[1:]) + np.diff(places).astype(np.uint64)
        if self.known.count + len(distinct) > self.known.most:
            self._forget(max(REMEMBERED, len(distinct)))
        fresh = np.flatnonzero(self.known.find(hashes) < 0)
        blob = memoryview(held)
        self._learn(hashes[fresh], (str(blob[a:b], "utf-8", "replace") for a, b in zip(places[fresh].tolist(), places[fresh + 1].tolist())))
        slots = self.known.find(hashes)[codes]
        lengths = self.lengths[slots].astype(np.int64)
        ahead = np.concatenate([[0], np.cumsum(lengths)])
        take = np.repeat(self.starts[slots] - ahead[:-1], lengths) + np.arange(ahead[-1])
        return self.ids[take], ahead[firsts]

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text; null counts as empty."""
        data, offsets = text_bytes(column)
        for first, last in pieces(offsets):
            bounds = offsets[first:last + 1] - offsets[first]
            part = data[offsets[first]:offsets[last]]
            ids, places = self._piece(part, bounds)
            blob = part.tobytes()
            odd = any(name in blob for name in self.special)
            for i in range(last - first):
                if odd and any(name in blob[bounds[i]:bounds[i + 1]] for name in self.special):
                    yield self.whole(blob[bounds[i]:bounds[i + 1]].decode("utf-8", "replace")).tobytes()
                else:
                    yield ids[places[i]:places[i + 1]].tobytes()
