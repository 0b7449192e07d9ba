"""Repeated windows of a corpus, found through runs of windows that share an anchor.

Every window of ``length`` tokens has an anchor: of its grams of ``gram`` tokens,
the one with the smallest hash, the leftmost of several. Equal windows have the same anchor at the same
place. Consecutive windows of one document with one anchor form a run, so a
corpus of n tokens has about 2 n / (length - gram) runs, and these, not the
windows, are counted in Spark. Windows of runs that repeat only in part are
then counted singly.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T

from carelake.llm.arrays import Prefixes, byte_values, mix, pieces, sliding_argmin, text_bytes, word_hashes

# (bytes, text bounds) -> (token values, first token of each text and the total)
Tokens = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
# Windows of a long document are taken in stretches, which bounds a task's arrays.
STRETCH = 1_000_000


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(data, bounds)


def single_bytes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data, bounds


def values_of(tokens: np.ndarray) -> np.ndarray:
    """64-bit values of tokens: bytes get theirs, hashes are values already."""
    return byte_values(tokens) if tokens.dtype == np.uint8 else tokens


def runs_of(values: np.ndarray, firsts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document, first window within the document, windows, anchor's place in that window, anchor hash, run hash) of each run."""
    n = len(values) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    grams = Prefixes(values, "gram")
    starts = np.arange(len(values) - gram + 1)
    gram_hashes = grams.part(starts, starts + gram)
    anchors = sliding_argmin(gram_hashes, length - gram + 1)
    owner = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    inside = owner[:n] == owner[length - 1:]
    change = np.ones(n, bool)
    change[1:] = (anchors[1:] != anchors[:-1]) | (owner[1:n] != owner[:n - 1]) | ~inside[:-1]
    begin = np.flatnonzero(change & inside)
    if not len(begin):
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    stops = np.flatnonzero(np.append(change | ~inside, True))
    end = stops[np.searchsorted(stops, begin, side="right")]
    whole = Prefixes(values, "run").part(begin, end - 1 + length) + (end - begin).astype(np.uint64)
    return (owner[begin], begin - firsts[owner[begin]], end - begin, anchors[begin] - begin,
            gram_hashes[anchors[begin]].astype(np.int64), mix(whole).astype(np.int64))


def each_stretch(values: np.ndarray, firsts: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """The tokens of some documents, or of one long document in overlapping stretches with their offset."""
    if len(firsts) > 2 or len(values) <= STRETCH + length:
        yield values, firsts, 0
        return
    for at in range(0, len(values) - length + 1, STRETCH):
        part = values[at:at + STRETCH + length - 1]
        yield part, np.array([0, len(part)]), at


RUNS = T.StructType([
    T.StructField("doc", T.LongType()), T.StructField("copy", T.LongType()), T.StructField("start", T.IntegerType()),
    T.StructField("windows", T.IntegerType()), T.StructField("at", T.IntegerType()), T.StructField("anchor", T.LongType()), T.StructField("run", T.LongType())])


def emit_runs(tokens: Tokens, length: int, gram: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task over (doc, copy, text) that emits the runs of each text."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)]
            data, offsets = text_bytes(batch.column(2))
            for first, last in pieces(offsets):
                found, firsts = tokens(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                for part, bounds, ahead in each_stretch(found, firsts, length):
                    owner, start, windows, at, anchor, run = runs_of(values_of(part), bounds, length, gram)
                    if len(owner):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[0][first + owner]), pa.array(ids[1][first + owner]),
                             pa.array((start + ahead).astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(at.astype(np.int32)),
                             pa.array(anchor), pa.array(run)], names=RUNS.names)

    return scan


def merge_intervals(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals joined where they overlap or touch, in order."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.append(True, starts[1:] > ends[:-1])
    return starts[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)]
