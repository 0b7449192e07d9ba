"""Removal of long byte strings that occur more than once: anchored runs, then hash-compared suffix sorts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carelake.llm.arrays import Prefixes, byte_values, text_bytes
from carelake.llm.prefix_sums import shuffle_partitions
from carelake.llm.runs import RUNS, emit_runs, merge_intervals, single_bytes
from carelake.llm.substring_dedup import keyed
from carelake.llm.suffix_sort import KINDS, Extensions, sort_suffixes
from carelake.session import stored

LENGTH = 400
GRAM = 100
# An anchor with more different runs than this has its windows counted in Spark.
CROWD = 4096
BLOCK_BYTES = 6_000_000

REGIONS = T.StructType([
    T.StructField("anchor", T.LongType()), T.StructField("n", T.LongType()), T.StructField("doc", T.LongType()),
    T.StructField("copy", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("at", T.IntegerType()),
    T.StructField("crowd", T.LongType()), T.StructField("region", T.BinaryType())])
# ``times`` equal runs that follow each other are one row.
SERIES = T.StructType([*RUNS.fields, T.StructField("times", T.IntegerType())])
SPAN = T.StructType([T.StructField("doc", T.LongType()), T.StructField("copy", T.LongType()),
                     T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def emit_series(length: int, gram: int):
    """A task over (doc, copy, text) that emits its runs; a pattern repeated in a text gives one row, not one for each time."""
    emit = emit_runs(single_bytes, length, gram)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in emit(batches):
            doc, copy, start, windows, _, anchor, run = (c.to_numpy() for c in batch.columns)
            fresh = np.ones(len(start), bool)
            fresh[1:] = start[1:] != start[:-1] + windows[:-1]
            for same in (doc, copy, anchor, run):
                fresh[1:] |= same[1:] != same[:-1]
            first = np.flatnonzero(fresh)
            times = np.diff(np.append(first, len(start))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(first)).columns, pa.array(times)], names=SERIES.names)

    return scan


def regions(documents: DataFrame, asked: DataFrame, length: int) -> DataFrame:
    """The bytes of all windows of the runs asked for, a row for each run."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            lists = batch.column(3)
            counts = lists.value_lengths().to_numpy()
            runs, owner = lists.flatten(), np.repeat(np.arange(len(counts)), counts)
            start, windows = (runs.field(c).to_numpy().astype(np.int64) for c in ("start", "windows"))
            begin = offsets[owner] + start
            blob = [data[a:b].tobytes() for a, b in zip(begin, begin + windows - 1 + length)]
            yield pa.RecordBatch.from_arrays(
                [runs.field("anchor"), runs.field("n"), batch.column(0).take(pa.array(owner)), batch.column(1).take(pa.array(owner)),
                 runs.field("start"), runs.field("at"), runs.field("crowd"), pa.array(blob, pa.binary())], names=REGIONS.names)

    return (keyed(documents).join(asked, ["doc", "copy"]).select("doc", "copy", "text", "asked")
            .mapInArrow(scan, REGIONS))


def shared_extents(groups: np.ndarray, single: np.ndarray, at: np.ndarray, ends: np.ndarray, data: np.ndarray,
                   length: int, gram: int, kind: str) -> tuple[np.ndarray, np.ndarray, list[tuple]]:
    """For each run that occurs once: how far left and right of its anchor windows go that a run of its group shares.

    Runs of a group have equal anchors. Sorted by what follows the anchor, runs
    farther apart share less to the right; so the first neighbour whose common
    extensions to both sides make a whole window has the farthest right end, and
    in the order of what precedes the anchor, the farthest left end. What lies
    between is covered by the two. Returns both extents (-1: none) and the pairs
    they come from, to be verified.
    """
    begins = np.concatenate([[0], ends[:-1]])
    anchor, need = begins + at, length - gram
    right_start, right_length = anchor + gram, ends - anchor - gram
    total = int(ends[-1])
    left_start, left_length = total - anchor, at
    ahead, back = Extensions(data, kind), Extensions(data[::-1], kind)

    def right(a, b):
        return ahead.common(right_start[a], right_start[b], np.minimum(right_length[a], right_length[b]))

    def left(a, b):
        return back.common(left_start[a], left_start[b], np.minimum(left_length[a], left_length[b]))

    orders = [sort_suffixes(ahead, right_start, right_length, groups), sort_suffixes(back, left_start, left_length, groups)]
    neighbours = []
    for order, extend in zip(orders, (right, left)):
        same = groups[order[1:]] == groups[order[:-1]]
        lcp = np.where(same, extend(order[:-1], order[1:]), -1)
        neighbours.append(lcp)
    best = []
    for order, lcp in zip(orders, neighbours):
        most = np.maximum(np.append(lcp, -1), np.append(-1, lcp))
        out = np.empty(len(order), np.int64)
        out[order] = most
        best.append(out)
    extents, pairs = [], []
    for side, (order, lcp, other) in enumerate(zip(orders, neighbours, (left, right))):
        found = np.full(len(order), -1, np.int64)
        partner, opposite = np.full(len(order), -1, np.int64), np.zeros(len(order), np.int64)
        for step in (1, -1):
            active = np.flatnonzero(single[order])
            reach, shift = np.full(len(active), length, np.int64), 0
            while len(active):
                shift += step
                inside = (active + shift >= 0) & (active + shift < len(order))
                active, reach = active[inside], reach[inside]
                reach = np.minimum(reach, lcp[active + shift - 1] if step > 0 else lcp[active + shift])
                me = order[active]
                hope = (reach >= 0) & (reach + best[1 - side][me] >= need) & (reach > found[me])
                active, reach, me = active[hope], reach[hope], me[hope]
                if not len(active):
                    break
                across = other(me, order[active + shift])
                met = across + reach >= need
                found[me[met]], partner[me[met]], opposite[me[met]] = reach[met], order[active + shift][met], across[met]
                active, reach = active[~met], reach[~met]
        extents.append(found)
        who = np.flatnonzero(found >= 0)
        l, r = (opposite, found) if side == 0 else (found, opposite)
        pairs += [(anchor[w] - l[w], anchor[partner[w]] - l[w], l[w] + gram + r[w]) for w in who]
    return extents[1], extents[0], pairs


def verified_extents(groups, single, at, ends, data, length, gram):
    """``shared_extents``, with every pair's bytes compared; another hash is taken should one be wrong."""
    for kind in KINDS:
        left, right, pairs = shared_extents(groups, single, at, ends, data, length, gram, kind)
        blob = data.tobytes()
        if all(blob[a:a + n] == blob[b:b + n] for a, b, n in pairs):
            return left, right
    raise ValueError("equal hashes of different strings for every base")


def suffix_spans(length: int, gram: int):
    """A task over regions sorted by anchor: the bytes of once-met runs that another run shares."""
    def finish(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows).combine_chunks()
        number = {c: table[c].to_numpy().astype(np.int64) for c in ("anchor", "n", "start", "at", "doc", "copy")}
        data, offsets = text_bytes(table["region"])
        left, right = verified_extents(number["anchor"], number["n"] == 1, number["at"], offsets[1:], data, length, gram)
        keep = left >= 0
        place = number["start"] + number["at"]
        return pa.RecordBatch.from_arrays(
            [pa.array(x[keep]) for x in (number["doc"], number["copy"], place - left, place + gram + right)], names=SPAN.names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            if not len(batch):
                continue
            waiting.append(batch)
            size += batch.nbytes
            if size > BLOCK_BYTES:  # all but the last anchor, which can go on
                table = pa.Table.from_batches(waiting).combine_chunks()
                anchors = table["anchor"].to_numpy()
                cut = int(np.searchsorted(anchors, anchors[-1]))
                if cut:
                    yield finish(table.slice(0, cut).to_batches())
                    waiting = table.slice(cut).to_batches()
                    size = sum(b.nbytes for b in waiting)
        if waiting:
            yield finish(waiting)

    return scan


def window_counts(crowded: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many runs, by counting each window in Spark."""
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("window_hash", T.LongType()),
                           T.StructField("n", T.LongType()), T.StructField("doc", T.LongType()),
                           T.StructField("copy", T.LongType()), T.StructField("start", T.LongType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                region = np.frombuffer(batch.column(7)[i].as_buffer(), np.uint8)
                begin = np.arange(len(region) - length + 1)
                hashes = Prefixes(byte_values(region), "window").part(begin, begin + length)
                fixed = [np.full(len(begin), batch.column(c)[i].as_py(), np.int64) for c in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (fixed[0], hashes.astype(np.int64), fixed[1], fixed[2], fixed[3], fixed[4] + begin)],
                    names=schema.names)

    windows = stored(crowded.mapInArrow(scan, schema), "crowded-windows")
    twice = windows.groupBy("anchor", "window_hash").agg(F.sum("n").alias("many")).where("many > 1").drop("many")
    return (windows.where("n = 1").join(twice, ["anchor", "window_hash"])
            .select("doc", "copy", "start", (F.col("start") + length).alias("end")))


def repeated_spans(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, copy, spans): per document all bytes in strings of ``length`` bytes that start twice or more anywhere.

    1. Runs of windows with one anchor are counted, equal ones in a row as one row; anchors met once are done with.
    2. A run met twice or more goes in all its copies.
    3. A run met once can still share windows with other runs of its anchor. One
       copy of each such run is sorted by what follows and what precedes the
       anchor, and its farthest shared windows are found among its neighbours.
    Counting is by partial aggregates; joins back to them can be split.
    """
    runs = stored(keyed(documents).mapInArrow(emit_series(length, gram), SERIES), "byte-runs")
    shared = runs.groupBy("anchor").agg(F.sum("times").alias("many")).where("many > 1").select(F.col("anchor").alias("shared_anchor"))
    # The null-safe comparison, here and below, shuffles the aggregate anew; only then can a hot anchor's runs be split.
    live = stored(runs.join(shared, F.col("anchor").eqNullSafe(F.col("shared_anchor"))).drop("shared_anchor"), "live-byte-runs")
    kinds = stored(live.groupBy("anchor", "run").agg(
        F.sum("times").alias("n"), F.min(F.struct("doc", "copy", "start", "windows", "at")).alias("head"))
        .select("anchor", "run", "n", "head.*"), "byte-run-kinds")
    mixed = (kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("crowd"), F.min("n").alias("fewest"))
             .where("crowd > 1 and fewest = 1").select(F.col("anchor").alias("mixed_anchor"), "crowd"))
    asked = (kinds.join(mixed, F.col("anchor").eqNullSafe(F.col("mixed_anchor"))).groupBy("doc", "copy")
             .agg(F.collect_list(F.struct("anchor", "n", "start", "windows", "at", "crowd")).alias("asked")))
    parts = stored(regions(documents, asked, length), "byte-regions")
    sorted_ = (parts.where(F.col("crowd") <= CROWD).repartition(shuffle_partitions(documents), "anchor")
               .sortWithinPartitions("anchor").mapInArrow(suffix_spans(length, gram), SPAN))
    counted = window_counts(parts.where(F.col("crowd") > CROWD), length)
    whole = (live.join(kinds.where("n > 1").select("anchor", "run"), ["anchor", "run"])
             .select("doc", "copy", F.col("start").cast("long"),
                     (F.col("start") + F.col("times") * F.col("windows") - 1 + length).cast("long").alias("end")))
    # A document has no more spans than bytes.
    return (whole.unionByName(sorted_).unionByName(counted).groupBy("doc", "copy")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans")))


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Columns (doc_id, text) -> one row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes when a string of ``length`` bytes that covers it also starts
    elsewhere, in this document or another. Strings are judged on the input and
    lie inside one document. Texts that are shorter, empty or null lose nothing.
    Repeated rows are copies of each other. A null doc_id stays null; extra
    columns are ignored.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                           T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            sizes, removed, counts, kept = np.diff(offsets), [], [], []
            for i, spans in enumerate(batch.column(2)):
                text = data[offsets[i]:offsets[i + 1]]
                starts = ends = np.zeros(0, np.int64)
                if spans.is_valid:
                    starts, ends = merge_intervals(spans.values.field("start").to_numpy(), spans.values.field("end").to_numpy())
                stay = [text[a:b].tobytes() for a, b in zip(np.append(0, ends), np.append(starts, len(text)))]
                removed.append(int((ends - starts).sum()))
                counts.append(len(starts))
                kept.append(b"".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()),
                 pa.array(kept, pa.binary())], names=schema.names)

    spans = repeated_spans(documents, length, gram)
    rows = keyed(documents).withColumn("doc_id", F.when(F.col("doc") != (1 << 63) - 1, F.col("doc")))
    return rows.join(spans, ["doc", "copy"], "left").select("doc_id", "text", "spans").mapInArrow(cut, schema)
