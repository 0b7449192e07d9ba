"""Removal of long word sequences that an earlier document has: hashes of every fixed-length window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carelake.llm.arrays import Prefixes, pieces, text_bytes, word_bounds
from carelake.llm.runs import RUNS, emit_runs, merge_intervals, values_of, words
from carelake.session import stored

WINDOW = 50
GRAM = 14
NO_ID = (1 << 63) - 1


def keyed(documents: DataFrame) -> DataFrame:
    """(doc, copy, text): the id, null as the largest, and a digest that tells rows of one id apart."""
    return documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
                            F.xxhash64("text").alias("copy"), "text")


def window_rows(documents: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """The hash of every window of the runs asked for: (anchor, window_hash, doc, run, offset within the run).

    ``asked`` has a row for each document with an array of its (start, windows, anchor, run).
    """
    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("window_hash", T.LongType()),
                           T.StructField("doc", T.LongType()), T.StructField("run", T.LongType()),
                           T.StructField("offset", T.IntegerType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = batch.column(0).to_numpy()
            lists = batch.column(2)
            data, offsets = text_bytes(batch.column(1))
            for first, last in pieces(offsets):
                hashes, firsts = words(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
                part = lists.slice(first, last - first)
                runs = part.flatten()
                owner = np.repeat(np.arange(last - first), part.value_lengths().to_numpy())
                start = runs.field("start").to_numpy().astype(np.int64)
                count = runs.field("windows").to_numpy().astype(np.int64)
                every = np.repeat(np.arange(len(owner)), count)
                offset = np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count)
                begin = firsts[owner[every]] + start[every] + offset
                found = Prefixes(values_of(hashes), "window").part(begin, begin + window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(runs.field("anchor").to_numpy()[every]), pa.array(found.astype(np.int64)),
                     pa.array(docs[first + owner[every]]), pa.array(runs.field("run").to_numpy()[every]),
                     pa.array(offset.astype(np.int32))], names=schema.names)

    rows = keyed(documents).join(asked, ["doc", "copy"]).select("doc", "text", "asked")
    return rows.mapInArrow(scan, schema)


def repeated_spans(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, copy, spans): per document the runs of windows that also start in a document with a smaller id.

    1. Runs are counted by anchor; anchors of one document only are done with.
    2. Among the rest, equal runs are grouped to their smallest document; any
       later document loses all of the run's windows.
    3. The smallest document's own copy of a run can still hold windows that a
       different run with the same anchor has in a smaller document. There the
       windows are hashed one by one, one copy of each different run, and
       grouped to their smallest document. What is found holds wherever the
       smallest document, or another row with its id, has the run.
    All groups are partial aggregates, and joins back to them can be split, so a
    passage that a third of the documents share needs no task of its own.
    """
    runs = stored(keyed(documents).mapInArrow(emit_runs(words, window, gram), RUNS), "runs")
    shared = (runs.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
              .where("low < high").select(F.col("anchor").alias("shared_anchor"), "low"))
    # The null-safe comparison shuffles the aggregate anew; only then can a hot anchor's runs be split.
    live = stored(runs.join(shared, F.col("anchor").eqNullSafe(F.col("shared_anchor"))).drop("shared_anchor"), "live-runs")
    kinds = live.groupBy("anchor", "run", "low").agg(
        F.min(F.struct("doc", "copy", "start", "windows")).alias("head"))
    heads = stored(kinds.select("anchor", "run", "low", "head.*"), "run-heads")
    # Runs met first in a later document than their anchor, and all that could cover them.
    doubtful = heads.where("doc > low").select("anchor").distinct()
    asked = (heads.join(doubtful, "anchor").groupBy("doc", "copy")
             .agg(F.collect_list(F.struct("start", "windows", "anchor", "run")).alias("asked")))
    singles = stored(window_rows(documents, asked, window), "windows")
    earliest = singles.groupBy("anchor", "window_hash").agg(F.min("doc").alias("least"), F.max("doc").alias("most"))
    # Windows of one run share a gram, so a list has fewer than window - gram + 2 places. Stored, so a hot run's places can be split.
    met = stored(singles.join(earliest.where("least < most"), ["anchor", "window_hash"]).where("doc > least")
                 .groupBy("anchor", "run", "doc").agg(F.collect_set("offset").alias("offsets")), "repeated-windows")
    partly = (live.join(met, ["anchor", "run", "doc"]).select("doc", "copy", "start", F.explode("offsets").alias("offset"))
              .select("doc", "copy", (F.col("start") + F.col("offset")).alias("start"), F.lit(1).alias("windows")))
    firsts = heads.select("anchor", "run", F.col("doc").alias("head_doc"))
    wholly = (live.join(firsts, ["anchor", "run"]).where("doc > head_doc").select("doc", "copy", "start", "windows"))
    # A document has no more spans than windows, so the lists are bounded by its text.
    return (wholly.unionByName(partly).groupBy("doc", "copy")
            .agg(F.collect_set(F.struct("start", "windows")).alias("spans")))


def remove_repeats(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """All columns of ``documents`` with n_words, n_removed and kept_text: its kept words joined by one space.

    A word goes when a window of ``window`` words that covers it also starts in
    a document with a smaller doc_id. Windows are judged on the input. Texts with
    fewer words, empty and null texts lose nothing. A null doc_id counts as
    larger than all others; rows with one doc_id don't count against each other.
    Columns named doc, copy, spans, n_words, n_removed or kept_text are replaced.
    """
    spans = repeated_spans(documents, window, gram)
    own = {"doc", "copy", "spans", "n_words", "n_removed", "kept_text"}
    plain = documents.drop(*own)
    rows = (plain.withColumns({"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "copy": F.xxhash64("text")})
            .join(spans, ["doc", "copy"], "left").drop("doc", "copy"))
    schema = T.StructType([*plain.schema.fields, T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    carried = len(plain.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            column, lists = batch.column(names.index("text")), batch.column(names.index("spans"))
            counts, removed, kept = [], [], []
            data, offsets = text_bytes(column)
            for i in range(len(column)):
                text = data[offsets[i]:offsets[i + 1]]
                starts, ends, _ = word_bounds(text, np.array([0, len(text)]))
                stay = np.ones(len(starts), bool)
                if lists[i].is_valid:
                    own_spans = lists[i].values
                    first = own_spans.field("start").to_numpy().astype(np.int64)
                    last = first + own_spans.field("windows").to_numpy() - 1 + window
                    for a, b in zip(*merge_intervals(first, last)):
                        stay[a:b] = False
                counts.append(len(starts))
                removed.append(len(starts) - int(stay.sum()))
                kept.append(_joined(text, starts[stay], ends[stay]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:carried], pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=schema.names)

    return rows.select(*plain.columns, "spans").mapInArrow(cut, schema)


def _joined(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words at some places of a text, joined by one space."""
    if not len(starts):
        return b""
    lengths = ends - starts + 1
    ahead = np.cumsum(lengths) - lengths
    take = np.repeat(starts - ahead, lengths) + np.arange(int(lengths.sum()))
    padded = np.append(text, np.uint8(32))
    out = padded[np.minimum(take, len(text))]
    out[ahead + lengths - 1] = 32
    return out[:-1].tobytes()
