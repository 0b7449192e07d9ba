"""Packing documents into sequences: first-fit decreasing over a tournament tree of bins."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from carelake.llm.tokens import TokenBytes

SEQUENCE = 1024
END_ID = 0
GROUP_DOCUMENTS = 8192
SEED = "packing"

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


class Bins:
    """Open bins with what each still holds; a tournament tree finds the first that fits.

    A node has the larger capacity of its two children, so the leftmost bin that
    fits is found, and its new capacity recorded, in a path from root to leaf.
    """

    def __init__(self, capacity: int, most: int):
        self.leaves = 1 << max(0, math.ceil(math.log2(max(1, most))))
        self.tree = [capacity] * (2 * self.leaves)
        self.capacity = capacity

    def put(self, size: int) -> tuple[int, int]:
        """Bin and offset of an item."""
        tree, at = self.tree, 1
        while at < self.leaves:
            at *= 2
            if tree[at] < size:
                at += 1
        offset = self.capacity - tree[at]
        bin_, tree[at] = at - self.leaves, tree[at] - size
        while at > 1:
            at //= 2
            larger = max(tree[2 * at], tree[2 * at + 1])
            if tree[at] == larger:
                break
            tree[at] = larger
        return bin_, offset


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every item; ties in size keep their order."""
    bins = Bins(capacity, len(sizes))
    where = np.zeros((len(sizes), 2), np.int64)
    for i in np.argsort(-sizes, kind="stable"):
        where[i] = bins.put(int(sizes[i]))
    return where[:, 0], where[:, 1]


def cut(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """(doc_id, text) -> (doc_id, doc_tokens, digest, crcs): the ids of each piece of ``sequence`` and of the rest."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("doc_tokens", T.LongType()),
                           T.StructField("crcs", T.ArrayType(T.LongType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, step = TokenBytes.shared(tokenizer), end_id.to_bytes(4, "little"), 4 * sequence
        for batch in batches:
            lengths, crcs = [], []
            for ids in encoder.encode(batch.column(1)):
                ids += end
                lengths.append(len(ids) // 4)
                crcs.append([zlib.crc32(ids[at:at + step]) for at in range(0, len(ids), step)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))],
                names=schema.names)

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, schema)


def pack(documents: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID,
         group_documents: int = GROUP_DOCUMENTS, seed: str = SEED) -> DataFrame:
    """Columns (doc_id, text) -> one row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids and the end id are cut at every ``sequence`` ids. Full
    pieces are sequences of their own; the rests of a random group of documents
    are packed by first-fit decreasing. Groups have about ``group_documents``
    documents at any size of the table and are packed independently, so only
    narrow rows move and no task sees more than its groups.

    A null or empty text is the end id alone. Repeated rows are packed each on
    its own; rows that share doc_id, length and checksums lie in one group, in
    any order. A null doc_id stays null. An empty table gives an empty table.
    Extra columns are ignored.
    """
    groups = max(1, math.ceil(documents.count() / group_documents))
    rows = cut(documents, tokenizer, sequence, end_id)
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "crcs"), F.lit(groups))

    def place(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "doc_tokens"], kind="stable", na_position="last")
        tokens = frame["doc_tokens"].to_numpy(np.int64)
        whole, rest = tokens // sequence, tokens % sequence
        counts = whole + (rest > 0)
        owner = np.repeat(np.arange(len(tokens)), counts)
        index = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        full = index < whole[owner]
        rests = np.flatnonzero(~full)
        bins, offsets = first_fit_decreasing(rest[owner[rests]], sequence)
        sequence_of, offset = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        sequence_of[rests], offset[rests] = bins, offsets
        sequence_of[full] = (bins.max() + 1 if len(bins) else 0) + np.arange(full.sum())
        base = int(frame["pack_group"].iloc[0]) << 40
        return pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy()[owner], "start": index * sequence,
            "length": np.where(full, sequence, rest[owner]),
            "ids_crc32": np.concatenate([np.asarray(c, np.int64) for c in frame["crcs"]]),
            "doc_tokens": tokens[owner], "sequence_id": base + sequence_of, "offset": offset})

    def place_nullable(frame: pd.DataFrame) -> pd.DataFrame:
        frame["doc_id"] = frame["doc_id"].astype("Int64")
        return place(frame)

    return rows.withColumn("pack_group", group).groupBy("pack_group").applyInPandas(place_nullable, PIECES)
