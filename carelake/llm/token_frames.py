"""Token files: independent zstandard frames with a trailing seek table.

A file is a sequence of zstandard frames, each with its own checksum, and empty
skippable frames between them; its last frame is a skippable one that holds the
seek table. Any zstandard tool can decompress the whole. A reader takes the
table from the end of the file and decompresses only frames it needs.

Files are written by Spark's own text writer, whose line separator is the empty
skippable frame, so any store that Spark writes to will do, and a task that is
run again leaves no second copy.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from carelake.llm.prefix_sums import part_starts, shuffle_partitions
from carelake.llm.tokens import TokenBytes
from carelake.session import scratch_path, stored

FRAME_IDS = 65_536
LEVEL = 3
END_ID = 1

# Fixed values of the formats.
SEPARATOR = b"P*M\x18\0\0\0\0"
TABLE_MAGIC = b"^*M\x18"
FOOTER = struct.Struct("<QIIB7s")  # documents, frames, part, bytes per id, mark
MARK = b"idframe"
FRAME = np.dtype([("offset", "<u8"), ("size", "<u8"), ("ids", "<u8"), ("checksum", "<u8")])
DOCUMENT = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("ids", "<u8")])


class Table(NamedTuple):
    part: int
    width: int
    frames: np.ndarray
    documents: np.ndarray


def encode_table(table: Table) -> bytes:
    body = (table.frames.tobytes() + table.documents.tobytes()
            + FOOTER.pack(len(table.documents), len(table.frames), table.part, table.width, MARK))
    return TABLE_MAGIC + struct.pack("<I", len(body)) + body


def read_table(content: bytes) -> Table:
    """The seek table at the end of a file."""
    end = len(content) - len(SEPARATOR)
    if content[end:] != SEPARATOR:
        raise ValueError("the file does not end with an empty frame")
    n_documents, n_frames, part, width, mark = FOOTER.unpack(content[end - FOOTER.size:end])
    if mark != MARK:
        raise ValueError("the file has no seek table")
    at = end - FOOTER.size - n_documents * DOCUMENT.itemsize
    documents = np.frombuffer(content, DOCUMENT, n_documents, at)
    frames = np.frombuffer(content, FRAME, n_frames, at - n_frames * FRAME.itemsize)
    return Table(part, width, frames, documents)


def read_frame(content: bytes, table: Table, frame: int) -> np.ndarray:
    """The ids of one frame, after both checksums held."""
    entry = table.frames[frame]
    packed = content[int(entry["offset"]):int(entry["offset"] + entry["size"])]
    if xxhash.xxh64_intdigest(packed) != int(entry["checksum"]):
        raise ValueError(f"frame {frame} is damaged")
    plain = zstandard.ZstdDecompressor().decompress(packed, max_output_size=int(entry["ids"]) * table.width)
    return np.frombuffer(plain, f"<u{table.width}").astype("<u4")


def read_documents(content: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
    """Documents of a file in order, or only the wanted ones; frames without any stay packed."""
    table = read_table(content)
    owners = table.documents["frame"]
    for frame in range(len(table.frames)):
        own = table.documents[np.searchsorted(owners, frame):np.searchsorted(owners, frame, side="right")]
        if wanted is not None:
            own_ids = {int(d["doc_id"]) for d in own if d["known"]}
            if not own_ids & wanted:
                continue
        ids, at = read_frame(content, table, frame), 0
        for d in own:
            n = int(d["ids"])
            if wanted is None or (d["known"] and int(d["doc_id"]) in wanted):
                yield (int(d["doc_id"]) if d["known"] else None), ids[at:at + n]
            at += n


class FileBuilder:
    """Turns documents into the rows of one file."""

    def __init__(self, part: int, width: int, frame_ids: int, level: int):
        self.part, self.width, self.frame_ids = part, width, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames: list[tuple] = []
        self.documents: list[tuple] = []
        self.waiting: list[bytes] = []
        self.waiting_ids, self.offset = 0, 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[bytes]:
        self.documents.append((doc_id or 0, doc_id is not None, len(self.frames), len(ids)))
        self.waiting.append(ids.astype(f"<u{self.width}").tobytes())
        self.waiting_ids += len(ids)
        if self.waiting_ids >= self.frame_ids:
            yield self._frame()

    def _frame(self) -> bytes:
        packed = self.packer.compress(b"".join(self.waiting))
        self.frames.append((self.offset, len(packed), self.waiting_ids, xxhash.xxh64_intdigest(packed)))
        self.offset += len(packed) + len(SEPARATOR)
        self.waiting, self.waiting_ids = [], 0
        return packed

    def finish(self) -> Iterator[bytes]:
        if self.waiting:
            yield self._frame()
        if self.documents:
            yield encode_table(Table(self.part, self.width, np.array(self.frames, FRAME),
                                     np.array(self.documents, DOCUMENT)))


def write_ids(documents: DataFrame, path: str, tokenizer: str, end_id: int | None = END_ID,
              frame_ids: int = FRAME_IDS, level: int = LEVEL) -> None:
    """Encode (doc_id, text) and write token files in ascending doc_id order.

    Texts are sorted by range, encoded and packed in the same task: one shuffle.
    A frame holds whole documents, as many as reach ``frame_ids``; a longer
    document is a frame of its own. Null texts are empty, a null doc_id sorts
    first, repeated rows are written each. Rows with one doc_id are ordered by
    text. Nothing but an empty folder is written for an empty table.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = TokenBytes.shared(tokenizer)
        top = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id or 0)
        builder = FileBuilder(TaskContext.get().partitionId(), 2 if top < 1 << 16 else 4, frame_ids, level)
        end = b"" if end_id is None else end_id.to_bytes(4, "little")
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1))):
                rows.extend(builder.add(doc_id, np.frombuffer(ids + end, "<u4")))
                if len(rows) >= 64:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["frame"])
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["frame"])
        rest = list(builder.finish())
        if rest:
            yield pa.RecordBatch.from_arrays([pa.array(rest, pa.binary())], names=["frame"])

    n = shuffle_partitions(documents)
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    frames = ordered.mapInArrow(encode, T.StructType([T.StructField("frame", T.BinaryType())]))
    frames.select(F.col("frame").cast("string")).write.option("lineSep", SEPARATOR.decode()).text(path)


INDEX = T.StructType([T.StructField("part", T.LongType()), T.StructField("place", T.LongType()),
                      T.StructField("doc_id", T.LongType()), T.StructField("inside", T.LongType()),
                      T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files in a folder, decoded: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it, in all files.
    """
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                content = value.as_py()
                if not content:
                    continue
                part, rows, start = read_table(content).part, [], 0
                for place, (doc_id, ids) in enumerate(read_documents(content)):
                    rows.append((part, place, doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=INDEX.names)

    files = spark.read.format("binaryFile").load(path).select("content")
    rows = stored(files.mapInArrow(decode, INDEX), "token-index")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    starts = part_starts(totals, "part", "total", "part_start")  # one row per file
    return rows.join(starts, "part").select(
        "doc_id", (F.col("part_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_index(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write token files to the shared folder and read their documents back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-files")
    write_ids(documents, path, tokenizer, end_id)
    return read_index(spark, path)
