"""Splitting documents into chunks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Chunk geometry and the separators tried from coarse to fine.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
SEPARATORS = ("\n\n", "\n", " ", "")

_BATCH_CHARS = 1 << 20
CHUNK_SCHEMA = "doc_id bigint, chunk_no int, chunk string"


def _atoms(text: str, level: int) -> list[str]:
    """Pieces of a text after its coarsest separator, each starting with it."""
    separator = SEPARATORS[level]
    head, *tail = text.split(separator)
    return [piece for piece in (head, *(separator + t for t in tail)) if piece]


def _pack(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Greedy runs of pieces up to the size; a run starts with the previous
    run's last pieces as far as these fit the overlap and leave room."""
    start, width = 0, 0
    for end, piece in enumerate(pieces):
        if width + len(piece) > size and end > start:
            yield "".join(pieces[start:end])
            while start < end and (width > overlap or width + len(piece) > size):
                width -= len(pieces[start])
                start += 1
        width += len(piece)
    if start < len(pieces):
        yield "".join(pieces[start:])


def _windows(text: str, size: int, overlap: int) -> Iterator[str]:
    """What packing single characters comes to, without a list of them: a text without separators can be long."""
    start, back = 0, min(overlap, size - 1)
    while text:
        yield text[start:start + size]
        if start + size >= len(text):
            return
        start += size - back


def split_text(text: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, level: int = 0) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that works."""
    while level < len(SEPARATORS) - 1 and SEPARATORS[level] not in text:
        level += 1
    if SEPARATORS[level] == "":
        return [stripped for chunk in _windows(text, size, overlap) if (stripped := chunk.strip())]
    chunks: list[str] = []
    run: list[str] = []
    for atom in _atoms(text, level):
        if len(atom) < size:
            run.append(atom)
            continue
        chunks.extend(_pack(run, size, overlap))
        run = []
        chunks.extend(split_text(atom, size, overlap, level + 1))
    chunks.extend(_pack(run, size, overlap))
    return [stripped for chunk in chunks if (stripped := chunk.strip())]


def _batches(pieces: Iterator[tuple[int, int, str]], chars: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about so many characters."""
    rows, held = [], 0
    for row in pieces:
        rows.append(row)
        held += len(row[2])
        if held >= chars:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(values), kind) for values, kind in zip(zip(*rows), (pa.int64(), pa.int32(), pa.string()))],
                                      names=["doc_id", "chunk_no", "chunk"])


def chunk_documents(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(doc_id, chunk_no, chunk) for documents with doc_id and text.

    A task takes one document at a time out of Spark's batches, which end at 64
    MB, and sends chunks on by the megabyte, so its memory is that of a batch.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.columns
            yield from _batches(((ids[i].as_py(), number, chunk) for i in range(batch.num_rows)
                                 for number, chunk in enumerate(split_text(texts[i].as_py(), size, overlap))), _BATCH_CHARS)

    known = documents.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return known.mapInArrow(split, CHUNK_SCHEMA)


def chunk_fixed_window(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Windows of fixed length that start every ``size - overlap`` characters.

    The last window is the first that reaches the end of the text.
    """
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the window")
    stride = size - overlap
    length = F.length("text")
    windows = F.greatest(F.ceil((length - F.lit(overlap)) / F.lit(stride)), F.lit(1)).cast("int")
    # Pieces of one stride, each then extended by the start of what follows. Cutting
    # by position instead would scan a long text once per window.
    pieces = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{stride}}}"), 0)
    needed = -(-overlap // stride)
    joined = F.transform("pieces", lambda p, i: F.concat(
        p, F.left(F.array_join(F.slice("pieces", i + 2, F.lit(needed)), ""), F.lit(overlap))))
    return (
        documents.where(length > 0)
        .select("doc_id", windows.alias("windows"), pieces.alias("pieces"))
        .select("doc_id", F.posexplode(F.slice(joined, F.lit(1), F.col("windows"))).alias("chunk_no", "chunk"))
    )
