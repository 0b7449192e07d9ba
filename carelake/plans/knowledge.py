"""Knowledge base: chunk, embed, store, search, and format the context block."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from carelake.functions.privacy import has_leak
from carelake.functions.text import relevance_line
from carelake.operators import vectors
from carelake.operators.quality import without_leaks

Embedder = Callable[[DataFrame], DataFrame]

# Dimensions of the local embedder, and what it takes for a term.
WIDTH, TERM = 256, r"[\p{L}\p{N}]+"
_BETWEEN_TERMS = r"[^\p{L}\p{N}]+"
_PART_ROWS = 1024
# So many questions at most are taken to every task as they are.
_FEW = 2048

# The wording around the context lines.
BLOCK_HEAD = "\nCLINIC KNOWLEDGE BASE CONTEXT (retrieved automatically via RAG):\n"
BLOCK_TAIL = "\n\nUse this context to estimate the 'potencial' field based on real service prices.\n"


def _hash(term: bytes) -> int:
    return int.from_bytes(hashlib.md5(term).digest()[:4])


def term_dims(terms: pa.Array, width: int) -> pa.Array:
    """For each list of terms the list of their dimensions, the first 32 bits of a term's MD5 by the width. A term is hashed once for all rows."""
    lengths = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False)
    coded = terms.flatten().dictionary_encode()
    different = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    dims = np.array([_hash(term) % width for term in different], np.int32)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), dims[coded.indices.to_numpy()])


def _counts(dims: pa.Array, width: int) -> np.ndarray:
    """(rows, width): how often each dimension is in a row's list."""
    lengths = pc.list_value_length(dims).to_numpy(zero_copy_only=False)
    places = np.repeat(np.arange(len(dims)) * width, lengths) + dims.flatten().to_numpy()
    return np.bincount(places, minlength=len(dims) * width).reshape(len(dims), width)


def term_counts(terms: pa.Array, width: int) -> np.ndarray:
    """(rows, width): how many of a row's terms have each dimension."""
    return _counts(term_dims(terms, width), width)


def _terms(text: Column) -> Column:
    """Runs of letters and digits, lower case, with a space between them: a text reaches Python faster than a list."""
    return F.trim(F.regexp_replace(F.lower(text), _BETWEEN_TERMS, " "))


def _parts(lists: pa.Array) -> Iterator[tuple[slice, pa.Array]]:
    """Few rows at a time, as a row has a number for each dimension."""
    for start in range(0, len(lists), _PART_ROWS):
        part = lists.slice(start, _PART_ROWS)
        yield slice(start, start + len(part)), part


def _counted(terms: pa.Array, width: int) -> Iterator[tuple[slice, np.ndarray]]:
    """The counts of few rows at a time; terms are hashed once for all of them."""
    some = pc.if_else(pc.equal(terms, ""), pa.scalar(None, terms.type), terms)  # an empty text has no term, rather than an empty one
    for rows, part in _parts(term_dims(pc.split_pattern(some, " "), width)):
        yield rows, _counts(part, width)


def fit_rarity(chunks: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row, ``rarity``: for each dimension ln((chunks + 1) / (chunks with it + 1)).

    A task sends on a number for each dimension whatever the size of the corpus,
    and so has the result. Null chunks count as chunks without terms.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width, np.int64)
        for batch in batches:
            for _, counts in _counted(batch.column(0), width):
                seen += np.count_nonzero(counts, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(seen)], names=["dim", "n"])

    seen = chunks.select(_terms(F.col("chunk"))).mapInArrow(count, "dim int, n bigint").groupBy("dim").agg(F.sum("n").alias("n"))
    counts = seen.agg(F.map_from_entries(F.collect_list(F.struct("dim", "n"))).alias("seen"))
    total = chunks.agg(F.count("*").alias("total"))
    rarity = F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda d: F.log(
        (F.col("total") + 1) / (F.coalesce(F.element_at("seen", d), F.lit(0)) + 1)))
    return counts.join(total).select(rarity.alias("rarity"))


def fit_embedder(chunks: DataFrame, width: int = WIDTH) -> Embedder:
    """A local text embedder: hashed terms weighted by rarity, length one.

    Spark finds the terms; tasks count and weigh those of many chunks at once.
    The chunks are read once here, and once by ``embed_chunks``: pass a stored table.
    """
    # A number for each dimension.
    rarity = np.array(fit_rarity(chunks, width).first().rarity)

    def embed(terms: pa.Array) -> pa.Array:
        out = np.zeros((len(terms), width))
        for rows, counts in _counted(terms, width):
            weights = counts * rarity
            total = np.zeros(len(weights))
            for squares in np.ascontiguousarray(weights.T) ** 2:  # in the order of dimensions, whatever numpy's own order is
                total += squares
            norm = np.sqrt(total)[:, None]
            np.divide(weights, norm, out=out[rows], where=norm > 0)  # the others stay at zero
        return pa.ListArray.from_arrays(pa.array(np.arange(len(terms) + 1) * width, pa.int32()), pa.array(out.ravel()))

    vector = F.arrow_udf(embed, "array<double>")
    return lambda rows: rows.withColumn("embedding", vector(_terms(F.col("chunk"))))


def embed_chunks(chunks: DataFrame, embedder: Embedder) -> DataFrame:
    """Adds ``embedding``, an array of numbers.

    ``embedder`` is ``fit_embedder``'s or any function that adds the column, for
    example one built on ``predict_batch_udf`` for a model of the user's. Chunks
    without terms, null ones too, have all zeros from ``fit_embedder``'s.
    """
    return embedder(chunks)


def search_results(ranked: DataFrame, chunks: DataFrame, questions: DataFrame, few: bool = False) -> DataFrame:
    """(query_id, results): texts with relevance, nearest first, for each question's id.

    ``ranked`` holds at most k rows per query; ``chunks`` has id and text. A
    question without hits, or whose hits have no text here, has no results.
    ``few`` says that ``ranked`` fits a broadcast; then the texts are not shuffled.
    """
    texts = chunks.select(F.col("id").alias("chunk_id"), "text")
    hits = (F.broadcast(ranked) if few else ranked).join(texts, "chunk_id").select("query_id", F.struct("place", "text", "relevance").alias("hit"))
    found = hits.groupBy("query_id").agg(F.sort_array(F.collect_list("hit")).alias("hits"))
    shown = F.transform(F.coalesce("hits", F.array().cast(found.schema["hits"].dataType)),
                        lambda h: F.struct(h["text"].alias("texto"), h["relevance"].alias("relevancia")))
    return (questions.select(F.col("id").alias("query_id")).join(found, "query_id", "left")
            .select("query_id", shown.alias("results")))


def rag_lines(results: DataFrame) -> DataFrame:
    """(query_id, lines): one line per result; no result gives an empty text."""
    lines = F.transform("results", lambda r: relevance_line(r["relevancia"], r["texto"]))
    return results.select("query_id", F.coalesce(F.array_join(lines, "\n"), F.lit("")).alias("lines"))


def rag_block(results: DataFrame) -> DataFrame:
    """(query_id, block): the lines with their heading; no result gives an empty text."""
    lined = rag_lines(results)
    block = F.concat(F.lit(BLOCK_HEAD), F.col("lines"), F.lit(BLOCK_TAIL))
    return lined.select("query_id", F.when(F.col("lines") == "", "").otherwise(block).alias("block"))


def answer_blocks(questions: DataFrame, chunks: DataFrame, embedder: Embedder, k: int = 3) -> DataFrame:
    """From text to context: (query_id, block) for questions (id, text), from embedded chunks (id, text, vec, collection).

    Questions have a collection, too, and are embedded as the chunks were. Chunks
    in which personal data is found are never shown: they are searched as if
    they weren't there. A question without hits has an empty block. Up to 2,048
    questions go to every task, so each chunk is embedded where it is read and
    meets them there; chunks and their vectors are neither copied nor shuffled.
    """
    few = questions.limit(_FEW + 1).count() <= _FEW
    safe = without_leaks(chunks, ("text",), has_leak)
    asked = embed_chunks(questions.withColumnRenamed("text", "chunk"), embedder).withColumnRenamed("embedding", "vec")
    ranked = vectors.topk_cosine(asked.select("id", "collection", "vec"), safe.select("id", "collection", "vec"), k, few=few)
    return rag_block(search_results(ranked, safe.select("id", "text"), questions, few))
