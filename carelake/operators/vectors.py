"""Exact nearest-neighbour search over vector collections.

Vectors are packed into blocks, and blocks of queries meet blocks of chunks of
the same group in an equality join. Each pair of blocks is one matrix product
that keeps only the best few chunks per query, so the pairs of single vectors
never exist as rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

_BLOCK_BYTES = 1 << 20
_BLOCK_ROWS = 1024
# Blocks leave a task in batches of about so many bytes, and so many queries at once are compared with a block.
_BATCH_BYTES, _SLICE = 4 << 20, 128
# Cosines are compared at this many decimals, then by id, so that the order of
# summation never decides between equal vectors.
RANK_DECIMALS = 9


Pack = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def _packer(vectors: DataFrame, group: list[str], prefix: str) -> tuple[DataFrame, Pack, str]:
    """What ``pack_blocks`` reads, the function that packs it in a task, and the columns of that."""
    single = vectors.schema["vec"].dataType.elementType.typeName() == "float"
    kind, number = ("float", np.float32) if single else ("double", np.float64)
    fields = ", ".join(f"{name} string" for name in group)
    schema = f"{fields}, {prefix}_ids array<bigint>, {prefix}_values array<{kind}>, {prefix}_norms array<double>"
    arrow_schema = pa.schema(
        [(name, pa.string()) for name in group]
        + [(f"{prefix}_ids", pa.list_(pa.int64())), (f"{prefix}_values", pa.list_(pa.from_numpy_dtype(number))),
           (f"{prefix}_norms", pa.list_(pa.float64()))]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Here, because a filter in the plan would compute vectors a second time.
            if batch.column("vec").null_count:
                batch = batch.filter(pc.is_valid(batch.column("vec")))
            if batch.num_rows == 0:
                continue
            keys = batch.select(group).to_pandas()
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            lists = batch.column("vec")
            if len(pc.unique(pc.list_value_length(lists))) != 1:
                raise ValueError("vectors of one collection table must have one width")
            matrix = lists.flatten().to_numpy(zero_copy_only=False).astype(number, copy=False).reshape(batch.num_rows, -1)
            norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix, dtype=np.float64))
            step = int(min(_BLOCK_ROWS, max(1, _BLOCK_BYTES // max(1, matrix[0].nbytes))))
            rows, held = [], 0
            for key, places in keys.groupby(group, sort=False).indices.items():
                names = key if isinstance(key, tuple) else (key,)
                for start in range(0, len(places), step):
                    part = places[start : start + step]
                    rows.append({
                        **dict(zip(group, names)),
                        f"{prefix}_ids": ids[part],
                        f"{prefix}_values": matrix[part].ravel(),
                        f"{prefix}_norms": norms[part],
                    })
                    held += rows[-1][f"{prefix}_values"].nbytes
                    if held >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow_schema)

    return vectors.select(*[F.col(name).cast("string").alias(name) for name in group], "id", "vec"), pack, schema


def pack_blocks(vectors: DataFrame, group: list[str], prefix: str) -> DataFrame:
    """(group..., <prefix>_ids, <prefix>_values, <prefix>_norms): vectors of a group, side by side, with their lengths.

    Packing happens inside each partition, without a shuffle. A block holds at
    most about a megabyte, in the precision of its input. Vectors must have
    columns id and vec.
    """
    flat, pack, schema = _packer(vectors, group, prefix)
    return flat.mapInArrow(pack, schema)


def _block_pairs(queries: DataFrame, chunks: DataFrame, group: list[str]) -> DataFrame:
    """Joined blocks, each pair of one group once.

    Query blocks are broadcast if the optimizer's size check allows. Else the
    blocks of a group lie on a grid: a chunk block has a row of it and goes to
    every column, a query block has a column and goes to every row. The grid has
    about as many cells as there are shuffle partitions, so one collection
    keeps all tasks busy, and a side is copied by the root of that only.
    """
    side = math.ceil(math.sqrt(int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    place = lambda prefix: F.pmod(F.xxhash64(f"{prefix}_ids"), F.lit(side)).cast("int")
    rows = pack_blocks(chunks, group, "c").withColumn("__row", place("c")).withColumn("__column", everywhere)
    columns = pack_blocks(queries, group, "q").withColumn("__column", place("q")).withColumn("__row", everywhere)
    return rows.join(columns, [*group, "__row", "__column"])


_PAIR = [f"{side}_{part}" for side in "qc" for part in ("ids", "values", "norms")]


def _each_pair(batch: pa.RecordBatch):
    """(query ids, chunk ids, cosine matrix) for few queries of a joined row at a time; a vector of length zero has cosine 0."""
    for row in range(batch.num_rows):
        q_ids, q_values, q_norms, c_ids, c_values, c_norms = (batch.column(name)[row].values.to_numpy(zero_copy_only=False) for name in _PAIR)
        q_values = q_values.reshape(len(q_ids), -1)
        c_values = c_values.astype(np.float64).reshape(len(c_ids), -1).T
        for start in range(0, len(q_ids), _SLICE):
            some = slice(start, start + _SLICE)
            dots = q_values[some].astype(np.float64) @ c_values
            lengths = q_norms[some, None] * c_norms
            yield q_ids[some], c_ids, np.divide(dots, lengths, out=np.zeros_like(dots), where=lengths > 0)


def _best_places(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Per row, the columns of the k largest rounded scores in order, equal ones by id.

    Score and rank of the id make one whole number, so the k best are parted
    from the rest without sorting the row.
    """
    rank = np.empty(len(ids), np.int64)
    rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    keys = np.rint(scores * -(10**RANK_DECIMALS)).astype(np.int64) * len(ids) + rank
    k = min(k, len(ids))
    places = np.argpartition(keys, k - 1, axis=1)[:, :k]
    return np.take_along_axis(places, np.argsort(np.take_along_axis(keys, places, axis=1), axis=1), axis=1)


def block_topk(queries: DataFrame, chunks: DataFrame, group: list[str], k: int, few: bool = False) -> DataFrame:
    """(query_id, chunk_id, cosine): the best k chunks per query and pair of blocks.

    ``few`` queries go to every task as they are, and chunks meet them where they
    are read: then blocks of chunks are neither rows nor copied.
    """
    out = pa.schema([("query_id", pa.int64()), ("chunk_id", pa.int64()), ("cosine", pa.float64())])

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for q_ids, c_ids, scores in _each_pair(batch):
                order = _best_places(scores, c_ids, k)
                found.append((np.repeat(q_ids, order.shape[1]), c_ids[order].ravel(), np.take_along_axis(scores, order, axis=1).ravel()))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)) for part in zip(*found)], schema=out)

    result = "query_id bigint, chunk_id bigint, cosine double"
    if not few:
        return _block_pairs(queries, chunks, group).select(_PAIR).mapInArrow(best, result)
    asked = pack_blocks(queries, group, "q").dropna(subset=group).toArrow().combine_chunks()
    flat, pack, _ = _packer(chunks, group, "c")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_group: dict[tuple, list[dict]] = {}
        for key, row in zip(zip(*(asked[name].to_pylist() for name in group)), range(len(asked))):
            by_group.setdefault(key, []).append({name: asked[name].chunk(0).slice(row, 1) for name in _PAIR[:3]})
        for packed in pack(batches):
            for row, key in enumerate(zip(*(packed.column(name).to_pylist() for name in group))):
                own = {name: packed.column(name).slice(row, 1) for name in _PAIR[3:]}
                for block in by_group.get(key, ()):
                    yield pa.RecordBatch.from_pydict(block | own)

    return flat.mapInArrow(lambda batches: best(meet(batches)), result)


def keep_topk(candidates: DataFrame, k: int) -> DataFrame:
    """Ranks candidates per query; ranks are limited before and after the shuffle."""
    ranked = F.round("cosine", RANK_DECIMALS)
    best_first = Window.partitionBy("query_id").orderBy(ranked.desc(), "chunk_id")
    return candidates.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k)


def topk_cosine(queries: DataFrame, chunks: DataFrame, k: int = 3, collection: str = "collection", few: bool = False) -> DataFrame:
    """(query_id, chunk_id, relevance, place): the k nearest chunks in the query's collection.

    Exact. Relevance is the cosine at two decimals; it may be negative. Inputs
    have columns id, vec and the collection. ``few`` says that the queries fit into
    the driver and each task, however many chunks there are.
    """
    found = keep_topk(block_topk(queries, chunks, [collection], k, few), k)
    return found.select("query_id", "chunk_id", F.round("cosine", 2).alias("relevance"), "cosine", "place")


def score_summary(queries: DataFrame, chunks: DataFrame, collection: str = "collection") -> DataFrame:
    """Per query, over every chunk of its collection: how many, best, worst and mean cosine."""
    out = pa.schema([("query_id", pa.int64()), ("n", pa.int64()), ("best", pa.float64()),
                     ("worst", pa.float64()), ("total", pa.float64())])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(q_ids, np.full(len(q_ids), len(c_ids)), scores.max(axis=1), scores.min(axis=1), scores.sum(axis=1))
                     for q_ids, c_ids, scores in _each_pair(batch)]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(part)) for part in zip(*found)], schema=out)

    pairs = _block_pairs(queries, chunks, [collection]).select(_PAIR)
    parts = pairs.mapInArrow(summarise, "query_id bigint, n bigint, best double, worst double, total double")
    return parts.groupBy("query_id").agg(
        F.sum("n").alias("n_chunks"), F.max("best").alias("best"), F.min("worst").alias("worst"),
        (F.sum("total") / F.sum("n")).alias("mean"),
    )


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: the share of exact neighbours that the approximate search found."""
    found = approximate.select("query_id", "chunk_id", F.lit(1).alias("hit"))
    return (
        exact.join(found, ["query_id", "chunk_id"], "left")
        .agg(F.count("hit").alias("found"), F.count("*").alias("expected"))
        .withColumn("recall", F.col("found") / F.nullif(F.col("expected"), F.lit(0)))
    )
