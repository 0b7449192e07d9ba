"""How far sources differ in their terms: a quadtree over the matrix of groups and terms.

The matrix of a language has a row for each of its sources and a column for each
kept term. It is cut into square blocks; a block's quadtree says which of its
quadrants hold counts, and is walked for two sources at once.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.llm.arrays import text_bytes
from carelake.operators.grouping import join_lookup
from carelake.session import stored

LEAST_DOCUMENTS, SMOOTHING, SCALE, TOP_TERMS = 30, 5, 10**9, 50
# Side of a block, and how many of its columns are taken on average.
SIDE, FILL = 64, 48
# Terms of one task's partial counts, and pairs of row blocks of one task's partial sums.
HELD_TERMS, HELD_BLOCKS = 200_000, 500
# A text's bytes are split into terms in pieces of about so many.
PIECE = 1 << 20

# A term's bytes stay (A-Z made small; what is not ASCII stays), all others part terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
COUNTS = "lang string, source string, term string, n long, docs long"


def pieces_of_terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text of any length, piece by piece; no term is cut."""
    text, at = text.translate(_TERM_BYTES), 0
    while at < len(text):
        end = len(text) if at + PIECE >= len(text) else text.find(b" ", at + PIECE)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end + 1


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) -> partial counts (lang, source, term, n, docs), and a row without a term for every group."""
    occurrences: dict[tuple, Counter] = defaultdict(Counter)
    documents: dict[tuple, Counter] = defaultdict(Counter)
    size = 0  # terms and groups held

    def held() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in occurrences.items():
            terms = [None, *counts]
            docs = documents[lang, source]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).view(pa.string()), pa.array([0, *counts.values()], pa.int64()),
                pa.array([0, *(docs[t] for t in counts)], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        occurrences.clear()
        documents.clear()

    for batch in batches:
        data, offsets = text_bytes(batch.column(2))
        for i, group in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
            seen: set[bytes] = set()
            size += group not in occurrences
            counts = occurrences[group]
            before = len(counts)
            for terms in pieces_of_terms(data[offsets[i]:offsets[i + 1]].tobytes()):
                counts.update(terms)
                new = set(terms) - seen
                documents[group].update(new)
                seen |= new
            size += len(counts) - before
            if size > HELD_TERMS:
                yield from held()
                size = 0
    yield from held()


def smoothed(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)) in whole numbers of any size; null without terms."""
    return F.expr(f"case when {terms} > 0 then 1 + (cast({count} + {SMOOTHING} as decimal(20,0)) * {SCALE}) div "
                  f"cast({total} + {SMOOTHING} * {terms} as decimal(20,0)) end")


def quadtree(cells: np.ndarray) -> list[np.ndarray]:
    """Levels from single cells to the whole block: whether a quadrant has anything in it."""
    levels = [cells]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append(x[::2, ::2] | x[1::2, ::2] | x[::2, 1::2] | x[1::2, 1::2])
    return levels


def block_sums(a: np.ndarray, b: np.ndarray, empty_a: np.ndarray, empty_b: np.ndarray, width: int, same: bool) -> np.ndarray:
    """Sums of abs(p - q) over ``width`` columns for each row of ``a`` with each row of ``b``.

    Both blocks are square with a power of two as side and hold 0 where nothing
    was counted; ``empty_a`` and ``empty_b`` are the rows' values there. Two
    quadrants in the same columns that are both empty cost one product for all
    their rows; only where one has counts the walk goes on to their quarters, and
    single cells are compared. ``same``: a and b are one, rows after their own only.
    """
    tree_a, tree_b = quadtree(a > 0), quadtree(b > 0)
    rows_a, rows_b = len(empty_a), len(empty_b)
    total = np.zeros((len(a), len(b)), np.int64)
    i = j = k = np.zeros(1, np.int64)
    empty_columns = np.zeros((1, 1), np.int64)
    for level in range(len(tree_a) - 1, -1, -1):
        inside = (i << level < rows_a) & (j << level < rows_b) & (k << level < width)
        if same:
            inside &= i <= j
        i, j, k = i[inside], j[inside], k[inside]
        counted = tree_a[level][i, k] | tree_b[level][j, k]
        if level < len(tree_a) - 1:
            empty_columns = np.repeat(np.repeat(empty_columns, 2, 0), 2, 1)
        np.add.at(empty_columns, (i[~counted], j[~counted]), np.minimum(1 << level, width - (k[~counted] << level)))
        i, j, k = i[counted], j[counted], k[counted]
        if level:
            i, j, k = ((2 * x[:, None] + np.array(half)).ravel() for x, half in
                       ((i, [0, 0, 0, 0, 1, 1, 1, 1]), (j, [0, 0, 1, 1, 0, 0, 1, 1]), (k, [0, 1, 0, 1, 0, 1, 0, 1])))
    p, q = a[i, k], b[j, k]
    np.add.at(total, (i, j), np.abs(np.where(p > 0, p, empty_a[i]) - np.where(q > 0, q, empty_b[j])))
    total = total[:rows_a, :rows_b] + empty_columns[:rows_a, :rows_b] * np.abs(empty_a[:, None] - empty_b[None, :])
    return total


SUMS = "lang string, a int, b int, i int, j int, value long, columns long"


def sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (lang, a, b, width, cells, empty_a, empty_b) -> partial sums for pairs of rows."""
    sums: dict[tuple, list] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for (lang, a, b), (values, columns) in sums.items():
            i, j = np.indices(values.shape)
            later = (i < j) if a == b else np.ones(values.shape, bool)
            size = int(later.sum())
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * size, pa.string()), pa.array(np.full(size, a, np.int32)), pa.array(np.full(size, b, np.int32)),
                pa.array(i[later].astype(np.int32)), pa.array(j[later].astype(np.int32)), pa.array(values[later]),
                pa.array(np.full(size, columns, np.int64))], names=["lang", "a", "b", "i", "j", "value", "columns"])
        sums.clear()

    for batch in batches:
        for n in range(batch.num_rows):
            lang, a, b, width = (batch.column(c)[n].as_py() for c in range(4))
            cells = batch.column(4)[n].values
            second, row, column, p = (cells.field(f).to_numpy(zero_copy_only=False) for f in ("second", "row", "col", "p"))
            empty_a, empty_b = (batch.column(c)[n].values.to_numpy(zero_copy_only=False) for c in (5, 6))
            side = 1 << max(len(empty_a) - 1, len(empty_b) - 1, width - 1).bit_length()
            blocks = np.zeros((2, side, side), np.int64)
            blocks[second.astype(np.int64), row, column] = p
            one = blocks[0] if a == b else blocks[1]
            values = block_sums(blocks[0], one, empty_a, empty_b, width, a == b)
            if (lang, a, b) in sums:
                sums[lang, a, b][0] += values
                sums[lang, a, b][1] += width
            else:
                sums[lang, a, b] = [values, width]
            if len(sums) > HELD_BLOCKS:
                yield from held()
    yield from held()


def group_counts(documents: DataFrame) -> DataFrame:
    """(lang, source, text) -> (lang, source, term, n, docs); the row without a term shows that the group exists."""
    plain = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (plain.mapInArrow(count_terms, COUNTS).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def kept_terms(counts: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, term, lang_n, block, col, width): the terms in enough documents of a language, each with its column of a block.

    A block holds terms in about as many documents (their number's power of
    two), dealt by hash, so that rare terms' blocks are mostly empty. Blocks of
    a class are so many that they get ``FILL`` columns on average; each is
    numbered on its own, the frequent terms first.
    """
    kept = stored(counts.where("term is not null").groupBy("lang", "term")
                  .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
                  .withColumn("class", F.concat_ws(":", F.floor(F.log2("docs")), "lang")), "kept-terms")
    blocks = kept.groupBy("class").agg(F.expr(f"count(*) div {FILL} + 1").alias("blocks"))
    dealt = join_lookup(kept, blocks, "class").withColumn(
        "block", F.concat_ws(":", F.pmod(F.xxhash64("term"), F.col("blocks")), "class"))
    inside = Window.partitionBy("block")
    return dealt.select("lang", "term", "lang_n", "block",
                        (F.row_number().over(inside.orderBy(F.desc("lang_n"), "term")) - 1).alias("col"),
                        F.count(F.lit(1)).over(inside).cast("int").alias("width"))


def group_stats(cells: DataFrame, counts: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, g, total, lang_total, terms, empty): a row for each group, numbered in its language by name.

    Windows over a language's groups: their pairs are the result, so their
    number alone is small.
    """
    groups = counts.where("term is null").select("lang", "source")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    known = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "terms", "lang_total"])
    numbered = known.withColumn("g", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    return numbered.withColumn("empty", smoothed("0", "total", "terms"))


def ranked(rows: DataFrame, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rows = rows.withColumn("rank", F.row_number().over(order))
    return rows if most is None else rows.where(F.col("rank") <= most)


def pair_sums(cells: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value): each two sources of a language, both ways.

    A language's groups are cut into row blocks too. A block of cells goes to
    every pair of row blocks that it belongs to, one task sums a pair over many
    column blocks, and Spark adds up the tasks' sums. Blocks that neither row
    block has cells in are never made: their columns are what is left of all
    terms, at one price.
    """
    lines = stats.where("terms > 0").select("lang", "source", (F.col("g") % SIDE).alias("row"), F.expr(f"g div {SIDE}").cast("int").alias("part"),
                                            "empty", "terms")
    parts = lines.groupBy("lang").agg((F.max("part") + 1).alias("parts"))
    levels = (lines.groupBy("lang", "part").agg(F.array_sort(F.collect_list(F.struct("row", "empty"))).alias("rows"))
              .select("lang", "part", F.col("rows.empty").alias("empties")))
    mates = F.explode(F.expr("sequence(0, parts - 1)")).alias("mate")
    own = join_lookup(cells.select("lang", "block", "width", (F.col("g") % SIDE).alias("row"), F.expr(f"g div {SIDE}").cast("int").alias("part"), "col", "p"),
                      parts, "lang").select("*", mates)
    blocks = (own.groupBy("lang", F.least("part", "mate").alias("a"), F.greatest("part", "mate").alias("b"), "block", "width")
              .agg(F.collect_list(F.struct((F.col("part") > F.col("mate")).alias("second"), "row", "col", "p")).alias("cells")))
    for side in ("a", "b"):
        named = levels.select(F.col("lang").alias("_lang"), F.col("part").alias("_part"), F.col("empties").alias(f"empty_{side}"))
        blocks = blocks.join(named, F.col("lang").eqNullSafe(F.col("_lang")) & F.col(side).eqNullSafe(F.col("_part"))).drop("_lang", "_part")
    sums = (blocks.select("lang", "a", "b", "width", "cells", "empty_a", "empty_b").mapInArrow(sum_blocks, SUMS)
            .groupBy("lang", "a", "b", "i", "j").agg(F.sum("value").alias("value"), F.sum("columns").alias("columns")))
    paired = lines.join(parts, "lang").select("lang", "source", "row", "part", "empty", "terms", mates)
    left = paired.where("part <= mate").select("lang", F.col("part").alias("a"), F.col("mate").alias("b"), F.col("row").alias("i"),
                                               F.col("source").alias("one"), F.col("empty").alias("p"), "terms")
    right = paired.where("part >= mate").select("lang", F.col("mate").alias("a"), F.col("part").alias("b"), F.col("row").alias("j"),
                                                F.col("source").alias("other"), F.col("empty").alias("q"))
    pairs = left.join(right, ["lang", "a", "b"]).where("a < b or i < j").join(sums, ["lang", "a", "b", "i", "j"], "left")
    value = F.coalesce("value", F.lit(0)) + (F.col("terms") - F.coalesce("columns", F.lit(0))) * F.abs(F.col("p") - F.col("q"))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")),
                             F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    return pairs.select("lang", value.alias("value"), both.alias("_")).select("lang", "_.source", "_.item", "value")


def audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Columns (lang, source, text) -> lang, source, part, item, value, rank.

    A row of part ``pair`` for every other source of the language, one of part
    ``term`` for each of the ``top`` terms that the source has more of than the
    language. Null lang, source and text are empty, an empty one is a group like
    any other; every row is a document of its own, repeated ones too. Equal
    values are ranked by item. A language without kept terms has pairs of value
    0. No documents, no rows; further columns are ignored.
    """
    counts = stored(group_counts(documents), "term-counts")
    kept = stored(kept_terms(counts, least), "term-columns")
    counted = stored(counts.where("term is not null").select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "term-cells")
    stats = stored(group_stats(counted, counts, kept), "group-stats")
    # Null-safe, so that both sides come out of a shuffle of their own and a large group's rows can be split.
    named = stats.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), "g", "total", "lang_total", "terms")
    met = counted.join(named, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))).drop("_lang", "_source")
    cells = met.withColumn("p", smoothed("n", "total", "terms"))
    terms = (cells.withColumn("value", F.col("p") - smoothed("lang_n", "lang_total", "terms")).where("value > 0")
             .select("lang", "source", F.col("term").alias("item"), "value"))
    unequal = stats.where("terms = 0").select("lang", "source")
    alike = (unequal.join(unequal.withColumnRenamed("source", "item"), "lang").where("source <> item")
             .select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    pairs = pair_sums(cells, stats).unionByName(alike)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return (ranked(pairs).withColumn("part", F.lit("pair")).select(columns)
            .unionByName(ranked(terms, top).withColumn("part", F.lit("term")).select(columns)))
