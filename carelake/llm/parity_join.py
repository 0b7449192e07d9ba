"""N-gram Jaccard join by parity sketches: pigeonhole over the parts of bit sketches, then exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from carelake.llm.arrays import Prefixes, mix, pieces, text_bytes, word_hashes
from carelake.llm.components import connected
from carelake.llm.prefix_sums import shuffle_partitions
from carelake.session import stored

NO_ID = (1 << 63) - 1
SHINGLE = 4
PERCENT = 85
BAND_RATIO = 1.5
# So many parts agree beyond what the bound on differences leaves.
AGREEING = 4
# Turns in which the sets of a key are compared with one of them.
HUB_TURNS = 2
# Words of the fixed sketch that candidates are compared by.
SKETCH = 16


def shingle_sets(data: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each text, sorted within the text, and where each text's begin.

    A text of fewer words has all its words as one shingle; ASCII letters are lower-cased.
    """
    words, firsts = word_hashes(data, bounds, lower=True)
    counts = np.diff(firsts)
    shingles = np.where(counts == 0, 0, np.maximum(counts - k + 1, 1))
    owner = np.repeat(np.arange(len(counts)), shingles)
    begins = np.cumsum(shingles) - shingles
    start = firsts[owner] + np.arange(len(owner)) - begins[owner]
    hashes = Prefixes(words, "gram").part(start, start + np.minimum(counts, k)[owner])
    hashes = mix(hashes + np.minimum(counts, k)[owner].astype(np.uint64))
    order = np.lexsort((hashes, owner)) if len(bounds) > 2 else np.argsort(hashes)
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(len(counts) + 1))


class Bands:
    """Size bands and, for each, the number of parts of its sketches.

    Sets link when 100 I >= percent U, so their symmetric difference is at most
    (100 - percent) / (100 + percent) of both sizes together. A band's sketches
    have so many parts that AGREEING or more of them stay equal after that many
    changes. A set also joins the next band when a larger partner could be there.
    """

    def __init__(self, percent: int, ratio: float = BAND_RATIO):
        self.percent = percent
        tops = [1]
        while tops[-1] < 1 << 40:
            tops.append(max(tops[-1] + 1, int(tops[-1] * ratio)))
        self.starts = np.array(tops)
        last = self.starts[1:] - 1
        self.differ = (100 - percent) * 2 * last // (100 + percent)
        self.parts = np.where(self.differ > 0, self.differ + AGREEING + self.differ // 3, 0)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, sizes, side="right") - 1

    def reach_next(self, sizes: np.ndarray) -> np.ndarray:
        return 100 * sizes >= self.percent * self.starts[self.of(sizes) + 1]


def sketch_keys(hashes: np.ndarray, firsts: np.ndarray, chosen: np.ndarray, band: np.ndarray,
                bands: Bands) -> tuple[np.ndarray, ...]:
    """(set, key, band, agree) of every part of the parity sketches of some sets in the given bands.

    A shingle hash picks a part by its upper bits, and all its bits, mixed anew, are
    XORed into that part of 64 bits. An element changes one part, so sets that
    differ in d elements differ in d parts at most; with one bit for an element
    instead, parts of one or two elements would agree by chance. Empty parts say
    little and are left out, if the set has enough others.
    """
    sizes = np.diff(firsts)[chosen]
    parts = bands.parts[band]
    use = parts > 0
    chosen, band, sizes, parts = chosen[use], band[use], sizes[use], parts[use]
    rows = np.repeat(np.arange(len(chosen)), sizes)
    ahead = np.cumsum(sizes) - sizes
    element = hashes[firsts[chosen][rows] + np.arange(len(rows)) - ahead[rows]]
    part = ((element >> np.uint64(32)) * parts[rows].astype(np.uint64)) >> np.uint64(32)
    base = np.cumsum(parts) - parts
    cell = base[rows] + part.astype(np.int64)  # ascending, as the hashes of a set are sorted
    sketch = np.zeros(int(parts.sum()), np.uint64)
    if len(cell):
        begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        sketch[cell[begin]] = np.bitwise_xor.reduceat(mix(element), begin)
    owner = np.repeat(np.arange(len(chosen)), parts)
    index = np.arange(len(sketch)) - base[owner]
    blank = np.bincount(owner[sketch == 0], minlength=len(chosen))
    agree = parts - bands.differ[band] - blank  # so many parts with a bit agree at least
    keep = (sketch != 0) | (agree[owner] < 1)
    key = mix(mix(sketch) + (band[owner].astype(np.uint64) << np.uint64(40)) + index.astype(np.uint64))
    owner = owner[keep]
    return chosen[owner], key[keep], band[owner], np.maximum(agree, 1)[owner]


SETS = T.StructType([T.StructField("doc", T.LongType()), T.StructField("copy", T.LongType()), T.StructField("n", T.LongType()), T.StructField("set", T.LongType()),
                     T.StructField("sketch", T.ArrayType(T.LongType()))])


def set_rows(k: int):
    """A task over (doc, text, copy): doc, copy, the size of its set, a hash of it (null without words), its fixed sketch."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in pieces(offsets):
                hashes, firsts = shingle_sets(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], k)
                sizes = np.diff(firsts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(2).slice(first, last - first), pa.array(sizes.astype(np.int64)),
                     pa.array(set_hashes(hashes, firsts), mask=sizes == 0), fixed_sketches(hashes, firsts)], names=SETS.names)

    return scan


def fixed_sketches(hashes: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Parity sketches of SKETCH * 64 bits: the same for all sizes, to compare two sets by."""
    n = len(firsts) - 1
    owner = np.repeat(np.arange(n), np.diff(firsts))
    cell = owner * SKETCH + ((hashes >> np.uint64(32)) * np.uint64(SKETCH) >> np.uint64(32)).astype(np.int64)
    words = np.zeros(n * SKETCH, np.uint64)
    if len(cell):
        begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        words[cell[begin]] = np.bitwise_xor.reduceat(np.uint64(1) << (hashes & np.uint64(63)), begin)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(words) + 1, SKETCH, dtype=np.int32)),
                                    pa.array(words.astype(np.int64)))


def set_hashes(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """A hash of each set, from its elements' mixed sum and its size."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)))])
    return mix(sums[firsts[1:]] - sums[firsts[:-1]] + np.diff(firsts).astype(np.uint64)).astype(np.int64)


BLOBS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("rows", T.BinaryType())])
ROW = np.dtype([("key", "<u8"), ("set", "<i8"), ("n", "<i4"), ("band", "<i2"), ("agree", "<i2")])


def key_rows(k: int, bands: Bands, buckets: int):
    """A task over (doc, text): the sketch keys of all sets, packed by bucket of the key."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in pieces(offsets):
                hashes, firsts = shingle_sets(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], k)
                sizes = np.diff(firsts)
                names, own = set_hashes(hashes, firsts), np.flatnonzero(sizes)
                band = bands.of(sizes[own])
                onward = bands.reach_next(sizes[own])
                owner, key, at_band, agree = sketch_keys(hashes, firsts, np.concatenate([own, own[onward]]),
                                         np.concatenate([band, band[onward] + 1]), bands)
                rows = np.empty(len(key), ROW)
                rows["key"], rows["set"], rows["n"] = key, names[owner], sizes[owner]
                rows["band"], rows["agree"] = at_band, agree
                bucket = (key % np.uint64(buckets)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                rows, bucket = rows[order], bucket[order]
                cuts = np.searchsorted(bucket, np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.astype(np.int32)), pa.array([rows[cuts[b]:cuts[b + 1]].tobytes() for b in some], pa.binary())],
                    names=BLOBS.names)

    return scan


MEMBERS = T.StructType([T.StructField("key", T.LongType()), T.StructField("set", T.LongType()), T.StructField("n", T.IntegerType()),
                       T.StructField("band", T.ShortType()), T.StructField("agree", T.ShortType())])


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task over the packed rows of a bucket: the rows of keys that two or more different sets have.

    Rows are taken in blocks. Of earlier blocks only each key's first row is kept,
    so a key with any number of rows passes through; equal sets count once.
    """
    held, told = np.zeros(0, ROW), np.zeros(0, bool)

    def out(rows: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(rows[name]).view(np.int64) if name == "key" else np.ascontiguousarray(rows[name]))
             for name in MEMBERS.names], names=MEMBERS.names)

    for rows in _blocks(batches):
        rows = rows[np.lexsort((rows["set"], rows["key"]))]
        same_key = np.append(False, rows["key"][1:] == rows["key"][:-1])
        rows = rows[~(same_key & np.append(False, rows["set"][1:] == rows["set"][:-1]))]
        begin = np.append(True, rows["key"][1:] != rows["key"][:-1])
        group, heads = np.cumsum(begin) - 1, rows[begin]
        at = np.minimum(np.searchsorted(held["key"], heads["key"]), max(len(held) - 1, 0))
        old = held["key"][at] == heads["key"] if len(held) else np.zeros(len(heads), bool)
        several = np.bincount(group) > 1
        other = np.zeros(len(heads), bool)
        other[old] = several[old] | (held["set"][at[old]] != heads["set"][old])
        yield out(rows[(several | other)[group]])
        late = at[other & old]
        late = late[~told[late]]
        yield out(held[late])
        told[late] = True
        held = np.concatenate([held, heads[~old]])
        told = np.concatenate([told, several[~old]])
        order = np.argsort(held["key"], kind="stable")
        held, told = held[order], told[order]


def _blocks(batches: Iterator[pa.RecordBatch], most: int = 1_000_000) -> Iterator[np.ndarray]:
    waiting, count = [], 0
    for batch in batches:
        for value in batch.column(1):
            rows = np.frombuffer(value.as_buffer(), ROW)
            waiting.append(rows)
            count += len(rows)
            if count >= most:
                yield np.concatenate(waiting)
                waiting, count = [], 0
    if waiting:
        yield np.concatenate(waiting)


def candidate_keys(texts: DataFrame, k: int, bands: Bands) -> DataFrame:
    """(doc, text) -> (key, set, n): keys shared by different sets, without those a pair can do without.

    A pair that links agrees in ``agree`` keys of its band at least, so of each
    set's keys the ``agree - 1`` most frequent can go: one at least of those the
    pair agrees in stays on both sides, as both sides drop in the same order.
    """
    buckets = shuffle_partitions(texts)
    packed = texts.mapInArrow(key_rows(k, bands, buckets), BLOBS)
    members = stored(packed.repartitionById(buckets, "bucket").mapInArrow(shared_keys, MEMBERS).distinct(), "parity-keys")
    counted = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("many")), "key")
    order = Window.partitionBy("set", "band").orderBy(F.desc("many"), "key")
    rare = counted.withColumn("place", F.row_number().over(order)).where("place >= agree").select("key", "set", "n")
    return stored(rare, "parity-rare-keys")


def sided(side: str) -> list:
    """The columns of a key's row under the name of one side of a pair."""
    return [F.col("set").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "group", "sketch")]]


def near_enough(pairs: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b), the smaller first, of different groups whose sizes and fixed sketches allow a link.

    The conditions are part of the join that makes the pairs.
    """
    bits = " + ".join(f"bit_count(a_sketch[{i}] ^ b_sketch[{i}])" for i in range(SKETCH))
    return (pairs.where(f"a_group <> b_group and 100 * a_n >= {percent} * b_n and 100 * b_n >= {percent} * a_n "
                        f"and ({bits}) * {100 + percent} <= {100 - percent} * (a_n + b_n)")
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def open_keys(sketched: DataFrame, links: DataFrame | None, name: str) -> DataFrame:
    """The rows of keys whose sets are not all in one component of the links yet, with their component."""
    if links is None:
        return sketched.withColumn("group", F.col("set"))
    groups = stored(connected(links), f"{name}-groups")
    placed = (sketched.join(groups, F.col("set") == F.col("node"), "left")
              .select(*sketched.columns, F.coalesce("component", "set").alias("group")))
    split = placed.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low < high").select("key")
    return stored(placed.join(split, "key"), name)


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) of sets that link, by their whole texts."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [text_bytes(batch.column(i)) for i in (2, 3)]
            keep = np.zeros(len(batch), bool)
            for first, last in pieces(sides[0][1] + sides[1][1]):
                found = []
                for data, offsets in sides:
                    found.append(shingle_sets(data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], k))
                owner = np.concatenate([np.repeat(np.arange(last - first), np.diff(f)) for _, f in found])
                hashes = np.concatenate([h for h, _ in found])
                order = np.lexsort((hashes, owner))
                owner, hashes = owner[order], hashes[order]
                twice = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
                both = np.bincount(owner[1:][twice], minlength=last - first)
                either = np.bincount(owner, minlength=last - first) - both
                keep[first:last] = (100 * both >= percent * either) & (either > 0)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    joined = (pairs.join(texts.select(F.col("set").alias("a"), F.col("text").alias("a_text")), "a")
              .join(texts.select(F.col("set").alias("b"), F.col("text").alias("b_text")), "b")
              .select("a", "b", "a_text", "b_text"))
    return joined.mapInArrow(check, schema)


def linked(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Columns (doc_id, text) -> one row per document: doc, copy, n, component, lowest, n_links.

    Sets of ``k``-word shingles over ASCII-lower-cased words link when
    100 * intersection >= percent * union. ``lowest`` is the smallest doc
    that links reach; documents of one set are linked with each other. ``doc`` is
    doc_id with null as the largest number, ``copy`` a digest of the text. n_links
    counts the links found to other sets, which is all of them only within small
    groups: copies are not expanded into pairs.

    1. Equal sets are one from here on, named by a hash of the set.
    2. Sets meet in the parts of parity sketches, made per size band so that a
       linking pair must agree in some parts.
    3. In each key and size slice all sets are compared with one of them, in the
       next turn with another one; verified links are joined into components. A
       large group of near copies is connected by these few pairs.
    4. Pairs of a key that still lie in different components are all compared,
       so no link is lost. Pairs inside a component need no comparison.

    Documents without words have 0 shingles and are alone. Repeated rows
    are separate rows with one component. Extra columns are ignored. An empty
    table gives an empty table.
    """
    bands = Bands(percent)
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text",
                            F.xxhash64("text").alias("copy"))
    docs = stored(rows.mapInArrow(set_rows(k), SETS), "sets")
    sets = stored(docs.where("n > 0").groupBy("set").agg(
        F.min(F.struct("doc", "copy")).alias("head"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), "distinct-sets")
    keys = candidate_keys(rows, k, bands)
    sketched = stored(keys.join(sets.select("set", "sketch"), "set"), "sketched-keys")
    # One id can have many texts, so a set's text is found by the digest as well; each row meets one set at most.
    wanted = sets.join(keys, "set", "left_semi").select("set", "head.doc", "head.copy")
    texts = stored(rows.join(wanted, ["doc", "copy"]).select("set", "text").dropDuplicates(["set"]), "set-texts")
    links = None
    for turn in range(HUB_TURNS):
        open_ = open_keys(sketched, links, f"open-keys-{turn}").withColumn("slice", F.floor(F.log("n") / math.log(100 / percent)))
        hub = F.min_by("set", F.xxhash64("set", F.lit(turn), "key")) if turn else F.min("set")
        hubs = (open_.groupBy("key", "slice").agg(hub.alias("hub")).withColumnRenamed("hub", "set")
                .join(open_, ["key", "slice", "set"]).select("key", "slice", *sided("a")))
        near = stored(near_enough(hubs.join(open_.select("key", "slice", *sided("b")), ["key", "slice"]), percent), f"hub-pairs-{turn}")
        found = verified(near, texts, k, percent)
        links = stored(found if links is None else links.unionByName(found).distinct(), f"links-{turn}")
    open_ = open_keys(sketched, links, "open-keys")
    pairs = (open_.select("key", *sided("a")).join(open_.select("key", *sided("b")), "key").where("a < b"))
    rest = verified(near_enough(pairs, percent), texts, k, percent)
    every = stored(links.unionByName(rest).distinct(), "links")
    whole = connected(every)
    ends = every.select(F.col("a").alias("node")).unionByName(every.select(F.col("b").alias("node")))
    found = (sets.join(whole.withColumnRenamed("node", "set"), "set", "left")
             .join(ends.groupBy("node").agg(F.count(F.lit(1)).alias("n_links")).withColumnRenamed("node", "set"), "set", "left")
             .select("set", F.col("head.doc").alias("head"), F.coalesce("component", "set").alias("component"), "n_links"))
    lowest = found.groupBy("component").agg(F.min("head").alias("lowest"))
    named = stored(found.join(lowest, "component").select("set", "component", "lowest", "n_links"), "set-components")
    return (docs.where("n > 0").join(named, "set")
            .select("doc", "copy", "n", "component", "lowest", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
            .unionByName(docs.where("n = 0").select("doc", "copy", "n", F.lit(None).cast("long").alias("component"),
                                                    F.col("doc").alias("lowest"), F.lit(0).cast("long").alias("n_links"))))


def link_components(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, n_links; see ``linked``.

    A null doc_id stays null and is larger than all others.
    """
    number = lambda name: F.when(F.col(name) != NO_ID, F.col(name))
    return linked(documents, k, percent).select(
        number("doc").alias("doc_id"), F.col("n").alias("n_shingles"), number("lowest").alias("component_id"), "n_links")


def one_of_each(documents: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` without near copies: of each component the row with the smallest doc_id.

    Documents without words all stay. Rows with one doc_id are told apart by
    their text; of rows with both equal one stays. Columns named _doc or _copy
    are lost.
    """
    found = linked(documents, k, percent)
    chosen = (found.where("component is not null").groupBy("component").agg(F.min(F.struct("doc", "copy")).alias("one"))
              .select("one.doc", "one.copy"))
    alone = found.where("component is null").select("doc", "copy").distinct()
    keep = chosen.unionByName(alone).select(F.col("doc").alias("_doc"), F.col("copy").alias("_copy"))
    rows = documents.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)), "_copy": F.xxhash64("text")})
    return rows.join(keep, ["_doc", "_copy"]).dropDuplicates(["_doc", "_copy"]).drop("_doc", "_copy")
