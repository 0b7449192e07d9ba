"""Merkle manifest of a table: eight-ary hash trees, one for each key, and one over their roots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from carelake.llm.prefix_sums import running_totals
from carelake.operators.grouping import join_lookup
from carelake.session import stored

FAN = 8
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """A value with its UTF-8 length ahead, so that no two rows run together; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def placed(leaves: DataFrame, key: str, order: list[str], name: str) -> DataFrame:
    """Adds ``pos``, a row's place from 0 among the rows of its key, and ``n``, how many those are.

    Rows are sorted by range over all keys, so a key with a third of all rows
    is dealt over many tasks; the place is the running count less the one at
    the key's first row. Rows equal in ``order`` follow in the order of reading.
    """
    counted = leaves.withColumn("_one", F.lit(1)).withColumn("_read", F.monotonically_increasing_id())
    rows = running_totals(counted, [F.col(c).asc_nulls_first() for c in (key, *order, "_read")], "_one", name)
    keys = rows.groupBy(key).agg(F.min("before").alias("_first"), F.count(F.lit(1)).alias("n"))
    return (join_lookup(rows, keys, key).withColumn("pos", F.col("before") - F.col("_first"))
            .drop("_one", "_read", "_first", "before", "part", "place"))


def with_siblings(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """Adds ``run``, and ``left`` and ``right``, the digests of the run's other nodes on either side, joined.

    Each sibling comes from a lag or lead at a fixed offset, masked by the
    node's slot and the run's length. A window holds one run, so its partitions
    are those that a join with the parents by (key, run) needs.
    """
    nodes = nodes.withColumn("run", F.expr(f"pos div {fan}"))
    row = Window.partitionBy("key", "run").orderBy("pos")
    slot, length = F.col("pos") % fan, F.least(F.lit(fan), F.col("n") - F.col("run") * fan)
    none = F.lit("")
    left = [F.when(slot >= by, F.lag("digest", by).over(row)).otherwise(none) for by in range(fan - 1, 0, -1)]
    right = [F.when(slot + by < length, F.lead("digest", by).over(row)).otherwise(none) for by in range(1, fan)]
    return nodes.withColumn("left", F.concat(*left)).withColumn("right", F.concat(*right))


def parents(nodes: DataFrame, fan: int = FAN) -> DataFrame:
    """The next level: each run's first node hashes the run."""
    first = with_siblings(nodes.select("key", "pos", "n", "digest"), fan).where(F.col("pos") % fan == 0)
    return first.select("key", F.col("run").alias("pos"), F.expr(f"(n + {fan - 1}) div {fan}").alias("n"),
                        F.sha2(F.concat("digest", "right"), 256).alias("digest"))


def climb(nodes: DataFrame, name: str, fan: int = FAN) -> list[DataFrame]:
    """(key, pos, n, digest) -> all levels; a key's last level is the one where n is 1.

    A level has an eighth of the rows below it, and each is stored.
    """
    levels, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(parents(levels[-1].where("n > 1"), fan), name))
        most = -(-most // fan)
    return levels


def descend(levels: list[DataFrame], tops: DataFrame, fan: int = FAN) -> DataFrame:
    """The lowest level with the columns of ``tops`` (key, path, ...) of its key, its own steps ahead in ``path``.

    A step holds the siblings on the left and on the right. Going down, a node's
    path is its own step and its parent's path, so only the lowest level joins as
    many rows as there are leaves.
    """
    given = [c for c in tops.columns if c != "key"]
    above = None
    for nodes in reversed(levels):
        rows = join_lookup(nodes.where("n = 1"), tops, "key", "inner")
        if above is not None:
            upper = above.select(F.col("key").alias("_key"), F.col("pos").alias("_run"), *given)
            inner = with_siblings(nodes.where("n > 1"), fan)
            met = inner.join(upper, (F.col("key") == F.col("_key")) & (F.col("run") == F.col("_run")))
            step = F.array(F.struct("left", "right"))
            rows = rows.unionByName(met.withColumn("path", F.concat(step, "path")).select(*rows.columns))
        above = rows
    return above


def proof(path: Column) -> Column:
    """All siblings of a path, from the leaf up and from left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "")


def fold(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, digest, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def trees(leaves: DataFrame, key: str, order: list[str], name: str, fan: int = FAN) -> DataFrame:
    """Rows with ``digest`` and a key that is never null -> with ``subroot``, ``root`` and ``path`` up to the root.

    ``order`` sorts the leaves of a key; the keys' roots are sorted by the key.
    """
    nodes = placed(leaves.withColumnRenamed(key, "key"), "key", order, name)
    levels = climb(nodes, name, fan)
    subroots = None
    for level in levels:
        last = level.where("n = 1").select("key", F.col("digest").alias("subroot"))
        subroots = last if subroots is None else subroots.unionByName(last)
    heads = subroots.select(F.lit("").alias("all"), F.col("key").alias("under"), F.col("subroot").alias("digest"))
    upper = climb(placed(heads.withColumnRenamed("all", "key"), "key", ["under"], name), name, fan)
    root = upper[-1].select("key", F.col("digest").alias("root"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    tops = descend(upper, root, fan).select(F.col("under").alias("key"), F.col("digest").alias("subroot"), "root", "path")
    return descend(levels, stored(tops, name), fan).withColumnRenamed("key", key)


def manifest(documents: DataFrame, fan: int = FAN) -> DataFrame:
    """Columns (doc_id, source, lang, n_chars, text) -> doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaves of a language ascend by doc_id, null first, then by digest; equal
    rows have equal leaves, each with its own place. A null language comes
    first. Documents whose doc_id has a checksum that 3 divides are tampered
    with (capitals of the text made small) before the root is folded anew; a
    null doc_id has no checksum. A null text can't be tampered with, and one
    without capitals stays true. An empty table gives no rows; further columns
    are ignored.
    """
    plain = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    leaves = documents.select(
        "doc_id", F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-")).alias("tree"), leaf(*plain, F.col("text")).alias("digest"),
        F.when(tampered, leaf(*plain, F.translate("text", CAPITALS, SMALL))).alias("changed"))
    rows = trees(leaves, "tree", ["doc_id", "digest"], "merkle", fan)
    folded = rows.withColumn("folded_root", fold(F.coalesce("changed", "digest"), F.col("path")))
    return folded.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", F.sha2(proof(F.col("path")), 256).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
