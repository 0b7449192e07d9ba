"""Group totals and numbering that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def join_lookup(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left", nulls_meet: bool = False) -> DataFrame:
    """Join rows with a table that has one row per key, whatever the key's skew.

    A NULL key meets nothing, unless ``nulls_meet``.

    A small lookup is broadcast by the optimizer's own size check. Otherwise
    adaptive execution splits a hot key's rows over many tasks, but only where
    both join sides come straight out of a shuffle. A lookup that was just
    aggregated by the same key does not: its partitioning would be reused. The
    null-safe comparison gives it a shuffle of its own, of one row per key.
    """
    other = "__lookup_key"
    renamed = (lookup if nulls_meet else lookup.where(F.col(key).isNotNull())).withColumnRenamed(key, other)
    return rows.join(renamed, F.col(key).eqNullSafe(F.col(other)), how).drop(other)


def attach_group_totals(rows: DataFrame, key: str, totals: list[Column]) -> DataFrame:
    """Every row plus the aggregates of its group; NULL keys form one group.

    The same result as an unordered window, which would send each group to one
    task. Here the aggregation combines before its shuffle and is joined back.
    ``rows`` is read twice, the first time with the aggregated columns only; pass
    a stored table if it is costly to compute.
    """
    return join_lookup(rows, rows.groupBy(key).agg(*totals), key, nulls_meet=True)


def number_rows(rows: DataFrame, unique_text: Column, number: str) -> DataFrame:
    """Dense numbers 1..n in the order of the MD5 of a unique text.

    Rows fall into 65,536 buckets by the first four hex digits of the digest.
    Bucket counts (at most 65,536 rows) give each bucket its offset, rows are
    numbered inside their bucket, and no task ever sees the whole table.
    """
    bucketed = rows.withColumn("__digest", F.md5(unique_text.cast("string"))).withColumn(
        "__bucket", F.substring("__digest", 1, 4)
    )
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("__bucket")
        .agg(F.count("*").alias("__n"))
        .select(F.col("__bucket"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    inside = Window.partitionBy("__bucket").orderBy("__digest")
    return (
        bucketed.join(F.broadcast(offsets), "__bucket")
        .withColumn(number, F.col("__offset") + F.row_number().over(inside))
        .drop("__digest", "__bucket", "__offset")
    )
