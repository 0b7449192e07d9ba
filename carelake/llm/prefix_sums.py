"""Running totals over a globally sorted table, without one task for all rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from carelake.session import stored


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def part_starts(totals: DataFrame, part: str, value: str, start: str) -> DataFrame:
    """Totals per part -> (part, start), the sum of all parts before it; one row per part."""
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum(value).over(ahead), F.lit(0)).cast("long").alias(start))


def running_totals(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """Adds ``before``, the sum of ``value`` over all rows that sort ahead, and (``part``, ``place``),
    which together identify a row.

    Rows are sorted by range; each task adds up its own rows; the totals of the
    parts, one row for each partition, are then added up and joined back. The
    table is stored once, so the row identities don't change between reads.
    Rows with a null value count as 0. Rows that tie in ``order`` follow one
    another in any order.
    """
    n = shuffle_partitions(df)
    schema = T.StructType([*df.schema.fields, T.StructField("part", T.IntegerType()),
                           T.StructField("place", T.LongType()), T.StructField("inside", T.LongType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total, place = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            values = batch.column(batch.schema.get_field_index(value)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(values)
            size = len(values)
            columns = [*batch.columns, pa.array(np.full(size, part, np.int32)),
                       pa.array(np.arange(place, place + size)), pa.array(ends - values)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "place", "inside"])
            place += size
            total = int(ends[-1]) if size else total

    ordered = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows = stored(ordered.mapInArrow(add_up, schema), name)
    totals = rows.groupBy("part").agg(F.sum(F.coalesce(value, F.lit(0))).alias("total"))
    starts = part_starts(totals, "part", "total", "part_start")
    # One row for each shuffle partition.
    return (rows.join(F.broadcast(starts), "part")
            .withColumn("before", F.col("inside") + F.col("part_start")).drop("inside", "part_start"))
