"""Tables and views that models are written to, and counts taken while rows pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def materialize_table(rows: DataFrame, path: str) -> DataFrame:
    """Write a model, replacing what is there, and read it back with the same schema."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def materialize_view(rows: DataFrame, prefix: str = "model") -> str:
    """Name a model for SQL without computing it; the name is the session's own and new each time."""
    name = f"{prefix}_{uuid.uuid4().hex}"
    rows.createOrReplaceTempView(name)
    return name


def write_partition(rows: DataFrame, root: str, column: str, value: str) -> DataFrame:
    """Replace one partition of a table and no other; read back with the partition's column."""
    path = f"{root}/{column}={value}"
    rows.drop(column).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return rows.sparkSession.read.option("basePath", root).parquet(path)


class StageCounts:
    """Row counts of the stages of a plan, taken by whatever action runs it, not by jobs of their own.

    Wrap the stages with ``passing``, run the plan once, then read ``table``.
    """

    def __init__(self):
        self._stages: list[tuple[str, Observation]] = []

    def passing(self, rows: DataFrame, stage: str) -> DataFrame:
        seen = Observation()
        self._stages.append((stage, seen))
        return rows.observe(seen, F.count(F.lit(1)).alias("n"))

    def table(self, spark: SparkSession) -> DataFrame:
        """(stage, n_rows) in the order of wrapping; waits until the plan has run."""
        return spark.createDataFrame([(stage, seen.get["n"]) for stage, seen in self._stages], "stage string, n_rows bigint")
