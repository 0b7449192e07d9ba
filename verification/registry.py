"""Collects queries and SQL equivalents under one name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines print alike: text, bigint, double."""
    columns = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            column = column.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(column.alias(f.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL equivalent where there is one."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def shown(relation: str, columns: dict[str, str]) -> str:
    """Select columns of a relation as comparable types: t(ext), i(nt), d(ouble), ts."""
    casts = {"t": "cast({} as varchar)", "i": "cast({} as bigint)", "d": "cast({} as double)",
             "ts": "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"}
    listed = ", ".join(f"{casts[kind].format(name)} as {name}" for name, kind in columns.items())
    return f"select {listed} from {relation}"
