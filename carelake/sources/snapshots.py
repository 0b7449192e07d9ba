"""Daily full snapshots under ``<table>/dt=YYYY-MM-DD``."""

from __future__ import annotations

import datetime as dt
import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

_DAY = r"/dt=(\d{4}-\d{2}-\d{2})/[^/]*$"
# Stores that tasks open themselves to read a file's last bytes; of files elsewhere Spark hands over the whole content.
_OPENED = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
_TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)


def write_snapshot(df: DataFrame, table_dir: str, run_date: dt.date) -> None:
    """Write one day's full snapshot, replacing that day and no other."""
    # The day's own folder is overwritten, so an empty export replaces it as well.
    day = f"{table_dir.rstrip('/')}/dt={run_date.isoformat()}"
    df.drop("dt").write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(day)


def listed_files(spark: SparkSession, table_dir: str, *more: str) -> DataFrame:
    """(path, day) of every file of a table, from listings only: ``more`` may name the content, which opens the files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table_dir)
    return files.select("path", F.regexp_extract("path", _DAY, 1).alias("day"), *more).where("day <> ''")


def scan_all(spark: SparkSession, table_dir: str) -> DataFrame:
    """All snapshots of a table written with one schema; ``dt`` is a column."""
    return spark.read.parquet(table_dir)


def scan_latest(spark: SparkSession, table_dir: str) -> DataFrame:
    """The newest snapshot. Its day comes from a listing, and only its folder is opened."""
    newest = listed_files(spark, table_dir).agg(F.max("day")).first()[0]
    if newest is None:
        raise ValueError(f"{table_dir} has no day folder")
    rows = spark.read.option("basePath", table_dir).parquet(f"{table_dir.rstrip('/')}/dt={newest}")
    return rows.where(F.col("dt") == F.lit(dt.date.fromisoformat(newest)))


def latest_snapshot(snapshots: DataFrame) -> DataFrame:
    """The rows of the newest day of an already opened table.

    The maximum is a scalar subquery, which prunes partitions at run time.
    """
    newest = snapshots.agg(F.max("dt")).scalar()
    return snapshots.where(F.col("dt") == newest)


def scan_union_by_name(
    spark: SparkSession, table_dir: str, target: T.StructType, keep_dt: bool = False
) -> DataFrame:
    """All snapshots with columns matched by name and cast to declared types.

    Daily files may disagree: other decimal widths, integers that became
    doubles because of a NULL, all-NULL columns stored as INT32, columns that
    come and go; so may the files of one day. Tasks read the footers, all in one
    job whatever the number of files. Files with equal schemas are read together,
    so the plan has one branch per distinct schema; a day whose files agree is
    named by its folder, and only files of other days one by one. A table
    without a day gives an empty frame.
    """
    if keep_dt:
        target = T.StructType([*target.fields, T.StructField("dt", T.DateType(), True)])
    groups: dict[str, list[str]] = defaultdict(list)
    for row in _schema_groups(spark, table_dir).toLocalIterator():
        groups[row.footer] += row.paths
    branches = [
        _conform(spark.read.option("basePath", table_dir).parquet(*sorted(members)), target)
        for members in groups.values()
    ]
    return reduce(DataFrame.unionByName, branches) if branches else spark.createDataFrame([], target)


def _schema_groups(spark: SparkSession, table_dir: str) -> DataFrame:
    """(day, footer, paths): the folder of a day with one schema, else the files of each schema."""
    scheme = listed_files(spark, table_dir).select(F.regexp_extract("path", "^([^:]+):", 1)).first()
    opened = scheme is None or scheme[0] in _OPENED
    files = listed_files(spark, table_dir, *([] if opened else ["content"]))
    footers = files.mapInArrow(_footers, "path string, day string, footer string")
    same = footers.groupBy("day", "footer").agg(F.count("*").alias("n"), F.collect_list("path").alias("files"))
    # All of a day's schemas meet, a row for each; the paths of a day with one schema go again at once.
    days = same.groupBy("day").agg(F.collect_list(F.struct("footer", "files")).alias("kinds"))
    folder = F.array(F.regexp_replace(F.col("kinds")[0]["files"][0], "/[^/]*$", ""))
    kinds = F.when(F.size("kinds") == 1, F.array(F.struct(F.col("kinds")[0]["footer"].alias("footer"), folder.alias("files")))).otherwise(F.col("kinds"))
    return days.select("day", F.explode(kinds).alias("kind")).select("day", "kind.footer", F.col("kind.files").alias("paths"))


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths, or paths with contents, to a digest of the names and types that each file's footer declares."""
    for batch in batches:
        footers = []
        for i, path in enumerate(batch.column(0).to_pylist()):
            if batch.num_columns > 2:
                schema = pq.read_schema(pa.BufferReader(batch.column(2)[i].as_buffer()))
            else:
                store, name = _store(path)
                with store.open_input_file(name) as file:
                    schema = pq.read_schema(file)
            fields = str([(f.name, str(f.type)) for f in schema])
            footers.append(hashlib.md5(fields.encode()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(footers, pa.string())], names=["path", "day", "footer"])


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    scheme, rest = path.split(":", 1)
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pafs.FileSystem.from_uri(path.replace("s3a:", "s3:", 1))


def _conform(source: DataFrame, target: T.StructType) -> DataFrame:
    return source.select(*[_conform_column(source, f).alias(f.name) for f in target])


def _conform_column(source: DataFrame, wanted: T.StructField) -> Column:
    """A source column as the wanted type; a missing column is a typed NULL."""
    if wanted.name not in source.columns:
        return F.lit(None).cast(wanted.dataType)
    stored = source.schema[wanted.name].dataType
    column = F.col(wanted.name)
    if _stands_for_all_null(stored, wanted.dataType):
        complaint = F.concat(F.lit(f"{wanted.name}: unexpected integer "), column.cast("string"))
        return F.when(column.isNotNull(), F.raise_error(complaint)).cast(wanted.dataType)
    if isinstance(stored, T.LongType) and isinstance(wanted.dataType, _TEMPORAL):
        return _from_nanoseconds(column).cast(wanted.dataType)
    return column.cast(wanted.dataType)


def _from_nanoseconds(column: Column) -> Column:
    """A zone-free timestamp from nanoseconds since 1970 (sub-microseconds drop)."""
    whole = (column - F.pmod(column, F.lit(1000))).cast("decimal(20,0)")
    seconds = (whole / F.lit(1_000_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def _stands_for_all_null(stored: T.DataType, wanted: T.DataType) -> bool:
    """An all-NULL column is stored as a 32-bit integer, whatever it was meant to hold."""
    if not isinstance(stored, T.IntegerType):
        return False
    return isinstance(wanted, (*_TEMPORAL, T.BooleanType))
