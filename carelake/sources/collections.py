"""Vector collections: Parquet partitioned by collection name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# The characters that a partition folder's name holds as %XX.
_ESCAPED = frozenset("\"#%'*/:=?\\\x7f{[]^" + "".join(map(chr, range(32))))


def replace_collections(vectors: DataFrame, path: str, names: Iterable[str] | None = None) -> None:
    """Write collections, each replacing its stored version; others stay.

    ``names`` lists the collections to replace; one that has no vectors is then
    emptied, and vectors of others are not written. Without it those that have
    vectors are replaced. The rebalance gives each collection few files, and a
    large one several tasks.
    """
    wanted = None if names is None else sorted(set(names))
    rows = vectors if wanted is None else vectors.where(F.col("collection").isin(wanted))
    (
        rows.hint("rebalance", "collection")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("collection")
        .parquet(path)
    )
    if wanted is not None:
        # At most one name for each of the given ones.
        filled = {row[0] for row in rows.select("collection").distinct().toLocalIterator()}
        for name in wanted:
            if name not in filled:
                folder = "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in name)
                vectors.drop("collection").limit(0).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/collection={folder}")


def read_collection(spark: SparkSession, path: str, collection: str) -> DataFrame:
    """One collection; the equality prunes every other folder."""
    found = spark.read.parquet(path).schema
    # Declared as text: a name like 007 would be read as a number.
    named = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "collection" else f for f in found])
    return spark.read.schema(named).parquet(path).where(F.col("collection") == F.lit(collection))


def check_width(vectors: DataFrame, column: str, width: int) -> DataFrame:
    """Fail on a vector of another width, or with a NULL in it."""
    bad = (F.size(column) != width) | F.exists(column, lambda x: x.isNull())
    complaint = F.concat(F.lit(f"{column}: expected width {width}, got "), F.size(column).cast("string"))
    return vectors.withColumn(column, F.when(bad, F.raise_error(complaint)).otherwise(F.col(column)))
