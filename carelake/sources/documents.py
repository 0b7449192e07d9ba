"""Knowledge documents and message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def scan_markdown(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (source, text)."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("text")
    )


def scan_table_documents(documents: DataFrame) -> DataFrame:
    """Documents kept in a table, as (doc_id, source, text)."""
    return documents.select("doc_id", "source", "text").where(F.col("text").isNotNull())


def message_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_glob: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A file stream of messages in a declared schema."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
