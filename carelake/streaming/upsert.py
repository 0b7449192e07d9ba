"""Contacts in versions, with a log of the updates that came since.

Rewriting the contact table for every micro-batch would cost its whole size
each time. Each batch therefore appends only its folded updates to a log, and
``compact`` now and then merges the log into a new version. Under one folder:

    base/version=N      the contacts of a version, with what its merge did to each
    commits             a row (version, merged_batch) for every finished version
    log/batch_id=N      the folded updates of a batch
    batches             a row for every finished batch
    quarantine/...      rejected updates with their reason
    checkpoint          the stream's own, so batch numbers and log belong together

A version counts from its commit on, a batch from its row in ``batches`` on.
Readers take the newest version and the finished batches after the last one that
it holds, so batches may arrive while a version is written, and a step that
failed in the middle is simply done again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from carelake.operators.contacts import fold_updates, merge_contacts, refold, without_number
from carelake.operators.contracts import check_summaries, quarantined, valid
from carelake.session import stored

COMMITS, BATCHES = "version long, merged_batch long", "batch_id long"
# Stands for no batch at all in a new table.
NO_BATCH = -1


def create(contacts: DataFrame, root: str) -> None:
    """Version 0 from the given contacts, with an empty log. Fails where contacts are already."""
    spark = contacts.sparkSession
    contacts.withColumn("merge_action", F.lit("unchanged")).write.parquet(f"{root}/base/version=0")
    _finish(spark, root, NO_BATCH)
    _commit(spark, root, 0, NO_BATCH)


def _commit(spark: SparkSession, root: str, version: int, merged_batch: int) -> None:
    """One row in one file, which the store shows whole or not at all."""
    spark.createDataFrame([(version, merged_batch)], COMMITS).coalesce(1).write.mode("append").json(f"{root}/commits")


def newest(spark: SparkSession, root: str) -> Row:
    """(version, merged_batch) of the newest finished version."""
    commits = spark.read.schema(COMMITS).json(f"{root}/commits")
    return commits.agg(F.max(F.struct("version", "merged_batch")).alias("it")).select("it.*").first()


def last_batch(spark: SparkSession, root: str) -> int:
    """The newest finished batch; they finish in order. -1 if there is none yet."""
    return spark.read.schema(BATCHES).json(f"{root}/batches").agg(F.max("batch_id")).first()[0]


def _finish(spark: SparkSession, root: str, batch_id: int) -> None:
    spark.createDataFrame([(batch_id,)], BATCHES).coalesce(1).write.mode("append").json(f"{root}/batches")


def write_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Fold the valid summaries of a batch into its log folder, and set the others aside.

    A batch that is run again after a failure overwrites its folders; one that
    was finished before is left alone, since readers may be at it.
    """
    spark = batch.sparkSession
    if batch_id <= last_batch(spark, root):
        return
    checked = check_summaries(batch, "summary_json").persist()
    try:
        fold_updates(valid(checked)).write.mode("overwrite").parquet(f"{root}/log/batch_id={batch_id}")
        rejected = quarantined(checked).unionByName(without_number(valid(checked)), allowMissingColumns=True).drop("summary")
        rejected.write.mode("overwrite").parquet(f"{root}/quarantine/batch_id={batch_id}")
    finally:
        checked.unpersist()
    _finish(spark, root, batch_id)


def stream_upsert(summaries: DataFrame, root: str) -> StreamingQuery:
    """Start the update stream; it stops when the available input is processed."""
    return (
        summaries.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root))
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def _version(spark: SparkSession, root: str, commit: Row) -> DataFrame:
    return spark.read.parquet(f"{root}/base/version={commit.version}")


def _merged(spark: SparkSession, root: str, commit: Row, upto: int) -> DataFrame:
    """A version's contacts with the batches after its own up to another, in message order."""
    base = _version(spark, root, commit).drop("merge_action")
    if upto <= commit.merged_batch:
        return base.withColumn("merge_action", F.lit("unchanged"))
    # The partition filter keeps older batches' folders from being opened.
    log = spark.read.parquet(f"{root}/log").where(F.col("batch_id").between(commit.merged_batch + 1, upto))
    return merge_contacts(base, stored(refold(log.drop("batch_id"), "clean"), "folded-log"))


def current_contacts(spark: SparkSession, root: str) -> DataFrame:
    """The newest version with every finished batch after it."""
    return _merged(spark, root, newest(spark, root), last_batch(spark, root))


def newest_version(spark: SparkSession, root: str) -> DataFrame:
    """The contacts of the newest version; ``merge_action`` is what its merge did to each, as written. The log is not read."""
    return _version(spark, root, newest(spark, root))


def compact(spark: SparkSession, root: str) -> int:
    """Write the current contacts as a new version; returns its number.

    The batches to merge are settled first; what arrives meanwhile stays in the
    log for the readers of the new version. An unfinished version of an earlier
    attempt is overwritten. Without new batches nothing is written.
    """
    commit, upto = newest(spark, root), last_batch(spark, root)
    if upto <= commit.merged_batch:
        return commit.version
    version = commit.version + 1
    _merged(spark, root, commit, upto).write.mode("overwrite").parquet(f"{root}/base/version={version}")
    _commit(spark, root, version, upto)
    return version


def prune(spark: SparkSession, root: str, versions: int = 2) -> None:
    """Drop versions older than the newest few, and the batches that all of those hold.

    Batches and versions that go are overwritten in place by one row of nulls,
    all in one job and without touching the others. Readers that began
    with an older version than those kept fail.
    """
    commits = spark.read.schema(COMMITS).json(f"{root}/commits")
    oldest = commits.orderBy(F.desc("version")).limit(versions).agg(F.min("version").alias("version"), F.min("merged_batch").alias("batch")).first()
    if oldest.batch > NO_BATCH:
        _empty(spark.read.parquet(f"{root}/log"), "batch_id", oldest.batch, "clean", f"{root}/log")
    if oldest.version > 0:
        _empty(spark.read.parquet(f"{root}/base"), "version", oldest.version - 1, "id", f"{root}/base")


def _empty(rows: DataFrame, part: str, upto: int, key: str, path: str) -> None:
    """Overwrite the partitions up to a number by a row of nulls each; those emptied before are left alone."""
    full = rows.where(F.col(part) <= upto).groupBy(part).agg(F.count(key).alias("n")).where("n > 0")
    nulls = full.select(*[F.col(f.name) if f.name == part else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema])
    nulls.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(path)
