"""Snapshots, collections, lookups and windows at their edges."""

import datetime as dt
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F, types as T

from carelake.operators.chunking import chunk_fixed_window
from carelake.operators.grouping import join_lookup
from carelake.sources import collections, snapshots, written

DAY = dt.date(2024, 1, 1)


def test_files_of_one_day_may_differ(spark, tmp_path):
    path = f"file://{tmp_path}"
    spark.range(2).coalesce(1).write.parquet(f"{path}/dt=2024-01-01")
    spark.range(2, 4).withColumn("status", F.lit("open")).coalesce(1).write.mode("append").parquet(f"{path}/dt=2024-01-01")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType())])
    got = snapshots.scan_union_by_name(spark, path, target).orderBy("id").collect()
    assert [(r.id, r.status) for r in got] == [(0, None), (1, None), (2, "open"), (3, "open")]


def test_nanoseconds_keep_their_microseconds(spark):
    rng = random.Random(1)
    epoch = dt.datetime(1970, 1, 1)
    micros = [rng.randrange(-2 * 10**15, 4 * 10**15) for _ in range(5000)] + [-1, 0, 1]
    rows = spark.createDataFrame([(m, m * 1000 + rng.randrange(1000)) for m in micros], "micros long, nanos long")
    got = rows.select("micros", snapshots._from_nanoseconds(F.col("nanos")).alias("at")).collect()
    assert all(r["at"] == epoch + dt.timedelta(microseconds=r["micros"]) for r in got)


def test_an_empty_export_replaces_the_day(spark, tmp_path):
    path = f"file://{tmp_path}"
    snapshots.write_snapshot(spark.range(3), path, DAY)
    snapshots.write_snapshot(spark.range(0), path, DAY)
    assert snapshots.scan_all(spark, path).count() == 0


def test_collection_names_stay_text(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = [(1, "007"), (2, "7"), (3, "1.0"), (4, "2024-01-01")]
    collections.replace_collections(spark.createDataFrame(rows, "id int, collection string"), path)
    for number, name in rows:
        assert [(r.id, r.collection) for r in collections.read_collection(spark, path, name).collect()] == [(number, name)]


def test_null_keys_meet_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    lookup = spark.createDataFrame([("a", 5), (None, 6)], "k string, v int")
    assert [r.id for r in join_lookup(rows, lookup, "k", "inner").collect()] == [1]
    assert {r.id: r.v for r in join_lookup(rows, lookup, "k").collect()} == {1: 5, 2: None}


@pytest.mark.parametrize("size, overlap", [(500, 300), (10, 9), (7, 0), (6, 3)])
def test_windows_with_any_overlap(spark, size, overlap):
    text = "".join(random.Random(3).choice("abcdé ") for _ in range(1234))
    got = chunk_fixed_window(spark.createDataFrame([(1, text)], "doc_id long, text string"), size, overlap).orderBy("chunk_no")
    expected, at = [], 0
    while True:
        expected.append(text[at:at + size])
        if at + size >= len(text):
            break
        at += size - overlap
    assert [r.chunk for r in got.collect()] == expected


def test_an_overlap_as_long_as_the_window_is_refused(spark):
    with pytest.raises(ValueError):
        chunk_fixed_window(spark.createDataFrame([(1, "x")], "doc_id long, text string"), 5, 5)


@pytest.mark.parametrize("files", [40, 1500])
def test_footers_take_one_job(spark, tmp_path, files):
    """The number of jobs doesn't grow with the number of files."""
    kinds = [{"id": pa.array([1], pa.int64())}, {"id": pa.array([2], pa.int64()), "status": pa.array(["x"])}, {"id": pa.array([3.0])}]
    for i in range(files):
        folder = tmp_path / f"dt=2024-01-0{1 + i % 3}"
        folder.mkdir(exist_ok=True)
        # The first two days have one schema each, the third has two.
        pq.write_table(pa.table(kinds[i % 3] if i % 3 < 2 else kinds[2 - i % 2]), folder / f"part-{i}.parquet")
    target = T.StructType([T.StructField("id", T.LongType()), T.StructField("status", T.StringType())])
    spark.sparkContext.setJobGroup(f"footers-{files}", "")
    frame = snapshots.scan_union_by_name(spark, f"file://{tmp_path}", target, keep_dt=True)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"footers-{files}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Adaptive execution counts each shuffle as a job; reading a group of files asks for its schema, and long lists are listed by a job.
    assert jobs <= 14
    assert frame.count() == files
    assert frame.where("id in (1, 3) and status is not null or id = 2 and status is null").count() == 0
    assert {r.dt.day for r in frame.select("dt").distinct().collect()} == {1, 2, 3}


def test_footers_of_stores_that_only_spark_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(snapshots, "_OPENED", ())
    test_files_of_one_day_may_differ(spark, tmp_path)


def test_a_table_without_days(spark, tmp_path):
    target = T.StructType([T.StructField("id", T.LongType())])
    frame = snapshots.scan_union_by_name(spark, f"file://{tmp_path}", target, keep_dt=True)
    assert frame.columns == ["id", "dt"] and frame.count() == 0
    with pytest.raises(ValueError):
        snapshots.scan_latest(spark, f"file://{tmp_path}")


def test_the_latest_snapshot_opens_one_folder(spark, tmp_path):
    path = f"file://{tmp_path}"
    for day in (1, 2, 3):
        snapshots.write_snapshot(spark.range(day), path, dt.date(2024, 1, day))
    frame = snapshots.scan_latest(spark, path)
    assert frame.count() == 3 and {f.rsplit("/", 2)[1] for f in frame.inputFiles()} == {"dt=2024-01-03"}


def test_emptied_collections(spark, tmp_path):
    path = f"file://{tmp_path}"
    rows = spark.createDataFrame([(1, "a"), (2, "x/y"), (3, "c")], "id int, collection string")
    collections.replace_collections(rows, path)
    collections.replace_collections(rows.where("id = 1").withColumn("id", F.lit(9)), path, ["a", "x/y"])
    assert {(r.id, r.collection) for r in spark.read.parquet(path).collect()} == {(9, "a"), (3, "c")}


def test_written_partitions_views_and_counts(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (-3, "z")], "id int, dt string")
    written.write_partition(rows, root, "dt", "2024-01-01")
    written.write_partition(rows.limit(0), root, "dt", "2024-01-02")
    again = written.write_partition(rows.where("id = 1"), root, "dt", "2024-01-01")
    assert [r.id for r in again.collect()] == [1] and spark.read.parquet(root).count() == 1
    views = [written.materialize_view(rows.where(f"id = {i}")) for i in (1, 2)]
    assert [spark.table(v).first().id for v in views] == [1, 2]
    counts = written.StageCounts()
    kept = counts.passing(counts.passing(rows, "all").where("id > 0"), "kept")
    assert written.materialize_table(kept, f"{root}-table").count() == 2
    assert [tuple(r) for r in counts.table(spark).collect()] == [("all", 3), ("kept", 2)]
