"""Models are built in order, checked, and published together or not at all."""

import pytest
from pyspark.sql import functions as F

from carelake.operators.quality import TableChecks, table_report
from carelake.plans import publish
from carelake.plans.publish import ChecksFailed, Model


def two_models(**options):
    return [Model("doubled", lambda c: c.withColumn("v", F.col("v") * 2), ("cleaned",), TableChecks(not_null=("v",)), **options),
            Model("cleaned", lambda s: s.where("id > 0"), ("source",), TableChecks(unique=("id",)))]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v int")


def test_order():
    models = [Model(n, lambda *_: None, tuple(refs)) for n, refs in (("d", "bc"), ("b", "a"), ("c", "ab"), ("a", "s"))]
    assert [m.name for m in publish.in_order(models, ["s"])] == ["a", "b", "c", "d"]
    with pytest.raises(ValueError, match="circle"):
        publish.in_order([Model("a", None, ("b",)), Model("b", None, ("a",))], [])
    with pytest.raises(ValueError, match="no model or source named x"):
        publish.in_order([Model("a", None, ("x",))], ["s"])


def test_a_failing_check_leaves_the_old_version(spark, tmp_path):
    root = str(tmp_path)
    publish.create(spark, root)
    with pytest.raises(ValueError, match="nothing is published"):
        publish.read_model(spark, root, "cleaned")
    publish.run_models(two_models(), {"source": frame(spark, [(1, 5), (2, 6), (0, 9)])}, root, "first")
    assert {(r.id, r.v) for r in publish.read_model(spark, root, "doubled").collect()} == {(1, 10), (2, 12)}

    with pytest.raises(ChecksFailed, match="cleaned: unique of id: 1"):
        publish.run_models(two_models(), {"source": frame(spark, [(1, 7), (1, 8), (3, 9)])}, root, "second")
    # The model after the failed one was not built, and readers see the first run of both.
    assert not (tmp_path / "models" / "doubled" / "run=second").exists()
    assert publish.published_run(spark, root) == "first" and publish.read_model(spark, root, "cleaned").count() == 2
    assert [(r.model, r.n_rows, r.test, r.failures) for r in publish.audits(spark, root, ["second"]).collect()] == [("cleaned", 3, "unique", 1)]

    with pytest.raises(ChecksFailed, match="doubled: not_null of v: 1"):
        publish.run_models(two_models(), {"source": frame(spark, [(1, None)])}, root, "second")
    # What was built before the failure stays unpublished, too.
    assert publish.read_model(spark, root, "cleaned").count() == 2
    publish.run_models(two_models(tolerated=frozenset({("v", "not_null")})), {"source": frame(spark, [(1, None)])}, root, "second")
    assert publish.published_run(spark, root) == "second" and publish.read_model(spark, root, "doubled").first().v is None
    with pytest.raises(ValueError, match="published already"):
        publish.run_models(two_models(), {"source": frame(spark, [])}, root, "second")
    with pytest.raises(Exception, match="EXISTS"):
        publish.create(spark, root)


def test_all_checks_take_one_pass(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, None if i % 4 == 0 else i % 3, "abc"[i % 3]) for i in range(40)] + [(7, 1, "z"), (None, 1, "z"), (None, 1, None)]
    spark.createDataFrame(rows, "a int, b int, c string").write.parquet(path)
    wanted = TableChecks(not_null=("a", "b", "c"), unique=("a", "b"), accepted={"c": ("a", "b"), "b": ("0", "1")})
    report = table_report("t", spark.read.parquet(path), wanted)
    assert {(r.column_name, r.test): r.failures for r in report.collect()} == {
        ("a", "not_null"): 2, ("b", "not_null"): 10, ("c", "not_null"): 1, ("a", "unique"): 1, ("b", "unique"): 3,
        ("c", "accepted_values"): 2, ("b", "accepted_values"): 1}
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert table_report("t", spark.read.parquet(path), TableChecks()).count() == 0
