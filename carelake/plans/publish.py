"""Write, audit, publish: models built in the order of their references, checked, and shown all at once.

Under one folder:

    models/<name>/run=<run>   a model's rows of a run
    audit/run=<run>           the row count and the check results of every model of a run
    published                 a row (run, number) for every run that passed

Nothing that readers see changes before the row in ``published`` is written, and
that row changes all models together. A run whose checks fail stays unpublished.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from carelake.operators.quality import TableChecks, table_report

AUDIT = "model string, n_rows bigint, column_name string, test string, failures bigint, tolerated boolean"
PUBLISHED = "run string, number bigint"


class ChecksFailed(Exception):
    """A model broke its checks; ``failures`` lists (column, test, how many)."""

    def __init__(self, model: str, failures: list[tuple[str, str, int]]):
        self.model, self.failures = model, failures
        super().__init__(f"{model}: " + ", ".join(f"{test} of {column}: {n}" for column, test, n in failures))


@dataclass(frozen=True)
class Model:
    """``build`` gets the tables in ``refs``, models or sources, in that order.

    ``tolerated`` names checks, as (column, test), that are recorded and stop nothing.
    """

    name: str
    build: Callable[..., DataFrame]
    refs: tuple[str, ...] = ()
    checks: TableChecks = TableChecks()
    tolerated: frozenset[tuple[str, str]] = frozenset()


def in_order(models: Iterable[Model], sources: Iterable[str]) -> list[Model]:
    """Models so that each comes after all that it refers to, else in the given order."""
    left, known, ordered = {m.name: m for m in models}, set(sources), []
    if missing := {r for m in left.values() for r in m.refs} - known - set(left):
        raise ValueError(f"no model or source named {', '.join(sorted(missing))}")
    while left:
        ready = next((m for m in left.values() if known.issuperset(m.refs)), None)
        if ready is None:
            raise ValueError(f"models refer to each other in a circle: {', '.join(sorted(left))}")
        ordered.append(left.pop(ready.name))
        known.add(ready.name)
    return ordered


def run_models(models: Iterable[Model], sources: Mapping[str, DataFrame], root: str, run: str | None = None) -> str:
    """Build, check and publish; returns the run's name. Raises ``ChecksFailed`` and publishes nothing if a check fails.

    Each model is written once, its rows are counted while they are written, and
    it is checked and referred to as stored. The models after a failed one are
    not built. A run of the same name overwrites what an unfinished one left; a
    published one is refused.
    """
    spark = next(iter(sources.values())).sparkSession
    run = run or uuid.uuid4().hex
    if not _published(spark, root).where(F.col("run") == run).isEmpty():
        raise ValueError(f"run {run} is published already")
    tables, audits, broken = dict(sources), [], None
    for model in in_order(models, sources):
        path, counted = f"{root}/models/{model.name}/run={run}", Observation()
        rows = model.build(*[tables[r] for r in model.refs])
        rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        tables[model.name] = spark.read.schema(rows.schema).parquet(path)
        # A row for each declared check.
        found = [(r.column_name, r.test, r.failures) for r in table_report(model.name, tables[model.name], model.checks).toLocalIterator()]
        size = counted.get["n"]
        audits += [(model.name, size, column, test, n, (column, test) in model.tolerated) for column, test, n in found] or [
            (model.name, size, None, None, 0, False)]
        failed = [(column, test, n) for column, test, n in found if n and (column, test) not in model.tolerated]
        if failed:
            broken = ChecksFailed(model.name, failed)
            break
    spark.createDataFrame(audits, AUDIT).coalesce(1).write.mode("overwrite").parquet(f"{root}/audit/run={run}")
    if broken:
        raise broken
    number = (_published(spark, root).agg(F.max("number")).first()[0] or 0) + 1
    spark.createDataFrame([(run, number)], PUBLISHED).coalesce(1).write.mode("append").json(f"{root}/published")
    return run


def create(spark: SparkSession, root: str) -> None:
    """An empty place to publish in; fails where there is one already."""
    spark.createDataFrame([], PUBLISHED).write.json(f"{root}/published")


def _published(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(PUBLISHED).json(f"{root}/published")


def published_run(spark: SparkSession, root: str) -> str | None:
    """The newest published run, None before the first."""
    newest = _published(spark, root).agg(F.max_by("run", "number").alias("run")).first()
    return newest.run


def read_model(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A model of the newest published run."""
    run = published_run(spark, root)
    if run is None:
        raise ValueError(f"nothing is published in {root}")
    return spark.read.parquet(f"{root}/models/{name}/run={run}")


def audits(spark: SparkSession, root: str, runs: Iterable[str]) -> DataFrame:
    """The recorded counts and checks of the given runs, published or not."""
    frames = [spark.read.schema(AUDIT).parquet(f"{root}/audit/run={r}").select(F.lit(r).alias("run"), "*") for r in runs]
    return reduce(DataFrame.unionByName, frames)
