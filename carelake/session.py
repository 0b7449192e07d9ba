"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings the operators rely on. AQE splits skewed join partitions and
# coalesces small ones; UTC keeps date casts stable.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # pandas writes nanosecond timestamps; read them as integers and convert.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Recording the Python call site of every column expression costs more than
    # planning does.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "carelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; extra settings go in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession, local_folder: str = "/tmp/carelake-checkpoints") -> None:
    """Make a session that somebody else built ready for the library.

    Sends the package to the workers, which may run in any folder. A session on
    one machine that names no shared folder gets ``local_folder``; a cluster must
    name one itself.
    """
    ship_package(spark)
    if not spark.conf.get(CHECKPOINT_DIR, None) and spark.sparkContext.master.startswith("local["):
        spark.conf.set(CHECKPOINT_DIR, f"file://{local_folder}")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's source files to the workers, once for each application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="carelake-package-"), "carelake.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table, in the folder that ``spark.checkpoint.dir`` names."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return f"{base.rstrip('/')}/carelake/{uuid.uuid4().hex}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once to the shared folder and read back.

    For a result that several branches of a plan use: it is computed once, its
    columns can be pruned, and losing an executor costs no recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
