import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from carelake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def values(spark):
    """Evaluate expressions over one text column: values(["a", None], fn) -> list."""
    from pyspark.sql import functions as F

    def run(inputs, expression, kind="string"):
        rows = [(i, v) for i, v in enumerate(inputs)]
        frame = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in frame.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]

    return run
