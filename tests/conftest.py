import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from verbatide import build_session

    session = build_session(
        "tests",
        "local[*]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture
def column(spark):
    """Apply a column function to a list of values, in order."""
    from pyspark.sql import functions as F

    def apply(function, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        out = rows.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()
        return [r["o"] for r in out]

    return apply
