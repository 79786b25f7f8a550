"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Kept small: everything else is Spark's default or the cluster's own choice.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",  # malformed casts raise instead of giving null
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "verbatide", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; on a cluster ``master`` comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only where driver and tasks are one process may it fall back to a temporary folder, which is
    removed at exit: on a cluster such a folder would exist on one machine and be lost with it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="verbatide-")  # one process holds all tasks; gone when it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder once, so later stages (and lost executors) reread it,
    the columns and rows that they need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
