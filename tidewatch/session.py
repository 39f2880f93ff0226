"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that may change in a running session. A generated method over 8000
# bytes is never compiled by the JVM; with this limit Spark splits such stages
# instead, which more than halves the time of the wide feature matrix.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
SETTINGS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(name: str = "tidewatch", master: str | None = None, **settings) -> SparkSession:
    """A session in UTC with adaptive execution on; ``settings`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the run-time settings this library counts on."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def working_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and stream state.

    It is what ``spark.checkpoint.dir`` names. Only a local session without
    that setting gets a folder of its own; a cluster must name a shared one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidewatch-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir() or folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared working folder."""
    return os.path.join(working_dir(spark), "tidewatch", f"{label}-{uuid.uuid4().hex}")


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it back.

    Used where several passes read the same derived rows: later passes then
    scan only the columns they need, and a lost executor costs a re-read
    instead of the whole lineage.
    """
    path = new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
