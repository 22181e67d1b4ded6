"""Cutting lineage in the folder that the cluster shares."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named in `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(SETTING, None)
    if folder:
        return folder.rstrip("/")
    chosen = spark.sparkContext.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    return tempfile.mkdtemp(prefix="tagloom-")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written once to the shared folder, so that lost executors cost no rescan."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()
