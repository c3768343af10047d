"""Tables that are written once to the folder that all executors share, and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; on a single machine a new folder where that is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        folder = "file://" + tempfile.mkdtemp(prefix="spark-scriva-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def store(df: DataFrame, name: str) -> str:
    """Writes df to a new place in the shared folder, and returns the place."""
    path = f"{shared_dir(df.sparkSession)}/{df.sparkSession.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back."""
    return df.sparkSession.read.schema(df.schema).parquet(store(df, name))
