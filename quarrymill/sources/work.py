"""Folders for intermediate tables that all executors see, and the file system that a path is on."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession


def file_system(spark: SparkSession, path: str):
    """(Hadoop's file system, its path)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def delete(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        delete(spark, path)
    except Exception:  # the session may be over
        pass


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared one (``spark.checkpoint.dir``, or the warehouse where that is unset), deleted when the driver exits.

    On a cluster the warehouse must not be a folder of this machine, which the executors' machines don't share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local") and str(file_system(spark, root)[0].getScheme()) == "file":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    at = f"{root.rstrip('/')}/reports-{uuid.uuid4().hex}"
    atexit.register(_delete_quietly, spark, at)
    return at


def written(df: DataFrame, path: str) -> DataFrame:
    """The table as written: it reads the same each time, and a lost executor repeats nothing before it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
