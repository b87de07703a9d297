"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def new_path(spark: SparkSession) -> str:
    """A new path in spark.checkpoint.dir; where that is unset and one machine runs all, as in tests, in a temporary folder. Gone when the application ends."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
        shared = _own[0]
    path = f"{shared}/feedmill-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of what is no longer used."""
    spark._jvm.System.gc()


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from a Parquet table: computed once, and there when executors are lost."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
