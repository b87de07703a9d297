"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []
_scopes: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or where that is unset and one machine runs all, as in tests, a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="spark-shared-"))
    return _own[0]


def columns_of(df: DataFrame) -> list[Column]:
    """All columns of df, whatever they are called."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def written(df: DataFrame) -> DataFrame:
    """The same rows, read back from a Parquet table: cuts the lineage and survives lost executors.

    The table lives as long as the tables() block around the call, else until the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/feedmill-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _scopes:
        _scopes[-1].append(path)
    else:
        system, at = _at(spark, path)
        system.deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def tables(spark: SparkSession):
    """Owns the tables written inside the block and deletes them after it, and no others.

    What is computed from them must be collected before the block ends, or written with outside().
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            system, at = _at(spark, path)
            system.delete(at, True)
        spark._jvm.System.gc()  # lets Spark drop the shuffle files of what is no longer used


def outside(df: DataFrame) -> DataFrame:
    """written(df), as a table of what is around the innermost tables() block."""
    scope = _scopes.pop()
    try:
        return written(df)
    finally:
        _scopes.append(scope)
