"""Places of rows in an order inside each key, counted by all tasks at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.llm.scratch import written


def sorted_table(df: DataFrame, *order: Column | str) -> DataFrame:
    """df in this order over all tasks, written, with at: a number that ascends with it."""
    return written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))


def task() -> Column:
    """The task that gave a row its at."""
    return F.shiftrightunsigned("at", 33)


def shifts(placed: DataFrame, *keys: str) -> DataFrame:
    """(keys, task, shift, total) of a sorted_table whose order begins with keys: at + shift is a row's place in its key, total the key's rows.

    A key has a row for each task that holds rows of it, so the window runs over few rows even for a key that all
    tasks share.
    """
    sizes = placed.groupBy(*keys, task().alias("task")).agg(F.count("*").alias("n"), F.min("at").alias("first"))
    own = Window.partitionBy(*keys)
    before = F.coalesce(F.sum("n").over(own.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return sizes.select(*keys, "task", (before - F.col("first")).alias("shift"), F.sum("n").over(own).alias("total"))
