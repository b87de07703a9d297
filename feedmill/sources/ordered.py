"""Places of rows in files, over any number of files and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Columns that name a split, in the order of what a writer of sorted rows left: folder, part number, file, place in the file.
_SPLIT = ("_folder", "_part", "_file", "_start")


def ordered(rows: DataFrame, name: str) -> DataFrame:
    """rows, straight from a file reader, with their place from 0 on, in order of files, and in a file of lines.

    Part files go by their number, which Spark's writers give in the order of a sort; others by their path. Rows are
    counted by split in one pass, a row for each split is added up, and a row's place is that of its split and its own
    in it. It doesn't depend on how Spark packs splits into tasks.
    """
    path = F.col("_metadata.file_path")
    at = rows.select(
        *[F.col(f"`{c}`") for c in rows.columns], F.regexp_extract(path, "^(.*)/[^/]*$", 1).alias("_folder"), F.regexp_extract(path, r"/part-(\d+)[^/]*$", 1).try_cast("long").alias("_part"),
        path.alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at"),
    )
    sizes = at.groupBy(*_SPLIT).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shift = sizes.select("_file", "_start", (before - F.col("_first")).alias("_shift"))
    placed = at.join(shift, ["_file", "_start"])
    return placed.select(*[F.col(f"`{c}`") for c in rows.columns], (F.col("_at") + F.col("_shift")).alias(name))
