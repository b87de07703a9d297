"""Feeds as a stream: responses that land in a folder become articles once, as they come.

The recurrence that a timer gives a batch job is a trigger here, and its state files are the checkpoint
of the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedmill import schemas
from feedmill.operators.feeds import parse_articles


def responses_stream(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    """Landed responses of a folder of Parquet files, with landed_at, when their file came."""
    files = spark.readStream.schema(schemas.RAW_RESPONSES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return files.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def articles_stream(responses: DataFrame, feeds: DataFrame, lateness: str = "7 days") -> DataFrame:
    """Articles of the responses of a stream and a table of feeds; an article that lands again within lateness is dropped.

    Time is the time of landing: dates that feeds write, future or unreadable ones among them, neither drop an
    article nor make others late.
    """
    articles = parse_articles(feeds, responses, ("landed_at",))
    return articles.withWatermark("landed_at", lateness).dropDuplicatesWithinWatermark(["source_url", "link"])


def write_articles(articles: DataFrame, path: str, checkpoint: str):
    """Append what has landed to a Parquet table and stop."""
    return articles.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(path)
