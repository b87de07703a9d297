"""The clipping workload: a digest and landed pages to saved Markdown documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.operators import clippings as C


def clippings(digest: DataFrame, responses: DataFrame, as_of: Column) -> DataFrame:
    """digest rows (article_id, edition, rank, title, link ...) with file_name and markdown; rows without a page are dropped."""
    pages = responses.where("http_status between 200 and 299").select(F.col("url").alias("link"), C.response_markdown().alias("markdown")).where("markdown is not null")
    first = pages.groupBy("link").agg(F.min("markdown").alias("markdown"))
    return C.clip_names(digest, as_of).join(first, "link")


def documents(clipped: DataFrame, jobs: DataFrame, answers: DataFrame) -> DataFrame:
    """(edition, file_name, markdown) with translations put in and the header on top."""
    done = C.apply_translations(clipped, jobs, answers)
    return done.select("edition", "file_name", C.clipping_markdown().alias("markdown"))
