"""The digest workload: feeds and landed responses to a ranked digest and its report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.operators import diversity, feeds, report, scoring


def scored_articles(feed_lines: DataFrame, responses: DataFrame, model_responses: DataFrame, as_of: Column, hours: int = 48) -> DataFrame:
    """Recent articles with idx, batch_id and scores from the landed answers to their prompts."""
    listed = feeds.dedupe_feeds(feed_lines)
    articles = feeds.recent(feeds.parse_articles(listed, responses), as_of, hours)
    batches = scoring.assign_batches(articles, ["article_id"])
    return scoring.attach_scores(batches, scoring.parse_score_responses(model_responses))


def digest(scored: DataFrame, summaries: DataFrame, top_n: int = 30) -> DataFrame:
    """The top_n of one edition with rank and summaries; summaries: landed answers by batch of rank."""
    top, _ = diversity.select_diverse(scored, top_n)
    numbered = top.drop("idx", "batch_id").withColumn("idx", (F.col("rank") - 1).cast("long")).withColumn("batch_id", F.expr(f"idx div {scoring.BATCH}"))
    return scoring.attach_summaries(numbered, summaries)


def digest_report(feed_lines: DataFrame, responses: DataFrame, model_responses: DataFrame, summaries: DataFrame, highlights: str, as_of: Column, hours: int = 48, top_n: int = 30, edition: str = "all") -> DataFrame:
    """(edition, report) from landed tables alone."""
    listed = feeds.dedupe_feeds(feed_lines)
    articles = feeds.parse_articles(listed, responses)
    stats = feeds.digest_stats(listed, articles, as_of, hours).withColumn("edition", F.lit(edition))
    rows = digest(scored_articles(feed_lines, responses, model_responses, as_of, hours), summaries, top_n).withColumn("edition", F.lit(edition))
    return report.render_report(rows, stats.select("edition", F.lit(highlights).alias("highlights")), stats, as_of)
