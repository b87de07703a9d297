"""Feed lists to feeds, landed responses to articles, and the time filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmill.functions import markup
from feedmill.functions.urls import feed_key, feed_source
from feedmill.sources.tables import ok_responses


def article_id(line_no: str, item_pos: str) -> Column:
    """An id that sorts by feed line and then by place in the feed."""
    return F.concat_ws(":", F.lpad(F.col(line_no).cast("string"), 12, "0"), F.lpad(F.col(item_pos).cast("string"), 8, "0"))


def dedupe_feeds(lines: DataFrame) -> DataFrame:
    """Feeds from (line_no, line): the first line with a valid URL of each feed key.

    An invalid line doesn't shadow a valid one. The first line is a partial aggregate, not a window, so a
    key with very many lines is fine.
    """
    rows = lines.select("line_no", F.col("line").alias("xml_url"), feed_key("line").alias("feed_key"), feed_source("line").alias("site"))
    rows = rows.where("feed_key <> '' and site is not null")
    first = rows.groupBy("feed_key").agg(F.min(F.struct("line_no", "xml_url", "site")).alias("f"))
    return first.select("f.line_no", "f.site.name", "f.xml_url", "f.site.html_url", "feed_key")


def explode_items(responses: DataFrame) -> DataFrame:
    """Items of each feed body: the columns but body, and item_pos, title, link, date_text, description.

    Items without title and link are dropped; item_pos counts those that stay, from 0 on.
    """
    kept = [c for c in responses.columns if c != "body"]
    parsed = responses.select(*kept, markup.feed_format("body").alias("kind"), F.posexplode(markup.feed_items("body")).alias("pos", "item"))
    out = parsed.select(
        *kept, "pos",
        markup.strip_html(markup.tag_text("item", "title")).alias("title"), markup.item_link("item", F.col("kind")).alias("link"),
        markup.item_date_text("item", F.col("kind")).alias("date_text"), markup.item_description("item", F.col("kind")).alias("description"),
    )
    return out.where("title <> '' or link <> ''").withColumnRenamed("pos", "item_pos")


def parse_articles(feeds: DataFrame, responses: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Articles of all feeds that have a 2xx response, with the columns of the responses that carry names.

    Bodies are parsed where they lie; only items travel to the join with the feeds.
    """
    items = explode_items(ok_responses(responses).select(F.col("url").alias("xml_url"), "body", *carry))
    out = items.join(feeds, "xml_url")
    return out.select(
        article_id("line_no", "item_pos").alias("article_id"), "title", "link", markup.parse_feed_date("date_text").alias("pub_date"),
        "description", F.col("name").alias("source_name"), F.col("html_url").alias("source_url"), F.col("line_no").alias("feed_line_no"), "item_pos", *carry,
    )


def recent(articles: DataFrame, as_of: Column, hours: int, ts: str = "pub_date") -> DataFrame:
    """Articles later than so many hours before as_of; future ones stay."""
    return articles.where(F.col(ts) > as_of - F.make_dt_interval(hours=F.lit(hours)))


def digest_stats(feeds: DataFrame, articles: DataFrame, as_of: Column, hours: int) -> DataFrame:
    """One row: feeds in all, with and without articles; distinct source names; articles before and after the time filter."""
    late = F.col("pub_date") > as_of - F.make_dt_interval(hours=F.lit(hours))
    counts = articles.agg(F.countDistinct("source_name").alias("sources"), F.count("*").alias("articles"), F.count_if(late).alias("recent"))
    per_feed = articles.groupBy("feed_line_no").agg(F.count("*").alias("n"))
    feed_counts = feeds.join(per_feed, feeds["line_no"] == per_feed["feed_line_no"], "left").agg(
        F.count("*").alias("total_feeds"), F.count_if(F.col("n").isNotNull()).alias("ok_feeds"), F.count_if(F.col("n").isNull()).alias("failed_feeds")
    )
    both = feed_counts.select(F.lit(1).alias("one"), "*").join(counts.select(F.lit(1).alias("one"), "*"), "one")
    return both.select("total_feeds", "ok_feeds", "failed_feeds", "sources", "articles", "recent", F.lit(hours).alias("hours"))
