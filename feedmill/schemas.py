"""Schemas of the landed and derived tables, and the category dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_RESPONSES = "url string, http_status int, content_type string, body string, fetched_at timestamp"
FEEDS = "line_no long, name string, xml_url string, html_url string, feed_key string"
ARTICLES = "article_id string, title string, link string, pub_date timestamp, description string, source_name string, source_url string, feed_line_no long, item_pos int"
MODEL_RESPONSES = "batch_id long, response string, error string"
ISSUES = "issue int, title string, url string"
BLOGS = "row_no long, weekly_name string, weekly_url string, blog_name string, blog_url string, rss string"

#: Categories with their emoji and label.
CATEGORIES = (
    ("ai-ml", "🤖", "AI / ML"),
    ("security", "🔒", "安全"),
    ("engineering", "⚙️", "工程"),
    ("tools", "🛠", "工具 / 开源"),
    ("opinion", "💡", "观点 / 杂谈"),
    ("other", "📝", "其他"),
)
CATEGORY_IDS = tuple(c for c, _, _ in CATEGORIES)


def category_dim(spark: SparkSession) -> DataFrame:
    """Six rows: category, emoji, label."""
    return spark.createDataFrame(list(CATEGORIES), "category string, emoji string, label string")
