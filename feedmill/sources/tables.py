"""Readers and writers of the feed list, the blog table, the issues, landed responses, clippings and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from feedmill import schemas
from feedmill.functions.text import filled, strip
from feedmill.functions.urls import normalize_url
from feedmill.sources.ordered import ordered

#: Headers of the blog table, in the order of the columns.
BLOG_HEADERS = ("周刊名称", "周刊链接", "博客名称", "博客链接", "RSS订阅地址")
BLOG_COLUMNS = ("weekly_name", "weekly_url", "blog_name", "blog_url", "rss")


def feed_lines(texts: DataFrame) -> DataFrame:
    """The columns of texts but value, and line_no and line of whole feed lists (value): stripped, without blanks and # comments."""
    kept = [c for c in texts.columns if c != "value"]
    rows = texts.select(*kept, F.posexplode(F.split("value", r"\r?\n")).alias("n", "raw"))
    return rows.select(*kept, F.col("n").cast("long").alias("line_no"), strip("raw").alias("line")).where("line <> '' and not startswith(line, '#')")


def read_feed_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a feed list, one file or the parts of a table, with their numbers from 0 on in file order; CRLF is fine."""
    lines = ordered(spark.read.option("lineSep", "\n").text(path), "line_no")
    return lines.select("line_no", strip("value").alias("line")).where("line <> '' and not startswith(line, '#')").orderBy("line_no")


def write_feed_list(urls: DataFrame, path: str) -> None:
    """One URL a line, by line_no."""
    urls.orderBy("line_no").select("url").write.mode("overwrite").text(path)


def read_blogs_csv(spark: SparkSession, path: str) -> DataFrame:
    """The blog table with row numbers from 0 on in file order: stripped, URLs normalized, missing values empty. A byte order mark is fine."""
    schema = ", ".join(f"`{h}` string" for h in BLOG_HEADERS)
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', schema=schema, enforceSchema=False)
    rows = ordered(raw, "row_no")
    clean = {"weekly_url": normalize_url, "blog_url": normalize_url}
    return rows.select("row_no", *[clean.get(c, lambda v: strip(filled(v)))(F.col(f"`{h}`")).alias(c) for h, c in zip(BLOG_HEADERS, BLOG_COLUMNS, strict=True)])


def write_blogs_csv(rows: DataFrame, path: str) -> None:
    """All rows by row_no under the five headers."""
    out = rows.orderBy("row_no").select(*[F.col(c).alias(h) for h, c in zip(BLOG_HEADERS, BLOG_COLUMNS, strict=True)])
    out.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="")


def issues_from_json(texts: DataFrame) -> DataFrame:
    """(issue, title, url) from rows (value) that each hold a JSON array of issues, numbered from 1 in its order."""
    items = texts.select(F.posexplode(F.from_json("value", "array<struct<title: string, url: string>>")).alias("n", "i"))
    return items.select((F.col("n") + 1).alias("issue"), filled("i.title").alias("title"), normalize_url("i.url").alias("url"))


def read_issues(spark: SparkSession, path: str) -> DataFrame:
    """Issues from a JSON array file, or from a folder of JSON lines as write_issues leaves it."""
    texts = spark.read.text(path, wholetext=True)
    lines = texts.where("not startswith(ltrim(value), '[')").select(F.explode(F.split("value", "\n")).alias("line")).where("line <> ''")
    own = lines.select(F.from_json("line", schemas.ISSUES).alias("i")).select("i.issue", filled("i.title").alias("title"), normalize_url("i.url").alias("url"))
    return issues_from_json(texts.where("startswith(ltrim(value), '[')")).unionByName(own)


def write_issues(issues: DataFrame, path: str) -> None:
    """The whole list, also issues whose page failed, as JSON lines."""
    issues.orderBy("issue").select("issue", "title", "url").write.mode("overwrite").json(path)


def read_responses(spark: SparkSession, path: str, exact: bool = False) -> DataFrame:
    """Landed responses with status 2xx, or exactly 200."""
    rows = spark.read.schema(schemas.RAW_RESPONSES).parquet(path)
    return ok_responses(rows, exact)


def ok_responses(responses: DataFrame, exact: bool = False) -> DataFrame:
    return responses.where("http_status = 200" if exact else "http_status between 200 and 299")


def write_clippings(clippings: DataFrame, path: str) -> int:
    """Parquet of (edition, file_name, markdown) by edition, of the editions given alone; returns how many it wrote."""
    written = Observation()
    rows = clippings.observe(written, F.count("*").alias("n"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("edition").parquet(path)
    return written.get["n"]


def write_report(report: DataFrame, path: str) -> None:
    """The report text of each edition in a file of its own folder."""
    report.select("edition", F.col("report").alias("value")).write.mode("overwrite").partitionBy("edition").text(path)
