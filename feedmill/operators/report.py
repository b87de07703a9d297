"""Statistics of a digest and its Markdown report, one text for each edition.

A digest row has edition, rank, title, title_zh, link, source_name, pub_date, summary, reason, category,
keywords, relevance, quality, timeliness and total_score. An edition has at most top_n rows, so its rows may
be gathered; nothing is gathered over editions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions.text import or_else
from feedmill.schemas import CATEGORIES

#: Fixed values of the report.
MEDALS = ("🥇", "🥈", "🥉")
BAR_WIDTH, TOP_KEYWORDS, CHART_KEYWORDS, MUST_READ = 20, 12, 10, 10


def keyword_counts(digest: DataFrame) -> DataFrame:
    """(edition, keyword, n, first_rank, first_pos): every occurrence counts, letter case aside."""
    flat = digest.select("edition", "rank", F.posexplode("keywords").alias("pos", "raw"))
    return flat.groupBy("edition", F.lower("raw").alias("keyword")).agg(F.count("*").alias("n"), F.min(F.struct("rank", "pos")).alias("f")).select("edition", "keyword", "n", F.col("f.rank").alias("first_rank"), F.col("f.pos").alias("first_pos"))


def top_keywords(digest: DataFrame, limit: int) -> DataFrame:
    """The most frequent keywords of each edition with their place; ties go by first appearance."""
    place = F.row_number().over(Window.partitionBy("edition").orderBy(F.desc("n"), "first_rank", "first_pos"))
    return keyword_counts(digest).withColumn("place", place).where(F.col("place") <= limit).select("edition", "place", "keyword", "n")


def category_columns(df: DataFrame) -> DataFrame:
    """With emoji and label of the category (six fixed rows)."""
    dim = df.sparkSession.createDataFrame(list(CATEGORIES), "category string, emoji string, label string")
    return df.join(F.broadcast(dim), "category", "left")


def category_counts(digest: DataFrame) -> DataFrame:
    """(edition, category, n, place, emoji, label), most frequent first, ties by first appearance."""
    counts = digest.groupBy("edition", "category").agg(F.count("*").alias("n"), F.min("rank").alias("first_rank"))
    place = F.row_number().over(Window.partitionBy("edition").orderBy(F.desc("n"), "first_rank"))
    return category_columns(counts.withColumn("place", place)).select("edition", "category", "n", "place", "emoji", "label")


def category_sections(digest: DataFrame) -> DataFrame:
    """Digest rows with category_place and running number: larger categories first, rank inside."""
    sized = digest.join(category_counts(digest).select("edition", "category", F.col("place").alias("category_place"), "emoji", "label"), ["edition", "category"])
    number = F.row_number().over(Window.partitionBy("edition").orderBy("category_place", "rank"))
    return sized.withColumn("number", number)


def must_read(digest: DataFrame, limit: int = MUST_READ) -> DataFrame:
    """The first rows of each edition with a medal or number and the heading."""
    medal = F.when(F.col("rank") <= len(MEDALS), F.element_at(F.array(*[F.lit(m) for m in MEDALS]), F.least("rank", F.lit(len(MEDALS))))).otherwise(F.concat(F.col("rank").cast("string"), F.lit(".")))
    return category_columns(digest.where(F.col("rank") <= limit)).withColumn("medal", medal).withColumn("heading", or_else(F.col("title_zh"), F.col("title")))


def keyword_bars(digest: DataFrame, limit: int = CHART_KEYWORDS, width: int = BAR_WIDTH) -> DataFrame:
    """(edition, place, keyword, n, bar, line): bars against the largest count, labels padded to the longest."""
    own = Window.partitionBy("edition")
    top = top_keywords(digest, limit).withColumn("most", F.max("n").over(own)).withColumn("wide", F.max(F.length("keyword")).over(own))
    length = F.greatest(F.lit(1), F.floor(F.col("n") / F.col("most") * width + 0.5)).cast("int")
    bar = F.concat(F.repeat(F.lit("█"), length), F.repeat(F.lit("░"), F.lit(width) - length))
    line = F.concat(F.rpad("keyword", F.col("wide"), F.lit(" ")), F.lit(" │ "), bar, F.lit(" "), F.col("n").cast("string"))
    return top.select("edition", "place", "keyword", "n", bar.alias("bar"), line.alias("line"))


def _ordered(rows: DataFrame, order: str, text: Column, sep: str, name: str) -> DataFrame:
    """One text for each edition from its rows in order."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), text.alias("t")))), lambda x: x["t"]), sep)
    return rows.groupBy("edition").agg(joined.alias(name))


def tag_cloud(digest: DataFrame, limit: int = TOP_KEYWORDS) -> DataFrame:
    """(edition, tags): keywords with counts, the first three bold."""
    word = F.when(F.col("place") <= 3, F.concat(F.lit("**"), "keyword", F.lit("**"))).otherwise(F.col("keyword"))
    return _ordered(top_keywords(digest, limit), "place", F.concat(word, F.lit("("), F.col("n").cast("string"), F.lit(")")), " · ", "tags")


def relative_age(pub_date: Column | str, as_of: Column) -> Column:
    """Minutes, hours or days before as_of; the date from seven days on. Future dates have negative minutes."""
    pub_date = F.col(pub_date) if isinstance(pub_date, str) else pub_date
    ms = F.unix_millis(as_of.cast("timestamp")) - F.unix_millis(pub_date.cast("timestamp"))
    part = lambda unit: F.floor(ms / unit)
    return (
        F.when(part(60_000) < 60, F.concat(part(60_000).cast("string"), F.lit(" 分钟前")))
        .when(part(3_600_000) < 24, F.concat(part(3_600_000).cast("string"), F.lit(" 小时前")))
        .when(part(86_400_000) < 7, F.concat(part(86_400_000).cast("string"), F.lit(" 天前")))
        .otherwise(F.date_format(pub_date, "yyyy-MM-dd"))
    )


def top_preview(digest: DataFrame, limit: int = 10) -> DataFrame:
    """(edition, rank, title, preview) of the first rows."""
    return digest.where(F.col("rank") <= limit).select("edition", "rank", or_else(F.col("title_zh"), F.col("title")).alias("title"), F.concat(F.substring("summary", 1, 80), F.lit("...")).alias("preview"))


def score_range(digest: DataFrame) -> DataFrame:
    """(edition, last_score, first_score): totals of the last and the first row, not the least and the largest."""
    return digest.groupBy("edition").agg(F.max_by("total_score", "rank").alias("last_score"), F.min_by("total_score", "rank").alias("first_score"))


def render_report(digest: DataFrame, highlights: DataFrame, stats: DataFrame, as_of: Column) -> DataFrame:
    """(edition, report) in Markdown for every edition in stats.

    highlights: edition, highlights (missing or empty: no such section). stats: edition, total_feeds, sources,
    articles, recent, hours.
    """
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    string = lambda c: F.col(c).cast("string")
    when = lambda c, t: F.when(c, t).otherwise("")
    age = relative_age("pub_date", as_of)
    labels = when(F.size("keywords") > 0, text("🏷️ ", F.array_join("keywords", ", "), "\n\n"))
    entry = text(
        F.col("medal"), " **", F.col("heading"), "**\n\n[", F.col("title"), "](", F.col("link"), ") — ", F.col("source_name"), " · ", age, " · ", F.col("emoji"), " ", F.col("label"),
        "\n\n> ", F.col("summary"), "\n\n", when(F.col("reason") != "", text("💡 **为什么值得读**: ", F.col("reason"), "\n\n")), labels,
    )
    best = _ordered(must_read(digest), "rank", entry, "", "best")
    pie = _ordered(category_counts(digest), "place", text('    "', F.col("emoji"), " ", F.col("label"), '" : ', string("n"), "\n"), "", "pie")
    top = top_keywords(digest, TOP_KEYWORDS)
    axis = _ordered(top, "place", text('"', F.col("keyword"), '"'), ", ", "axis")
    values = _ordered(top, "place", string("n"), ", ", "vals")
    most = top.groupBy("edition").agg((F.max("n") + 2).cast("string").alias("most"))
    bars = _ordered(keyword_bars(digest), "place", text(F.col("line"), "\n"), "", "bars")
    sections = category_sections(digest).withColumn("heading", or_else(F.col("title_zh"), F.col("title"))).withColumn("first", F.row_number().over(Window.partitionBy("edition", "category").orderBy("number")) == 1)
    item = text(
        when(F.col("first"), text("## ", F.col("emoji"), " ", F.col("label"), "\n\n")), "### ", string("number"), ". ", F.col("heading"), "\n\n[", F.col("title"), "](", F.col("link"), ") — **", F.col("source_name"), "** · ",
        age, " · ⭐ ", (F.col("relevance") + F.col("quality") + F.col("timeliness")).cast("string"), "/30\n\n> ", F.col("summary"), "\n\n", labels, "---\n\n",
    )
    body = _ordered(sections, "number", item, "", "body")
    counts = digest.groupBy("edition").agg(F.count("*").alias("picked"))
    out = stats
    for part in (highlights, counts, best, pie, axis, values, most, bars, tag_cloud(digest), body):
        out = out.join(part, "edition", "left")
    picked = F.coalesce(F.col("picked"), F.lit(0)).cast("string")
    day, clock = F.date_format(as_of, "yyyy-MM-dd"), F.date_format(as_of, "HH:mm")
    report = text(
        "# 📰 AI 博客每日精选 — ", day, "\n\n> 来自 ", string("total_feeds"), " 个技术博客，AI 精选 Top ", picked, "\n\n",
        when(F.coalesce("highlights", F.lit("")) != "", text("## 📝 今日行动指南\n\n", F.col("highlights"), "\n\n---\n\n")),
        F.coalesce(text("## 🏆 今日必读\n\n", F.col("best"), "---\n\n"), F.lit("")),
        "## 📊 数据概览\n\n| 扫描源 | 抓取文章 | 时间范围 | 精选 |\n|:---:|:---:|:---:|:---:|\n| ", string("sources"), "/", string("total_feeds"), " | ", string("articles"), " 篇 → ", string("recent"), " 篇 | ", string("hours"), "h | **", picked, " 篇** |\n\n",
        F.coalesce(text('### 分类分布\n\n```mermaid\npie showData\n    title "文章分类分布"\n', F.col("pie"), "```\n\n"), F.lit("")),
        F.coalesce(text(
            '### 高频关键词\n\n```mermaid\nxychart-beta horizontal\n    title "高频关键词"\n    x-axis [', F.col("axis"), ']\n    y-axis "出现次数" 0 --> ', F.col("most"), "\n    bar [", F.col("vals"), "]\n```\n\n",
            "<details>\n<summary>📈 纯文本关键词图（终端友好）</summary>\n\n```\n", F.col("bars"), "```\n</details>\n\n### 🏷️ 话题标签\n\n", F.col("tags"), "\n\n"), F.lit("")),
        "---\n\n", F.coalesce("body", F.lit("")),
        "*生成于 ", day, " ", clock, " | 扫描 ", string("sources"), " 源 → 获取 ", string("articles"), " 篇 → 精选 ", picked, " 篇*\n",
    )
    return out.select("edition", report.alias("report"))


def report_preview(report: Column | str, limit: int = 3500) -> Column:
    """The report before its overview, without tables, charts and folded parts, cut to so many bytes."""
    report = F.col(report) if isinstance(report, str) else report
    cut = F.regexp_replace(report, r"(?ms)^## 📊 数据概览.*", "")
    cut = F.regexp_replace(cut, r"(?m)^\|.*\n?", "")
    cut = F.regexp_replace(cut, r"(?ms)^```mermaid.*?^```$\n?", "")
    cut = F.regexp_replace(cut, r"(?ms)^[^\n]*<details>.*?</details>[^\n]*\n?", "")
    raw = F.substring(F.encode(cut, "UTF-8"), 1, limit)
    return F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "�\\z", "")
