from feedmill import schemas
from feedmill.operators.feeds import dedupe_feeds
from feedmill.streaming import landing


def test_articles_come_once(spark, tmp_path):
    feed = "<rss><item><title>{}</title><link>{}</link><pubDate>Mon, 29 Jan 2024 10:00:00 GMT</pubDate></item></rss>"
    land = lambda n, link: spark.createDataFrame([("https://a.dev/feed", 200, "x", feed.format(f"t{n}", link), None)], schemas.RAW_RESPONSES).write.parquet(f"{tmp_path}/in/{n}")
    feeds = dedupe_feeds(spark.createDataFrame([(0, "https://a.dev/feed")], "line_no long, line string"))
    run = lambda: landing.write_articles(landing.articles_stream(landing.responses_stream(spark, f"{tmp_path}/in/*"), feeds), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    land(1, "u1")
    land(2, "u1")
    run()
    land(3, "u2")
    land(4, "u1")
    run()
    assert sorted(r.link for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["u1", "u2"]


def test_dates_of_feeds_make_nothing_late(spark, tmp_path):
    """After a date in 2099 and an unreadable one, an article of 2024 and one of 1999 still come."""
    item = "<rss><item><title>{0}</title><link>{0}</link><pubDate>{1}</pubDate></item></rss>"
    land = lambda n, date: spark.createDataFrame([("https://a.dev/feed", 200, "x", item.format(f"u{n}", date), None)], schemas.RAW_RESPONSES).write.parquet(f"{tmp_path}/in/{n}")
    feeds = dedupe_feeds(spark.createDataFrame([(0, "https://a.dev/feed")], "line_no long, line string"))
    run = lambda: landing.write_articles(landing.articles_stream(landing.responses_stream(spark, f"{tmp_path}/in/*"), feeds), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    for n, date in enumerate(["Thu, 01 Jan 2099 00:00:00 GMT", "soon", "Mon, 29 Jan 2024 10:00:00 GMT", "Fri, 01 Jan 1999 10:00:00 GMT"]):
        land(n, date)
        run()
    assert sorted(r.link for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["u0", "u1", "u2", "u3"]
