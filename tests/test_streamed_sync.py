"""Discovery in several landings against one run."""

import random

from pyspark.sql import functions as F

from feedmill.functions.urls import FEED_PATHS, SITE
from feedmill.plans.sync import sync
from feedmill.schemas import BLOGS, ISSUES
from feedmill.sources.state import latest, read_state
from feedmill.streaming import discovery as S

RSS = '<?xml version="1.0"?><rss><channel/></rss>'
DAY = "2024-01-{:02d} 00:00:00"


def world(seed):
    """Rows (kind, url, http_status, body) of one crawl, and the state before it."""
    rng = random.Random(seed)
    marks = [f"{SITE}/blog/weekly-issue-{i}.html" for i in range(8)]
    listing = [("listing", "list", 200, "".join(f'<a href="{m}">Issue {i}</a>' for i, m in enumerate(marks)))]
    links = {m: [f"https://blog{rng.randrange(12)}.dev" for _ in range(4)] for m in marks}
    pages = [("issue", m, 404 if i == 5 else 200, "".join(f'<p><a href="{b}">Blog {b[12:]}</a></p>' for b in links[m])) for i, m in enumerate(marks) if i != 6]
    feeds = []
    for k in range(12):
        for path in FEED_PATHS:
            if rng.random() < 0.6:
                feeds.append(("feed", f"https://blog{k}.dev{path}", 200, rng.choice([RSS, "<html>", "<?xml version='1.0'?><html>", "x"])))
    feeds += [("feed", f"https://old{k}.dev/feed", 200, RSS if k % 2 else "gone") for k in range(6)]
    blogs = [(k, "w", "u", "b", f"https://old{k}.dev", "" if k == 3 else f"https://old{k}.dev/feed") for k in range(7)] + [(7, "w", "u", "b", "https://blog1.dev", "")]
    listed = [(k, f"https://old{k}.dev/feed") for k in (0, 1, 2, 6)]
    return listing, pages, feeds, blogs, [(1, "Issue 0", marks[0])], listed


def frames(spark, w):
    listing, pages, feeds, blogs, issues, listed = w
    df = lambda rows: spark.createDataFrame(rows, "kind string, url string, http_status int, body string")
    return df(listing).select("url", "body"), df(pages).drop("kind"), spark.createDataFrame(issues, ISSUES), spark.createDataFrame(blogs, BLOGS), spark.createDataFrame(listed, "line_no long, url string"), df(feeds).drop("kind")


def told(state):
    return sorted(map(tuple, state.blogs.select("blog_url", "rss", "blog_name").collect())), sorted(r.url for r in state.feed_list.collect())


def test_landings_in_any_cut_equal_one_run(spark, tmp_path):
    w = world(3)
    one = sync(*frames(spark, w))
    rng = random.Random(1)
    rest = w[1] + w[2]
    rng.shuffle(rest)
    _, _, issues, blogs, listed, _ = frames(spark, w)
    path, folder = f"file://{tmp_path}/state", f"{tmp_path}/landed"
    S.begin(spark, path, blogs, issues, listed)
    for k, rows in enumerate((w[0] + rest[: len(rest) // 3], rest[len(rest) // 3 :])):
        df = spark.createDataFrame([(*r, DAY.format(k + 1)) for r in rows], "kind string, url string, http_status int, body string, landed_at string")
        df.withColumn("landed_at", F.col("landed_at").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"file://{folder}")
        S.follow(S.landings(spark, f"file://{folder}"), path, f"file://{tmp_path}/checkpoint", "9 days").awaitTermination()
        assert latest(spark, path).number == k + 2
    version = latest(spark, path)
    waiting = read_state(spark, version).others
    assert waiting["waiting"].count() > 0 and waiting["open"].count() == 2 and waiting["checks"].where("valid is null").count() > 0
    # the same landing again changes nothing
    assert S.merge_landing(spark.createDataFrame([], S.LANDED), path, version.note["landing"]) == version
    state = read_state(spark, S.close(spark, path))
    assert told(state) == told(one)
    assert {r.url for r in state.issues.collect()} == {r.url for r in one.issues.collect()}
    assert all(state.others[n].count() == 0 for n in ("open", "waiting")) and state.others["checks"].where("valid is null").count() == 0
    # what is known isn't probed or appended again
    S.merge_landing(spark.createDataFrame([(*r, None) for r in w[0] + w[1]], "kind string, url string, http_status int, body string, landed_at timestamp"), path, 99)
    assert told(read_state(spark, latest(spark, path))) == told(state)


def test_waits_end_with_patience(spark, tmp_path):
    path = f"file://{tmp_path}/state"
    empty = spark.createDataFrame([], BLOGS), spark.createDataFrame([], ISSUES), spark.createDataFrame([(0, "https://quiet.dev/feed")], "line_no long, url string")
    S.begin(spark, path, *empty)
    mark = f"{SITE}/blog/weekly-issue-1.html"

    def land(n, day, *rows):
        df = spark.createDataFrame([(*r, DAY.format(day)) for r in rows], "kind string, url string, http_status int, body string, landed_at string")
        return read_state(spark, S.merge_landing(df.withColumn("landed_at", F.col("landed_at").cast("timestamp")), path, n, "3 days"))

    state = land(0, 1, ("listing", "l", 200, f'<a href="{mark}">One</a><a href="{SITE}/weekly-issue-2">Two</a>'), ("issue", mark, 200, '<a href="https://a.dev">A</a><a href="https://b.dev">B</a>'))
    assert state.blogs.count() == 0 and state.others["open"].count() == 1 and state.feed_list.count() == 1
    # a feed on the second path counts when the first one is known to fail
    state = land(1, 2, ("feed", f"https://a.dev{FEED_PATHS[1]}", 200, RSS))
    assert state.blogs.count() == 0
    state = land(2, 3, ("feed", f"https://a.dev{FEED_PATHS[0]}", 404, ""))
    assert [tuple(r) for r in state.blogs.select("blog_url", "rss").collect()] == [("https://a.dev", f"https://a.dev{FEED_PATHS[1]}")]
    assert sorted(r.url for r in state.feed_list.collect()) == [f"https://a.dev{FEED_PATHS[1]}", "https://quiet.dev/feed"]
    state = land(3, 4, ("feed", "https://other.dev/feed", 200, RSS))
    assert sorted(tuple(r) for r in state.blogs.select("blog_url", "rss").collect()) == [("https://a.dev", f"https://a.dev{FEED_PATHS[1]}"), ("https://b.dev", "")]
    assert [r.url for r in state.feed_list.collect()] == [f"https://a.dev{FEED_PATHS[1]}"]
    assert state.others["open"].count() == 0 and state.others["waiting"].count() == 0
