"""Operators on small tables: ordering, fallbacks, greedy choice, discovery."""

import os
import random
import uuid

import pandas as pd
import pytest
from pyspark.sql import functions as F

from feedmill.operators import clippings as C
from feedmill.operators import discovery as D
from feedmill.operators import diversity as V
from feedmill.operators import feeds as E
from feedmill.operators import report as R
from feedmill.operators import scoring as S
from feedmill.plans.digest import digest_report
from feedmill.plans.sync import sync
from feedmill.sources import tables as T

STORY = "article_id string, title string, link string, topic string, keywords array<string>, total_score int"


def plain_walk(rows, n):
    """The definition: a walk by score, then by id; then other links."""
    rows = sorted(rows, key=lambda r: (-r[5], r[0]))
    tokens = lambda t: {w for w in "".join(c if c.isascii() and (c.isalnum() or c == "-") else " " for c in t.lower()).split() if len(w) > 2 and w not in V.STOP_WORDS}
    picked, skipped = [], 0
    for r in rows:
        if len(picked) >= n:
            break
        same = sum(p[3] == r[3] for p in picked) >= V.MAX_PER_TOPIC
        for p in picked:
            a, b = {k.lower() for k in r[4]}, {k.lower() for k in p[4]}
            x, y = tokens(r[1]), tokens(p[1])
            same = same or (p[3] != r[3] and ((a and b and len(a & b) / len(a | b) >= 0.45) or (x and y and len(x & y) / min(len(x), len(y)) >= 0.5)))
        if same:
            skipped += 1
        else:
            picked.append(r)
    for r in rows:
        if len(picked) >= n:
            break
        if r[2] not in {p[2] for p in picked}:
            picked.append(r)
    return [p[0] for p in picked], skipped


def stories(seed, n):
    rng = random.Random(seed)
    words = ["rust", "async", "kernel", "llm", "gpu", "cloud", "queue", "cache"]
    return [(f"{i:04d}", " ".join(rng.sample(words, 3)), f"u{rng.randrange(n)}", f"t{rng.randrange(n // 2)}", rng.sample(["A", "b", "c", "D", "e", "f", "g"], rng.randrange(4)), rng.randrange(12)) for i in range(n)]


@pytest.mark.parametrize("seed", range(4))
def test_diverse_choice_equals_the_walk(spark, seed):
    rows = stories(seed, 40)
    df = spark.createDataFrame(rows, STORY).repartition(3)
    want, skipped = plain_walk(rows, 9)
    for prefix in (2, 7, 100):
        top, got = V.select_diverse(df, 9, prefix)
        assert ([r.article_id for r in top.orderBy("rank").collect()], got) == (want, skipped)
    by_edition = V.select_diverse_editions(df.withColumn("edition", F.lit("x")), 9).orderBy("rank").collect()
    assert [r.article_id for r in by_edition] == want and by_edition[0].skipped == skipped


def test_topic_cap_and_backfill(spark):
    make = lambda *r: spark.createDataFrame([(f"{i}", f"title{i} word{i}", link, t, [], s) for i, (link, t, s) in enumerate(r)], STORY)
    top, skipped = V.select_diverse(make(("a", "t", 30), ("b", "t", 29), ("c", "t", 28), ("d", "u", 27)), 3)
    assert [r.article_id for r in top.orderBy("rank").collect()] == ["0", "1", "3"] and skipped == 1
    top, skipped = V.select_diverse(make(("a", "t", 30), ("b", "t", 29), ("c", "t", 28)), 3)
    assert [r.article_id for r in top.orderBy("rank").collect()] == ["0", "1", "2"] and skipped == 1
    top, _ = V.select_diverse(make(("a", "t", 30), ("b", "t", 29), ("a", "t", 28)), 3)
    assert top.count() == 2
    top, skipped = V.select_diverse(make(("a", "t", 30)).where("total_score < 0"), 3)
    assert top.count() == 0 and skipped == 0


def test_similar_pairs_plan_and_result(spark):
    rows = stories(9, 60)
    df = spark.createDataFrame(rows, STORY)
    got = sorted(map(tuple, V.similar_pairs(df).collect()))
    a, b = df.alias("a"), df.alias("b")
    pair = V.is_duplicate_pair(*[F.col(f"{x}.{c}") for x in "ab" for c in ("topic", "keywords", "title")])
    want = sorted(map(tuple, a.crossJoin(b).where(F.col("a.article_id") < F.col("b.article_id")).where(pair).select("a.article_id", "b.article_id").collect()))
    assert got == want and want
    plan = V.similar_pairs(df)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "TakeOrderedAndProject" in V.rank_articles(df).limit(5)._jdf.queryExecution().executedPlan().toString()


def test_dedupe_feeds_validates_first(spark):
    lines = spark.createDataFrame([(0, "a.com/x"), (1, "https://a.com/x"), (2, "http://A.com/X/"), (3, "https://b.com")], "line_no long, line string")
    assert [(r.line_no, r.xml_url, r.feed_key) for r in E.dedupe_feeds(lines).orderBy("line_no").collect()] == [(1, "https://a.com/x", "a.com/x"), (3, "https://b.com", "b.com")]


def test_recent_is_strict_and_open(spark):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("2024-01-28 00:00:00",), ("2024-01-28 00:00:01",), ("2024-01-31 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("pub_date"))
    assert E.recent(df, as_of, 48).count() == 2


def test_score_answers(spark):
    rows = [
        (0, '```json\n{"results":[{"index":0,"relevance":9,"quality":8,"timeliness":7,"category":"tools","keywords":["a","b","c","d","e"],"topic":"X y"},{"index":"1","relevance":9},{"index":2,"keywords":"no"}]}\n```', None),
        (1, '{"results":[{"index":3,"relevance":9},null]}', None), (2, "not json", None), (3, '{"results":[{"index":4,"topic":7,"relevance":9}]}', None),
        (4, None, "timeout"), (5, '{"results":[{"index":0,"relevance":1}]}', None), (6, '{"results":{}}', None), (7, '{"results":[{"index":5,"topic":0,"relevance":9}]} tail', None), (8, '{"results":[{"index":6,"topic":false,"relevance":9}]}', None),
    ]
    scores = S.parse_score_responses(spark.createDataFrame(rows, "batch_id long, response string, error string"))
    out = {r.idx: r for r in S.attach_scores(spark.range(7).withColumnRenamed("id", "idx"), scores).collect()}
    assert (out[0].relevance, out[0].quality, out[0].timeliness, out[0].category, out[0].keywords, out[0].topic, out[0].total_score) == (1, 5, 5, "other", [], "misc", 11)
    assert (out[2].relevance, out[2].keywords, out[2].topic) == (5, [], "misc")
    assert [out[i].total_score for i in (1, 3, 4, 5)] == [15] * 4 and out[6].relevance == 9


def test_summary_fallbacks(spark):
    base = spark.createDataFrame([(0, 0, "t0", "d" * 300), (1, 0, "t1", "d" * 300), (20, 1, "t20", "d")], "idx long, batch_id long, title string, description string")
    answers = spark.createDataFrame([(0, '{"results":[{"index":0,"titleZh":"z","summary":null}]}', None), (1, None, "boom")], "batch_id long, response string, error string")
    out = {r.idx: (r.title_zh, r.summary, r.reason) for r in S.attach_summaries(base, answers).collect()}
    assert out == {0: ("z", "", ""), 1: ("t1", "d" * 200, ""), 20: ("t20", "t20", "")}


def test_model_fallback_stays(spark):
    def first(prompt):
        if prompt == "p1":
            raise ValueError("no")
        return "first " + prompt

    prompts = spark.createDataFrame([(0, "p0"), (1, "p1"), (2, "p2")], "batch_id long, prompt string").coalesce(1)
    got = [r.response for r in S.apply_model(prompts, first, lambda p: "second " + p).orderBy("batch_id").collect()]
    assert got == ["first p0", "second p1", "second p2"]
    alone = S.apply_model(prompts, first).orderBy("batch_id").collect()
    assert [r.response for r in alone] == ["first p0", None, "first p2"] and alone[1].error == "ValueError: no"


def test_keyword_counts_and_clip_names(spark):
    df = spark.createDataFrame([("e", 1, ["A", "a", "b"]), ("e", 2, ["B"])], "edition string, rank int, keywords array<string>")
    assert {r.keyword: r.n for r in R.keyword_counts(df).collect()} == {"a": 2, "b": 2}
    assert [r.keyword for r in R.top_keywords(df, 5).orderBy("place").collect()] == ["a", "b"]
    names = spark.createDataFrame([("e", 1, "A"), ("e", 2, "A"), ("e", 3, "A-2"), ("f", 1, "A")], "edition string, rank int, title string")
    got = C.clip_names(names, F.lit("2024-01-30").cast("timestamp")).orderBy("edition", "rank").collect()
    assert [r.file_name for r in got] == ["20240130-A.md", "20240130-A-2.md", "20240130-A-2-2.md", "20240130-A.md"]


@pytest.mark.parametrize("seed", range(3))
def test_clip_names_equal_a_walk_by_rank(spark, seed):
    rng = random.Random(seed)
    titles = ["A", "A-2", "A-3", "A-2-2", "B", "B-2", None, "untitled", "untitled-2"]
    rows = [(e, k, rng.choice(titles)) for e in "efg" for k in range(25)]
    want, used = {}, set()
    for e, k, t in rows:
        base, n = f"20240130-{t or 'untitled'}", 1
        while (e, name := base if n == 1 else f"{base}-{n}") in used:
            n += 1
        used.add((e, name))
        want[e, k] = name + ".md"
    out = C.clip_names(spark.createDataFrame(rows, "edition string, rank int, title string"), F.lit("2024-01-30").cast("timestamp"))
    assert {(r.edition, r["rank"]): r.file_name for r in out.collect()} == want
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().toString()


def test_answers_that_land_are_not_asked_for_again(spark, tmp_path):
    path, log = f"file://{tmp_path}/answers", f"{tmp_path}/log"
    os.makedirs(log)

    def ask(prompt):
        with open(f"{log}/{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        if os.path.exists(f"{log}-stop") and len(os.listdir(log)) > 20:
            raise KeyboardInterrupt
        if prompt == "bad":
            raise ValueError("bad")
        return prompt.upper()

    calls = lambda: sorted(open(f"{log}/{n}").read() for n in os.listdir(log))
    prompts = spark.createDataFrame([(k, f"p{k % 30}") for k in range(40)] + [(99, "bad"), (100, None)], "batch_id long, prompt string").where("prompt is not null")
    open(f"{log}-stop", "w").close()
    with pytest.raises(Exception):  # noqa: B017 - the run is stopped in the middle
        S.land_answers(prompts, path, ask, round_size=5)
    os.remove(f"{log}-stop")
    landed = {r.response for r in spark.read.parquet(path).where("error is null").collect()}
    assert 5 <= len(landed) < 31
    asked = len(os.listdir(log))
    got = {r.batch_id: (r.response, r.error) for r in S.land_answers(prompts, path, ask, round_size=5).collect()}
    assert got == {**{k: (f"P{k % 30}", None) for k in range(40)}, 99: (None, "ValueError: bad")}
    assert len(os.listdir(log)) - asked == 31 - len(landed) and len(spark.read.parquet(path).where("error is null").collect()) == 30
    asked = len(os.listdir(log))
    assert S.land_answers(prompts, path, lambda p: "now " + p).where("batch_id = 99").first().response == "now bad" and len(os.listdir(log)) == asked
    assert S.land_answers(prompts.limit(0), f"{path}-none", ask).count() == 0 and calls().count("p0") <= 2


def test_translations(spark):
    clips = spark.createDataFrame([("x", "# A heading here\n\nSome english text\n\n```\ncode\n```\n\nMore english text"), ("y", "中文内容很多的文章")], "article_id string, markdown string")
    jobs = C.translation_jobs(clips)
    assert [(r.article_id, r.pos, r.idx) for r in jobs.orderBy("pos").collect()] == [("x", 0, 0), ("x", 1, 1), ("x", 3, 2)]
    answers = spark.createDataFrame([("x", 0, '{"translations":[{"index":0,"text":" 标题 "},{"index":1,"text":"Some english text"},{"index":9,"text":"z"}]}', None)], "article_id string, batch int, response string, error string")
    out = {r.article_id: r.markdown for r in C.apply_translations(clips, jobs, answers).collect()}
    assert out == {"x": "# A heading here\n\n标题\n\nSome english text\n\n```\ncode\n```\n\nMore english text", "y": "中文内容很多的文章"}
    assert C.translation_prompts(jobs).count() == 1


def test_anchors(spark):
    html = '<a href="/x?a=1&amp;b=2">a <b> b</b></a><a name=n>no</a><A HREF=\'y\'>c<a href=z>d</a>'
    for tolerant in (False, True):
        rows = D.extract_anchors(spark.createDataFrame([("p", html)], "url string, body string"), tolerant).collect()
        assert (rows[0].pos, rows[0].href, rows[0].text) == (0, "/x?a=1&b=2", "ab")


def state(spark):
    blogs = spark.createDataFrame([(0, "w", "u", "b", "https://old.dev", "https://old.dev/feed"), (1, "w", "u", "c", "https://vain.dev", "")], "row_no long, weekly_name string, weekly_url string, blog_name string, blog_url string, rss string")
    listed = spark.createDataFrame([(0, "https://old.dev/feed"), (1, "https://ok.dev/feed")], "line_no long, url string")
    issues = spark.createDataFrame([(1, "one", "https://www.ruanyifeng.com/weekly-issue-1.html")], "issue int, title string, url string")
    page = '<a href="https://new.dev/p/">New <i>blog</i></a><a href="https://old.dev">o</a><a href="https://vain.dev/">v</a><a href="https://github.com/x">g</a><a href="https://none.dev">n</a>'
    listing = spark.createDataFrame([("list", '<a href="/weekly-issue-1.html">one</a><a href="/weekly-issue-2.html">two</a>')], "url string, body string")
    pages = spark.createDataFrame([("https://www.ruanyifeng.com/weekly-issue-2.html", 200, page)], "url string, http_status int, body string")
    feed = "<?xml version='1.0'?><rss>"
    responses = spark.createDataFrame([("https://old.dev/feed", 404, feed), ("https://ok.dev/feed", 200, feed), ("https://new.dev/feed.xml", 200, feed), ("https://new.dev/rss", 200, feed)], "url string, http_status int, body string")
    return listing, pages, issues, blogs, listed, responses


def test_sync_and_its_second_run(spark):
    listing, pages, issues, blogs, listed, responses = state(spark)
    got = sync(listing, pages, issues, blogs, listed, responses)
    rows = [(r.blog_url, r.blog_name, r.rss) for r in got.blogs.orderBy("row_no").collect()]
    assert rows == [("https://old.dev", "b", ""), ("https://vain.dev", "c", ""), ("https://new.dev/p", "Newblog", "https://new.dev/rss"), ("https://none.dev", "n", "")]
    assert [r.url for r in got.feed_list.orderBy("line_no").collect()] == ["https://ok.dev/feed", "https://new.dev/rss"]
    stats = got.stats.first()
    assert (stats.known_issues, stats.new_issues, stats.new_blogs, stats.removed_feeds, stats.feeds) == (1, 1, 2, 1, 2)
    again = sync(listing, pages, got.issues, got.blogs, got.feed_list, responses)
    assert again.blogs.count() == 4 and again.feed_list.count() == 2 and again.stats.first().new_blogs == 0


def test_files_round_trip(spark, tmp_path):
    _, _, issues, blogs, listed, _ = state(spark)
    odd = blogs.withColumn("blog_name", F.lit('a "q"\nb, c'))
    T.write_blogs_csv(odd, f"{tmp_path}/blogs")
    back = T.read_blogs_csv(spark, f"{tmp_path}/blogs")
    assert sorted(map(str, back.drop("row_no").collect())) == sorted(map(str, odd.drop("row_no").collect()))
    (tmp_path / "bom.csv").write_text("﻿" + ",".join(T.BLOG_HEADERS) + "\n x ,/u/,,https://b/,\n", encoding="utf-8")
    row = T.read_blogs_csv(spark, f"{tmp_path}/bom.csv").first()
    assert (row.weekly_name, row.weekly_url, row.blog_name, row.blog_url, row.rss) == ("x", "https://www.ruanyifeng.com/u", "", "https://b", "")
    T.write_issues(issues, f"{tmp_path}/issues")
    assert T.read_issues(spark, f"{tmp_path}/issues").collect() == issues.collect()
    (tmp_path / "i.json").write_text('[{"title":"a","url":"/x/"},{"url":"y"}]')
    assert [tuple(r) for r in T.read_issues(spark, f"{tmp_path}/i.json").orderBy("issue").collect()] == [(1, "a", "https://www.ruanyifeng.com/x"), (2, "", "y")]
    (tmp_path / "rss.txt").write_bytes(b"# c\r\n\r\n https://a \r\nhttps://b")
    assert [tuple(r) for r in T.read_feed_list(spark, f"{tmp_path}/rss.txt").collect()] == [(2, "https://a"), (3, "https://b")]
    T.write_feed_list(listed, f"{tmp_path}/list")
    assert [r.line for r in T.read_feed_list(spark, f"{tmp_path}/list/part-*").collect()] == ["https://old.dev/feed", "https://ok.dev/feed"]
    clips = spark.createDataFrame([("e", "a.md", "x"), ("f", "b.md", "y")], "edition string, file_name string, markdown string")
    assert T.write_clippings(clips, f"{tmp_path}/clips") == 2
    T.write_report(spark.createDataFrame([("e", "# r\nx")], "edition string, report string"), f"{tmp_path}/report")
    assert spark.read.text(f"{tmp_path}/report", wholetext=True).first().value.strip() == "# r\nx"
    landed = spark.createDataFrame([("u", s, "t", "b", None) for s in (200, 204, 404)], "url string, http_status int, content_type string, body string, fetched_at timestamp")
    landed.write.parquet(f"{tmp_path}/landed")
    assert T.read_responses(spark, f"{tmp_path}/landed").count() == 2 and T.read_responses(spark, f"{tmp_path}/landed", exact=True).count() == 1


def test_digest_from_landed_tables(spark):
    lines = spark.createDataFrame([(0, "https://www.a.dev/feed"), (1, "https://b.dev/atom.xml")], "line_no long, line string")
    rss = "<rss><item><title>Rust &amp; async</title><link>u1</link><pubDate>Mon, 29 Jan 2024 10:00:00 GMT</pubDate><description>d1</description></item><item><title>Old</title><link>u2</link><pubDate>x</pubDate></item></rss>"
    atom = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Kernel news</title><link href="u3"/><updated>2024-01-29T12:00:00Z</updated></entry></feed>'
    responses = spark.createDataFrame([("https://www.a.dev/feed", 200, rss), ("https://b.dev/atom.xml", 200, atom)], "url string, http_status int, body string")
    answers = spark.createDataFrame([(0, '{"results":[{"index":1,"relevance":9,"quality":9,"timeliness":9,"category":"tools","keywords":["K"],"topic":"kernel"}]}', None)], "batch_id long, response string, error string")
    none = spark.createDataFrame([], "batch_id long, response string, error string")
    out = digest_report(lines, responses, answers, none, "Do it.", F.lit("2024-01-30 00:00:00").cast("timestamp")).first().report
    assert "| 2/2 | 3 篇 → 2 篇 | 48h | **2 篇** |" in out and out.index("Kernel news") < out.index("Rust & async") and "⭐ 27/30" in out and "🥇 **Kernel news**" in out and "Do it." in out


def test_editions_in_rounds(spark):
    rows = {e: stories(seed, 40) for e, seed in (("x", 5), ("y", 6), ("z", 7))}
    rows["w"] = stories(8, 3)
    df = spark.createDataFrame([(e, *r) for e, rs in rows.items() for r in rs], "edition string, " + STORY).repartition(3)
    want = {e: plain_walk(rs, 9) for e, rs in rows.items()}
    for prefix in (12, 200):
        got = V.select_diverse_editions(df, 9, prefix).orderBy("edition", "rank").collect()
        for e, (ids, skipped) in want.items():
            mine = [r for r in got if r.edition == e]
            assert [r.article_id for r in mine] == ids and [r.rank for r in mine] == list(range(1, len(ids) + 1)) and {r.skipped for r in mine} == {skipped}
