"""Hand-derived cases of the column functions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from feedmill.functions import markup as M
from feedmill.functions import urls as U
from feedmill.operators import clippings as C
from feedmill.operators import diversity as V
from feedmill.operators import report as R
from feedmill.operators import scoring as S


def check(spark, function, cases):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
    got = [r.y for r in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]
    assert got == [y for _, y in cases]


def test_feed_key(spark):
    check(spark, U.feed_key, [(" HTTPS://A.com/Feed// ", "a.com/feed"), ("a.com", "a.com"), ("http:///", ""), ("﻿http://x/ ", "x")])


def test_feed_source(spark):
    pair = lambda c: F.concat_ws(" ", U.feed_source(c)["name"], U.feed_source(c)["html_url"])
    check(spark, pair, [
        ("https://www.a.com/blog/feeds/posts/default", "a.com/blog https://www.a.com/blog"), ("https://a.com/posts/index.xml", "a.com https://a.com"),
        ("HTTP://u:p@A.com:80//x//y.RSS?q=1#z", "a.com/x http://a.com/x"), ("https://a.com:8443/rss/feed/", "a.com https://a.com:8443"), ("a.com/x", ""), ("https:///x", ""), ("https://a_b.中.com/a|b", "a_b.中.com/a|b https://a_b.中.com/a|b"),
    ])


def test_normalize_url(spark):
    check(spark, U.normalize_url, [("/a/", "https://www.ruanyifeng.com/a"), ("//h.com/x/", "https://h.com/x"), (None, ""), (" http://A/ ", "http://A"), ("x/y//", "x/y")])


def test_is_personal_blog(spark):
    check(spark, U.is_personal_blog, [("craft.com", False), ("blog.foo.dev", True), ("blog.foo.com", False), ("foo.com", True), ("x.edu", False), ("MyCompany.io", False), ("a.b.notion.site", True), ("www.github.com", False), ("githubXcom", True)])


def test_strip_html(spark):
    check(spark, M.strip_html, [("<b>x</b> &amp;lt;i&amp;gt;", "x <i>"), ("&lt;p&gt;hi", "<p>hi"), ("a&#8217;b", "a’b"), ("&#38;#60;", "&#60;"), (" &nbsp;x&quot;&#39; ", "x\"'"), (None, ""), ("&#55357;&#99999999999999999999999999999999999999999;&#65601;", "��A")])


def test_tags(spark):
    title = lambda c: M.tag_text(c, "title")
    check(spark, title, [("<title></title><title>x</title>", ""), ("<title>a<![CDATA[b]]>c</title>", "b"), ("<TITLE lang='x'> a\nb </Title>", "a\nb"), ("none", "")])
    check(spark, M.atom_link, [('<link rel="self" href="u1"/><link href="u2" rel="alternate"/>', "u1"), ('<link rel="self" href="u1"/><link rel="alternate" href="u2"/>', "u2"), ("<link/>", "")])
    check(spark, M.rss_link, [("<link>http://a/?x=1&amp;y=2</link>", "http://a/?x=1&amp;y=2"), ("<link></link><guid>g</guid>", "g")])
    check(spark, M.feed_format, [("<feed>", "rss"), ("<feed xmlns='x'>", "atom"), ('<feed\nxmlns="http://www.w3.org/2005/Atom">', "atom"), ("<rss>", "rss")])


def test_dates(spark):
    day = dt.datetime(2024, 1, 2, 3, 4, 5)
    check(spark, M.parse_feed_date, [
        ("garbage", dt.datetime(1970, 1, 1)), (None, dt.datetime(1970, 1, 1)), ("Tue, 02 Jan 2024 03:04:05 GMT", day), ("2 Jan 2024 03:04:05 +0000", day),
        ("Mon, 1 Jan 2024 23:04:05 EDT", day), ("2024-01-02T03:04:05Z", day), ("2024-01-02", dt.datetime(2024, 1, 2)), ("Tuesday, 2 January 2024 03:04 UT", dt.datetime(2024, 1, 2, 3, 4)), ("2024-01-02T11:04:05+08:00", day),
    ])


def test_dates_in_other_shapes(spark):
    day, noon = dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 9, 2, 12, 4)
    check(spark, M.parse_feed_date, [
        ("02-Jan-24 03:04:05", day), ("Sept 2, 2024 12:04 PM", noon), ("2 Sep. 2024 12:04", noon), ("9/2/24 12:04pm", noon), ("1/1/2024 7:04:05 p.m. PST", day), ("Tue Jan 02 2024 11:04:05 GMT+0800 (China Standard Time)", day),
        ("Tue Jan  2 03:04:05 UTC 2024", day), ("2024/1/2 03:04:05", day), ("2024.01.02 03:04:05 Z", day), ("2024-01-02 08:34:05 +0530", day), ("Tue, 2 Jan 24 03:04:05 A", day), ("Tue, 2 Jan 24 03:04:05 j", dt.datetime(1970, 1, 1)),
        ("03:04:05 2 Jan 2024", day), ("2024 January 2nd 03:04:05 -0000", day), ("2 Jan 68", dt.datetime(1968, 1, 2)), ("2 Jan 49", dt.datetime(2049, 1, 2)), ("Jan 2024", dt.datetime(2024, 1, 1)), ("12:30 am 2 Jan 2024", dt.datetime(2024, 1, 2, 0, 30)),
        ("2024-01-02T03:04:05.678Z", dt.datetime(2024, 1, 2, 3, 4, 5, 678000)), ("2 Jan 2024 03:04:05,5", dt.datetime(2024, 1, 2, 3, 4, 5, 500000)),
        *[(t, dt.datetime(1970, 1, 1)) for t in ("31 Feb 2024", "2 Jan 2024 25:00", "2 Jan 2024 03:60", "2 Jan 2024 03:04 +9900", "2 Jan 2024 03:04 CET", "2 Jan", "2024", "12:30", "13/13/2024", "|", "(2 Jan 2024)", "99999999999-01-01 00:00")],
    ])


def test_the_start_of_a_text_equals_that_of_the_whole(spark):
    rng = random.Random(4)
    bits = ["word ", "<b>", "</b>", "<a href='x", "'>", "&amp;", "&am", "p;", "lt;", "&#6", "5;", "&#", "1234567890" * 8, ";", " " * 70, "&nbsp;", "<", ">", "é語 "]
    rows = [("".join(rng.choice(bits) for _ in range(rng.randrange(200))),) for _ in range(600)] + [("&#" + "1" * 3000 + ";tail",), (" " * 3000 + "x",), ("x" * 120 + " " * 3000,), ("x " * 2000,), (None,)]
    df = spark.createDataFrame(rows, "t string").repartition(4)
    assert df.where(~F.substring(M.strip_html("t"), 1, 100).eqNullSafe(M.html_start("t", 100, 150)) | ~F.substring(M.strip_html("t"), 1, 20).eqNullSafe(M.html_start("t", 20, 90))).count() == 0
    assert df.where(F.length("t") > 150).count() > 300


def test_surrogates_side_by_side_are_one_character(spark):
    check(spark, M.decode_numeric_entities, [
        ("a&#55357;&#56832;b", "a\U0001f600b"), ("&#55357;x&#56832;", "\ufffdx\ufffd"), ("&#56832;&#55357;", "\ufffd\ufffd"), ("&#55357;&#55357;&#56832;&#56832;", "\ufffd\U0001f600\ufffd"), ("&#65;&#8217;", "A\u2019"),
        ("&#55357;&#56832;&#55357;&#56833;", "\U0001f600\U0001f601"),
    ])


def test_feed_checks(spark):
    valid = lambda c: M.is_valid_feed(F.lit(200), c)
    check(spark, valid, [("<rdf:RDF>", True), ("x <rss>", False), (" \n<RSS>", True), ("<html><?xml <feed", True), ("<html>", False), ("", False), (None, False)])
    check(spark, M.looks_like_feed_head, [("<?XML", True), ("x" * 500 + "<rss", False), (None, False)])


def test_scores(spark):
    value = lambda c: S.coerce_score(F.try_variant_get(F.try_parse_json(c), "$.v", "variant"))
    check(spark, value, [('{"v":11}', 10), ('{"v":0}', 1), ('{"v":2.5}', 3), ('{"v":"8"}', 8), ('{"v":null}', 1), ("{}", 5), ('{"v":"x"}', 5), ('{"v":-3.5}', 1), ('{"v":1e300}', 10)])
    check(spark, lambda c: S.coerce_category(c), [("ML", "other"), ("tools", "tools"), (None, "other")])
    check(spark, lambda c: S.topic_slug(c), [("  GPT-5 Release! ", "gpt-5-release"), ("大模型", "misc"), (None, "misc"), ("", "misc")])
    check(spark, S.strip_code_fence, [("```json\n{}\n```", "{}"), ("```\n1", "1"), (" {} ", "{}")])


def test_similarity(spark):
    row = spark.range(1)
    words = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")
    one = lambda c: row.select(c.alias("x")).first().x
    assert one(V.keyword_jaccard(words("Rust", "LLM"), words("rust", "db"))) == pytest.approx(1 / 3)
    assert one(V.keyword_jaccard(words(), words("a"))) == 0
    assert sorted(one(V.title_tokens(F.lit("How the GPT-5 API is new")))) == ["api", "gpt-5"]
    assert one(V.title_overlap(F.lit("Rust async guide"), F.lit("Rust async runtime internals"))) == pytest.approx(2 / 3)
    same = (F.lit("t"), words("a"), F.lit("Rust guide"))
    assert not one(V.is_duplicate_pair(*same, *same)) and one(V.is_duplicate_pair(F.lit("u"), *same[1:], *same))


def test_relative_age(spark):
    as_of = F.lit("2024-01-30 00:00:00").cast("timestamp")
    age = lambda c: R.relative_age(c.cast("timestamp"), as_of)
    check(spark, age, [("2024-01-29 23:01:00", "59 分钟前"), ("2024-01-29 00:01:00", "23 小时前"), ("2024-01-24 00:00:00", "6 天前"), ("2024-01-23 00:00:00", "2024-01-23"), ("2024-01-30 00:01:30", "-2 分钟前")])


def test_clipping_text(spark):
    check(spark, C.safe_title, [("a/b:  c?", "ab c"), ("???", "untitled"), (None, "untitled"), ("x" * 130, "x" * 120)])
    check(spark, C.is_chinese, [("abcd中", True), ("abcde中", False), ("", False)])
    check(spark, C.should_translate, [("# short", False), ("long enough text", True), ("![image alt](http://u)", False), ("https://example.com/x", False), ("1234567890", False), ("这是一个中文句子 word", False)])
    kinds = lambda c: F.array_join(F.transform(C.parse_blocks(c), lambda b: F.concat(b["type"], F.size(F.split(b["content"], "\n")).cast("string"))), " ")
    check(spark, kinds, [("p1\n\n```py\nx\n\ny\n```\np2", "text1 code5 text1"), ("```\nx", "code2"), ("a\nb\n \nc", "text2 text1"), (None, "")])


def test_report_preview(spark):
    text = "# t\n\n| a |\nkeep\n```mermaid\npie\n```\n<details>\nx\n</details>\nend\n## 📊 数据概览\ngone"
    check(spark, R.report_preview, [(text, "# t\n\nkeep\nend\n"), ("中" * 2000, "中" * 1166)])


def test_page_markdown(spark):
    html = "<html><head><title>no</title></head><body><nav>menu</nav><article><h2>Head</h2><p>Some <b>bold</b> and <a href='u'>link</a> text.</p><ul><li>one</li><li>two</li></ul><pre>code\n  here</pre><script>x()</script><p>" + "word " * 30 + "</p></article></body></html>"
    df = spark.createDataFrame([("u", 200, "text/html", html), ("u", 404, "text/html", html), ("a.md", 200, "x", " " + "m" * 120), ("b.md", 200, "x", "short"), ("u", 200, None, "<p>short</p>")], "url string, http_status int, content_type string, body string")
    out = [r.m for r in df.select(C.response_markdown().alias("m")).collect()]
    assert out[0].startswith("## Head\n\nSome **bold** and [link](u) text.") and "- one\n- two" in out[0] and "```\ncode" in out[0] and "menu" not in out[0] and "x()" not in out[0]
    assert out[1:] == [None, "m" * 120, None, None]
