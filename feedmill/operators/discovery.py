"""Growing the feed catalogue from crawled pages: links, blogs, probes, validation and the merged feed list.

Tables: pages (url, title, issue, body), blogs (row_no, weekly_name, weekly_url, blog_name, blog_url, rss),
responses (url, http_status, body), feed lists (line_no, url). Every table carries its order in a column.
Bodies are reduced to a flag before any join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedmill.functions import urls as U
from feedmill.functions.markup import ENTITIES, decode_numeric_entities, is_valid_feed, looks_like_feed_head
from feedmill.functions.text import SPACE, filled, let, strip

#: What is no text, with the end of the page in place of a missing end; and a tag, which may hold > in quotes.
_NO_TEXT = r"(?is)<!--.*?(?:-->|\z)|<(script|style)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\z)"
_TAG = r"""<[/!?]?[a-zA-Z!][^<>"']*(?:"[^"]*"[^<>"']*|'[^']*'[^<>"']*)*>"""
#: Elements without an end tag.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")


def _anchor_spans(tags: Column) -> Column:
    """(first, last) of each <a> among an array of tags, in their order: where it begins and where it is closed.

    A fold over the tags with the open elements as a stack: an end tag closes the last open element of its name and
    all that were opened in it, and one without such an element nothing. What is open at the end of the page is closed there.
    """
    name = lambda t: F.lower(F.regexp_extract(t, r"^</?([a-zA-Z][^\s/>]*)", 1))
    empty = lambda t: F.endswith(t, F.lit("/>")) & ~t.rlike(r"""=\s*[^\s"'>]+/>\z""")  # noqa: E731 - a slash may end a value
    read = F.transform(tags, lambda t, k: F.struct(name(t).alias("name"), k.alias("at"), F.startswith(t, F.lit("</")).alias("shut"), (empty(t) | name(t).isin(*_VOID)).alias("single")))
    span = lambda first, last: F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"))
    state = lambda names, ats, spans: F.struct(names.alias("names"), ats.alias("ats"), spans.alias("spans"))

    def closed(s: Column, kept: Column, at: Column) -> Column:
        """The spans, and those of the open anchors after the first kept elements, which end at a tag."""
        shut = F.filter(F.arrays_zip(s["names"], s["ats"]), lambda x, k: (k >= kept) & (x["names"] == "a"))
        return F.concat(s["spans"], F.transform(shut, lambda x: span(x["ats"], at)))

    def step(s: Column, t: Column) -> Column:
        def end(back: Column) -> Column:
            kept = F.size(s["names"]) - back.cast("int")
            return F.when(back == 0, s).otherwise(state(F.slice(s["names"], F.lit(1), kept), F.slice(s["ats"], F.lit(1), kept), closed(s, kept, t["at"])))

        begin = state(F.concat(s["names"], F.array(t["name"])), F.concat(s["ats"], F.array(t["at"])), s["spans"])
        alone = F.when(t["name"] == "a", state(s["names"], s["ats"], F.concat(s["spans"], F.array(span(t["at"], t["at"]))))).otherwise(s)
        return F.when(t["name"] == "", s).when(t["shut"], let(F.array_position(F.reverse(s["names"]), t["name"]), end)).when(t["single"], alone).otherwise(begin)

    start = state(F.array().cast("array<string>"), F.array().cast("array<int>"), F.array().cast("array<struct<first: int, last: int>>"))
    return F.array_sort(F.aggregate(read, start, step, lambda s: closed(s, F.lit(0), F.size(read))))


def parsed_anchors(html: Column | str) -> Column:
    """Array of the anchors with an href (pos, href, text) of tag soup: unclosed, nested and crossing elements.

    Text is every piece between tags stripped and joined without a space; scripts, styles and comments have none.
    """
    clean = F.regexp_replace(filled(html), _NO_TEXT, "<!>")
    tags, pieces = F.regexp_extract_all(clean, F.lit(f"({_TAG})"), F.lit(1)), F.transform(F.split(clean, _TAG, -1), lambda t: strip(_decoded(decode_numeric_entities(t))))

    def anchors(page: Column) -> Column:
        href = lambda s: _href(F.get(page["tags"], s["first"]))
        text = lambda s: F.array_join(F.slice(page["pieces"], s["first"] + 2, s["last"] - s["first"]), "")
        found = F.filter(F.transform(_anchor_spans(page["tags"]), lambda s: F.struct(s.alias("s"), href(s).alias("href"))), lambda x: x["href"].isNotNull())
        return F.transform(found, lambda x, k: F.struct(k.alias("pos"), x["href"].alias("href"), text(x["s"]).alias("text")))

    return let(F.struct(tags.alias("tags"), pieces.alias("pieces")), anchors)


def _href(tag: Column) -> Column:
    """The href of a tag, null without one."""
    value = F.regexp_extract(tag, r"""(?is)\shref(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?(?=[\s/>"'])""", 1)
    plain = F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.when(tag.rlike(r"""(?is)\shref(?=[\s=/>])"""), _decoded(decode_numeric_entities(plain)))


def _decoded(text):
    for entity, char in (*ENTITIES[1:], ("&apos;", "'"), ENTITIES[0]):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def extract_anchors(pages: DataFrame, tolerant: bool = False) -> DataFrame:
    """The columns of pages but body, and pos, href and text of every anchor with an href, in page order.

    Text is every piece between tags stripped and joined without a space. tolerant keeps the open elements of a page in
    mind, so it repairs tag soup; by default a pattern finds anchors with a closing tag.
    """
    kept = [c for c in pages.columns if c != "body"]
    if tolerant:
        return pages.select(*kept, F.explode(parsed_anchors("body")).alias("a")).select(*kept, "a.pos", "a.href", "a.text")
    whole = F.regexp_extract_all("body", F.lit(r"(?is)(<a\s(?:[^>]*\s)?href\s*=[^>]*>.*?</a\s*>)"), F.lit(1))
    rows = pages.select(*kept, F.posexplode(whole).alias("pos", "raw"))
    href = F.coalesce(*[F.nullif(F.regexp_extract("raw", rf"(?is)^<a\s(?:[^>]*\s)?href\s*=\s*{form}", 1), F.lit("")) for form in (r'"([^"]*)"', r"'([^']*)'", r"([^\s>\"']+)")], F.lit(""))
    pieces = F.transform(F.split(F.regexp_replace("raw", r"(?is)<!--.*?-->", "<>"), r"<[^>]*>"), lambda t: F.regexp_replace(_decoded(decode_numeric_entities(t)), f"^{SPACE}+|{SPACE}+$", ""))
    return rows.select(*kept, "pos", _decoded(decode_numeric_entities(href)).alias("href"), F.array_join(pieces, "").alias("text"))


def list_issues(pages: DataFrame, tolerant: bool = False) -> DataFrame:
    """(url of the page, issue, title, issue_url): the issues that each listing page links, numbered from 1 in its order."""
    links = extract_anchors(pages.select("url", "body"), tolerant).withColumn("issue_url", U.normalize_url("href")).where(U.is_issue_link("issue_url"))
    first = links.groupBy("url", "issue_url").agg(F.min(F.struct("pos", "text")).alias("f"))
    number = F.row_number().over(Window.partitionBy("url").orderBy("f.pos"))
    return first.select("url", number.alias("issue"), F.col("f.text").alias("title"), "issue_url")


def new_issues(fetched: DataFrame, known: DataFrame) -> DataFrame:
    """Fetched issues whose normalized URL no known issue has."""
    seen = known.select(U.normalize_url("url").alias("_url")).distinct()
    return fetched.withColumn("_url", U.normalize_url("url")).join(seen, "_url", "left_anti").drop("_url")


def known_blogs(blogs: DataFrame) -> DataFrame:
    """(blog_url, rss): the first rss of each blog that isn't empty, else empty, which means probed in vain."""
    first = F.min(F.when(F.col("rss") != "", F.struct("row_no", "rss")))
    return blogs.where("blog_url <> ''").groupBy("blog_url").agg(first.alias("f")).select("blog_url", F.coalesce("f.rss", F.lit("")).alias("rss"))


def extract_blogs(issue_pages: DataFrame, known: DataFrame, tolerant: bool = False) -> DataFrame:
    """New personal blogs that issues (issue, title, url, body) link, the first link of each in order of issue and place.

    Returns issue, pos and the columns of blogs but row_no, with an empty rss. Names are the first 100
    characters of the link's text, or the domain.
    """
    links = extract_anchors(issue_pages.select("issue", "title", "url", "body"), tolerant).withColumn("blog_url", U.normalize_url("href")).where(U.is_external_link("blog_url"))
    links = links.withColumn("domain", U.url_domain("blog_url")).where(U.is_personal_blog("domain"))
    first = links.groupBy("blog_url").agg(F.min(F.struct("issue", "pos", "title", "url", "text", "domain")).alias("f"))
    fresh = first.join(known.select("blog_url").distinct(), "blog_url", "left_anti")
    return fresh.select("f.issue", "f.pos", F.col("f.title").alias("weekly_name"), F.col("f.url").alias("weekly_url"), F.when(F.col("f.text") != "", F.substring("f.text", 1, 100)).otherwise(F.col("f.domain")).alias("blog_name"), "blog_url", F.lit("").alias("rss"))


def blogs_to_probe(new: DataFrame, known: DataFrame) -> DataFrame:
    """Blogs never probed, not even in vain."""
    return new.join(known.select("blog_url").distinct(), "blog_url", "left_anti").select(*new.columns)


def first_working_feed(blogs: DataFrame, responses: DataFrame) -> DataFrame:
    """blogs with rss: the first of their candidate URLs whose response looks like a feed, else empty."""
    good = responses.where((F.col("http_status") == 200) & looks_like_feed_head("body")).select(F.col("url").alias("candidate")).distinct()
    tries = blogs.select("blog_url").distinct().select("blog_url", F.posexplode(U.candidate_feed_urls("blog_url")).alias("path_pos", "candidate"))
    best = tries.join(good, "candidate").groupBy("blog_url").agg(F.min_by("candidate", "path_pos").alias("_found"))
    rest = [c for c in blogs.columns if c != "rss"]
    return blogs.join(best, "blog_url", "left").select(*rest, F.coalesce("_found", F.lit("")).alias("rss"))


def append_blogs(blogs: DataFrame, new: DataFrame, edition: str | None = None) -> DataFrame:
    """blogs and after them the new ones by (issue, pos), also those without a feed."""
    last = blogs.agg(F.coalesce(F.max("row_no"), F.lit(-1))).first()[0]
    # issue and pos in one number: row numbers only have to ascend
    row_no = F.lit(last + 1) + F.col("issue").cast("long") * F.lit(1 << 32) + F.col("pos")
    return blogs.unionByName(new.select(row_no.alias("row_no"), *[c for c in blogs.columns if c != "row_no"]))


def validated(urls: DataFrame, responses: DataFrame) -> DataFrame:
    """urls with valid: whether the URL's response is a feed; without a response it isn't."""
    flags = responses.select("url", is_valid_feed("http_status", "body").alias("v")).groupBy("url").agg(F.max("v").alias("v"))
    return urls.join(flags, "url", "left").select(*urls.columns, F.coalesce("v", F.lit(False)).alias("valid"))


def split_valid(urls: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The valid and the invalid rows of urls."""
    flagged = validated(urls, responses)
    return flagged.where("valid").drop("valid"), flagged.where("not valid").drop("valid")


def purge_invalid_rss(blogs: DataFrame, invalid: DataFrame) -> DataFrame:
    """blogs with an empty rss where it is one of the invalid URLs, and purged, which says where that was."""
    bad = invalid.select(F.col("url").alias("rss")).distinct().withColumn("_bad", F.lit(True))
    hit = F.coalesce(F.col("_bad"), F.lit(False))
    out = blogs.join(bad, "rss", "left")
    return out.select(*[F.when(hit, "").otherwise(F.col(c)).alias(c) if c == "rss" else F.col(c) for c in blogs.columns], hit.alias("purged"))


def prune_feed_list(listed: DataFrame, blogs: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listed feeds that are valid, and blogs without those that aren't."""
    valid, invalid = split_valid(listed, responses)
    return valid, purge_invalid_rss(blogs, invalid).drop("purged")


def merge_feed_list(listed: DataFrame, blogs: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The listed feeds and after them the valid new ones of blogs in row order; and blogs without invalid new ones."""
    rows = blogs.select(strip("rss").alias("url"), "row_no").where("url <> ''").groupBy("url").agg(F.min("row_no").alias("row_no"))
    new = rows.join(listed.select("url").distinct(), "url", "left_anti")
    valid, invalid = split_valid(new, responses)
    last = listed.agg(F.coalesce(F.max("line_no"), F.lit(-1))).first()[0]
    merged = listed.select("line_no", "url").unionByName(valid.select((F.col("row_no") + last + 1).alias("line_no"), "url"))
    return merged, purge_invalid_rss(blogs, invalid).drop("purged")


def sync_stats(known_issues: DataFrame, found_issues: DataFrame, blogs_before: DataFrame, blogs_after: DataFrame, listed_before: DataFrame, listed_after: DataFrame) -> DataFrame:
    """One row of counts of a sync run."""
    one = F.lit(1).alias("one")
    removed = listed_before.join(listed_after.select("url").distinct(), "url", "left_anti")
    parts = [
        known_issues.agg(F.count("*").alias("known_issues")), found_issues.agg(F.count("*").alias("new_issues")),
        blogs_before.agg(F.count("*").alias("blogs_before"), F.count_if(F.col("rss") != "").alias("with_rss_before")),
        blogs_after.agg(F.count("*").alias("blogs"), F.count_if(F.col("rss") != "").alias("with_rss")),
        removed.agg(F.count("*").alias("removed_feeds")), listed_after.agg(F.count("*").alias("feeds")),
    ]
    out = parts[0].select(one, "*")
    for p in parts[1:]:
        out = out.join(p.select(one, "*"), "one")
    return out.drop("one").withColumn("new_blogs", F.col("blogs") - F.col("blogs_before"))
