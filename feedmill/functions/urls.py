"""URLs, feed names and the tests that discovery applies to links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import as_column, filled, first_group, strip

#: Scheme, authority and path of an absolute URL.
_PARTS = r"(?is)^([a-z][a-z0-9+.-]*)://([^/?#]*)([^?#]*)"
SITE = "https://www.ruanyifeng.com"
SITE_DOMAIN = "ruanyifeng.com"

#: Last path segments that name a feed, and those before them that name a collection.
_FEED_SEGMENTS = r"(?i)(?:/+(?:feed|rss|atom|default|[^/]*\.xml|[^/]*\.rss|[^/]*\.atom))+/*\z"
_LIST_SEGMENTS = r"(?i)(?:/+(?:feeds|posts))+/*\z"

#: A domain that contains one of these is not a personal blog.
EXCLUDED_DOMAINS = (
    "github.com", "youtube.com", "weibo.com", "zhihu.com", "juejin.cn", "segmentfault.com", "csdn.net", "blog.csdn.net",
    "aliyun.com", "tencent.com", "baidu.com", "douban.com", "wikipedia.org", "w3.org", "ietf.org", "stackoverflow.com",
    "medium.com", "dev.to", "npmjs.com", "pypi.org", "docker.com", "microsoft.com", "google.com", "apple.com", "amazon.com",
    "163.com", "sina.com.cn", "qq.com", "sohu.com", "ifeng.com", "36kr.com", "pingwest.com", "techcrunch.com", "wired.com",
    "theverge.com", "arstechnica.com", "engadget.com", "reddit.com", "hackernews.com", "news.ycombinator.com",
    "nature.com", "sciencemag.org", "ieee.org", "acm.org", "arxiv.org", "slideshare.net", "speakerdeck.com",
    "loom.com", "vimeo.com", "dailymotion.com", "cloudflare.com", "vercel.com", "netlify.com", "heroku.com",
    "digitalocean.com", "aws.amazon.com", "azure.microsoft.com", "notion.so", "airtable.com", "figma.com", "sketch.com",
    "canva.com", "unsplash.com", "pexels.com", "chrome.google.com", "addons.mozilla.org", "archive.org",
    "cnbc.com", "bloomberg.com", "reuters.com", "wsj.com", "ft.com", "nytimes.com", "bbc.com", "theguardian.com",
    "twitter.com", "linkedin.com", "facebook.com", "instagram.com", "xcancel.com", "archive.ph", "creativecommons.org",
    "openai.com", "labex.io",
)
#: Endings that personal sites use.
PERSONAL_SUFFIXES = (".io", ".me", ".dev", ".tech", ".app", ".site", ".space", ".blog", ".cc", ".online")
#: Paths at which sites keep their feed, in order.
FEED_PATHS = ("/feed", "/rss", "/rss.xml", "/atom.xml", "/feed.xml", "/blog/feed", "/index.xml")
#: Marks of an issue's URL, the second as often misspelt.
ISSUE_MARKS = ("weekly-issue-", "weely-issue-")


def quoted(words: tuple[str, ...]) -> str:
    """An alternation of literal strings."""
    return "|".join(w.replace(".", r"\.") for w in words)


def feed_key(url: Column | str) -> Column:
    """What two spellings of one feed's URL share: no scheme, no trailing slashes, lower case."""
    bare = F.regexp_replace(strip(url), r"(?i)^https?://", "")
    return F.lower(F.regexp_replace(bare, r"/+\z", ""))


def feed_source(url: Column | str) -> Column:
    """Struct of name and html_url of the site behind a feed's URL; null if it isn't an absolute URL.

    name is the host without a leading www. and the path without the segments that name the feed;
    html_url is the origin, with a port other than the scheme's own, and that path.
    """
    url = strip(url)
    scheme = F.lower(first_group(url, _PARTS, 1))
    authority = F.lower(F.regexp_replace(first_group(url, _PARTS, 2), r"^.*@", ""))
    host = F.regexp_replace(authority, r":[0-9]*\z", "")
    port = first_group(authority, r":([0-9]+)\z", 1)
    port = F.when((port == "") | ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")), "").otherwise(F.concat(F.lit(":"), port))
    path = F.regexp_replace(F.regexp_replace(first_group(url, _PARTS, 3), _FEED_SEGMENTS, ""), _LIST_SEGMENTS, "")
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"/\z", "")
    made = F.struct(F.concat(F.regexp_replace(host, r"^www\.", ""), path).alias("name"), F.concat(scheme, F.lit("://"), host, port, path).alias("html_url"))
    return F.when(host != "", made)


def normalize_url(url: Column | str, site: str = SITE) -> Column:
    """Strip, make site-relative URLs absolute, drop trailing slashes; null is empty."""
    bare = strip(filled(url))
    scheme = site.split("://")[0]
    whole = F.when(bare.startswith("//"), F.concat(F.lit(f"{scheme}:"), bare)).when(bare.startswith("/"), F.concat(F.lit(site), bare)).otherwise(bare)
    return F.regexp_replace(whole, r"/+\z", "")


def url_domain(url: Column | str) -> Column:
    """Authority of a URL in lower case, with port and user."""
    return F.lower(first_group(url, r"^[^:/?#]+://([^/?#]*)"))


def is_personal_blog(domain: Column | str) -> Column:
    """Whether a domain may belong to one person. Excluded names count anywhere in the domain."""
    d = F.lower(as_column(domain))
    suffix = F.lit(False)
    for s in PERSONAL_SUFFIXES:
        suffix = suffix | d.endswith(s)
    return (
        F.when(d.rlike(quoted(EXCLUDED_DOMAINS)) | d.endswith(".gov") | d.endswith(".edu") | d.contains("company") | d.contains("inc."), False)
        .when(F.size(F.split(d, r"\.")) <= 2, True)
        .otherwise(suffix | d.contains("notion.site"))
    )


def is_issue_link(href: Column | str, marks: tuple[str, ...] = ISSUE_MARKS) -> Column:
    return as_column(href).rlike(quoted(marks))


def is_external_link(href: Column | str, own: str = SITE_DOMAIN) -> Column:
    href = as_column(href)
    return href.startswith("http") & ~href.contains(own)


def candidate_feed_urls(blog_url: Column | str, paths: tuple[str, ...] = FEED_PATHS) -> Column:
    """Array of the URLs at which a blog's feed may be, in order; the blog's own path doesn't count."""
    origin = first_group(blog_url, r"^([^:/?#]+://[^/?#]*)")
    return F.array(*[F.concat(origin, F.lit(p)) for p in paths])
