"""Text out of feed XML and HTML, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedmill.functions.text import as_column, filled, first_group, let, or_else, strip


def cdata(text: Column | str) -> Column:
    """What the first CDATA section holds; the text itself without one."""
    return let(as_column(text), lambda t: F.when(t.contains("<![CDATA["), F.regexp_replace(t, r"(?s)\A.*?<!\[CDATA\[(.*?)\]\]>.*\z", "$1")).otherwise(t))


def tag_text(xml: Column | str, tag: str) -> Column:
    """Text of the first element whose tag begins with the name, stripped; empty without one."""
    return strip(cdata(first_group(xml, rf"(?is)<{tag}[^>]*>(.*?)</{tag}>")))


def attr_value(xml: Column | str, tag: str, attr: str) -> Column:
    """An attribute of the first tag that has it. tag is a pattern."""
    return first_group(xml, rf"""(?i)<{tag}[^>]*\s{attr}=["']([^"']*)["'][^>]*/?>""")


def decode_numeric_entities(text: Column | str) -> Column:
    """Decimal character references in one pass, taken modulo 65536.

    Two surrogates side by side are the one character that they stand for; others and unreadable ones become U+FFFD.
    """
    text = filled(text)
    code = lambda n: F.coalesce(F.pmod(n.try_cast("decimal(38,0)"), F.lit(65536)).cast("int"), F.lit(0xFFFD))
    units = lambda n: F.lpad(F.hex(n), 4, "0")
    char = lambda n: F.decode(F.unhex(units(F.when((n >= 0xD800) & (n <= 0xDFFF), 0xFFFD).otherwise(n))), "UTF-16BE")
    pieces = F.split(text, r"&#[0-9]+;", -1)
    codes = F.transform(F.regexp_extract_all(text, F.lit(r"&#([0-9]+);"), F.lit(1)), code)
    # each with the piece before it and its neighbours, which count where nothing stands between
    near = F.transform(codes, lambda n, k: F.struct(n.alias("n"), F.when(F.get(pieces, k) == "", F.get(codes, k - 1)).alias("before"), F.when(F.get(pieces, k + 1) == "", F.get(codes, k + 1)).alias("after")))
    first, second = (lambda n: F.coalesce((n >= 0xD800) & (n < 0xDC00), F.lit(False))), (lambda n: F.coalesce((n >= 0xDC00) & (n <= 0xDFFF), F.lit(False)))
    pair = lambda x: F.when(first(x["n"]) & second(x["after"]), F.decode(F.unhex(F.concat(units(x["n"]), units(x["after"]))), "UTF-16BE")).when(second(x["n"]) & first(x["before"]), "")
    chars = F.transform(near, lambda x: F.coalesce(pair(x), char(x["n"])))
    joined = F.array_join(F.zip_with(pieces, chars, lambda p, c: F.concat(p, F.coalesce(c, F.lit("")))), "")
    return F.when(text.rlike(r"&#[0-9]+;"), joined).otherwise(text)


#: Entities in the order in which they are decoded.
ENTITIES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "))


def strip_html(text: Column | str) -> Column:
    """Drop tags, then decode entities one kind after another, so a doubly escaped one is decoded twice."""
    return strip(_decoded(_without_tags(filled(text))))


def _without_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]*>", "")


def _decoded(text: Column) -> Column:
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return decode_numeric_entities(text)


def html_start(text: Column | str, limit: int, ahead: int | None = None) -> Column:
    """The first limit characters of strip_html(text), from the text's first ahead characters where they settle it.

    They do if no tag or entity can reach over their end, and if they give limit characters up to one that is no white space.
    """
    ahead = ahead or 6 * limit

    def begin(whole: Column) -> Column:
        head = F.substring(whole, 1, ahead)
        safe = lambda s: ~F.right(s, F.lit(64)).contains("&") & F.right(s, F.lit(64)).rlike("[^0-9]") & (F.length(s) >= 64)
        settled = let(_without_tags(head), lambda s: F.when(safe(s), let(strip(_decoded(s)), lambda d: F.when(F.length(d) >= limit, d))))
        return F.substring(F.coalesce(F.when((F.length(whole) > ahead) & ~head.rlike(r"<[^>]*\z"), settled), strip_html(whole)), 1, limit)

    return let(filled(text), begin)


def feed_format(body: Column | str) -> Column:
    """'atom' or 'rss', by marks in the text."""
    body = as_column(body)
    atom = (body.contains("<feed") & body.contains('xmlns="http://www.w3.org/2005/Atom"')) | body.contains("<feed ")
    return F.when(atom, "atom").otherwise("rss")


def feed_items(body: Column | str) -> Column:
    """Array of the contents of all entries or items."""
    body = as_column(body)
    return F.when(feed_format(body) == "atom", F.regexp_extract_all(body, F.lit(r"(?is)<entry[\s>](.*?)</entry>"), F.lit(1))).otherwise(
        F.regexp_extract_all(body, F.lit(r"(?is)<item[\s>](.*?)</item>"), F.lit(1))
    )


def atom_link(entry: Column | str) -> Column:
    """href of a link that says rel="alternate" before it; else of the first link with one."""
    return or_else(attr_value(entry, 'link[^>]*rel="alternate"', "href"), attr_value(entry, "link", "href"))


def rss_link(item: Column | str) -> Column:
    """Text of link, else of guid; entities stay."""
    return or_else(tag_text(item, "link"), tag_text(item, "guid"))


def item_link(item: Column | str, kind: Column) -> Column:
    return F.when(kind == "atom", atom_link(item)).otherwise(rss_link(item))


def item_date_text(item: Column | str, kind: Column) -> Column:
    return F.when(kind == "atom", or_else(tag_text(item, "published"), tag_text(item, "updated"))).otherwise(
        or_else(tag_text(item, "pubDate"), tag_text(item, "dc:date"), tag_text(item, "date"))
    )


def item_description(item: Column | str, kind: Column, limit: int = 500) -> Column:
    """Summary or content without markup, cut to its first characters."""
    raw = F.when(kind == "atom", or_else(tag_text(item, "summary"), tag_text(item, "content"))).otherwise(or_else(tag_text(item, "description"), tag_text(item, "content:encoded")))
    return html_start(raw, limit)


#: Offsets of the zone names that feeds use. Single letters are zones that say nothing, and count as UTC.
ZONES = (("UTC", "+00:00"), ("UT", "+00:00"), ("GMT", "+00:00"), ("EST", "-05:00"), ("EDT", "-04:00"), ("CST", "-06:00"), ("CDT", "-05:00"), ("MST", "-07:00"), ("MDT", "-06:00"), ("PST", "-08:00"), ("PDT", "-07:00"))
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_DAYS = "mon|tue|wed|thu|fri|sat|sun"
_CLOCK = r"(?<![0-9])([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}(?:[.,][0-9]{1,6})?)[0-9]*)?(?:\s*([ap])\.?m\b\.?)?"
_OFFSET = r"([+-])([0-9]{1,2}):?([0-9]{2})?(?![0-9])"
_WORD = r"(?:[a-ik-z]|" + "|".join(name.lower() for name, _ in ZONES) + ")"


def _groups(text: Column, pattern: str, n: int) -> Column:
    """The first n groups of the first match, empty where there is none, and after them what stands around the match."""
    found = F.regexp_replace(text, f"(?s)^(.*?){pattern}(.*)$", "|".join(f"${k}" for k in range(2, n + 2)) + f"|$1 ${n + 2}")
    return F.split(F.when(text.rlike(pattern), found).otherwise(F.concat(F.lit("|" * n), text)), r"\|", n + 1)


def _date(text: Column) -> Column:
    """(y, m, d) of a text that holds a date and no clock."""
    number = lambda x: x.try_cast("int")
    year = lambda y: F.when(F.length(y) > 2, number(y)).otherwise(number(y) + F.when(number(y) < 50, 2000).otherwise(1900))
    made = lambda y, m, d: F.struct(y.alias("y"), m.alias("m"), d.alias("d"))

    def named(numbers: Column) -> Column:
        """A month by name, a year of more than two digits or after the day, and a day, the first of the month if there is none."""
        month = (F.position(first_group(text, f"(?:^|[^a-z])({'|'.join(_MONTHS)})"), F.lit("".join(_MONTHS))) + 2) / 3
        long = F.filter(numbers, lambda n: F.length(n) > 2)
        short = F.filter(numbers, lambda n: F.length(n) <= 2)
        return made(year(F.when(F.size(long) > 0, F.get(long, F.lit(0))).otherwise(F.get(short, F.lit(1)))), month.cast("int"), F.coalesce(number(F.get(short, F.lit(0))), F.lit(1)))

    iso, us = (rf"(?<![0-9]){pattern}(?![0-9])" for pattern in (r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})", r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}|[0-9]{2})"))
    return (
        F.when(text.rlike(iso), let(_groups(text, iso, 3), lambda g: made(number(g[0]), number(g[1]), number(g[2]))))
        .when(text.rlike(us), let(_groups(text, us, 3), lambda g: made(year(g[2]), number(g[0]), number(g[1]))))
        .when(text.rlike(f"(?:^|[^a-z])(?:{'|'.join(_MONTHS)})"), let(F.regexp_extract_all(text, F.lit("([0-9]+)"), F.lit(1)), named))
    )


def _moment(text: Column) -> Column:
    """Timestamp of a text in lower case: a clock, a zone after it, and a date in what is left."""

    def with_zone(clock: Column) -> Column:
        rest = F.when(clock[0] != "", first_group(text, f"(?s){_CLOCK}(.*)$", 5)).otherwise("")
        zone = let(_groups(rest, rf"^\s*(?:(?:gmt|utc?|z)\s*)?{_OFFSET}", 3), offset)
        word = first_group(rest, rf"^\s*({_WORD})(?![a-z0-9])")
        names = F.coalesce(*[F.when(word == name.lower(), offset) for name, offset in ZONES], F.when(word != "", "+00:00"))
        before = F.when(clock[0] != "", first_group(text, f"(?s)^(.*?){_CLOCK}", 1)).otherwise(text)
        left = F.regexp_replace(rest, rf"^\s*(?:(?:(?:gmt|utc?|z)\s*)?{_OFFSET}|{_WORD}(?![a-z0-9]))", "")
        # another word after the clock is a zone that nobody knows
        date = F.when(~rest.rlike(rf"^\s*(?!(?:{_DAYS}|{'|'.join(_MONTHS)})[a-z]*|(?:{_WORD})(?![a-z0-9]))[a-z]"), let(F.concat(before, F.lit(" "), left), _date))
        return let(F.struct(date.alias("date"), F.coalesce(zone, names).alias("zone"), clock.alias("clock")), stamp)

    def offset(g: Column) -> Column:
        return F.when(g[0] != "", F.concat(g[0], F.lpad(g[1], 2, "0"), F.lit(":"), F.when(g[2] != "", g[2]).otherwise("00")))

    def stamp(x: Column) -> Column:
        d, c = x["date"], x["clock"]
        hour = F.coalesce(c[0].try_cast("int"), F.lit(0))
        hour = F.when(c[3] == "", hour).otherwise(hour % 12 + F.when(c[3] == "p", 12).otherwise(0))
        clock = (hour, F.coalesce(c[1].try_cast("int"), F.lit(0)), F.coalesce(F.replace(c[2], F.lit(","), F.lit(".")).try_cast("decimal(8,6)"), F.lit(0).cast("decimal(8,6)")))
        own = F.try_make_timestamp(d["y"], d["m"], d["d"], *clock)
        right = x["zone"].rlike("^[+-](?:0[0-9]|1[0-7]):[0-5][0-9]$")
        return F.when(x["zone"].isNull(), own).when(right, F.try_make_timestamp(d["y"], d["m"], d["d"], *clock, x["zone"]))

    return let(F.slice(_groups(text, _CLOCK, 4), 1, 4), with_zone)


def parse_feed_date(text: Column | str) -> Column:
    """Timestamp of a feed's date, in the session's time zone where it names none; unreadable dates are 1970-01-01.

    ISO dates are read as Spark reads them. In other texts a clock (with seconds or not, am or pm), a zone (an offset or
    a name of ZONES after the clock) and a date are looked for, whatever stands around them: year-month-day, or
    month/day/year, or a month's name with a day and a year before or after it. A clock with an unknown zone is unreadable. Years of two digits are 1950 to 2049. What
    stands in brackets doesn't count. A date without a year is unreadable.
    """
    plain = F.regexp_replace(F.lower(strip(filled(text))), r"\([^)]*\)|\|", " ")
    iso = lambda t: F.when(t.rlike(r"^[0-9]{4}-"), F.try_to_timestamp(F.upper(t)))
    return let(plain, lambda t: F.coalesce(iso(t), _moment(t), F.timestamp_seconds(F.lit(0))))


def looks_like_feed_head(body: Column | str, limit: int = 500) -> Column:
    return F.lower(F.substring(filled(body), 1, limit)).rlike(r"<\?xml|<rss|<feed")


def is_valid_feed(status: Column | str, body: Column | str, limit: int = 4000) -> Column:
    """Whether a response is a feed: status 200, a feed's tag near the start, and XML rather than a web page."""
    head = F.lower(F.substring(filled(body), 1, limit))
    marked = head.rlike(r"<rss|<feed|<rdf:")
    page = head.contains("<html") & ~head.rlike(r"<\?xml|<rss|<feed")
    xml = head.contains("<?xml") | F.regexp_replace(head, r"^\s+", "").rlike(r"^(?:<rss|<feed|<rdf:)")
    return F.coalesce((as_column(status) == 200) & marked & ~page & xml, F.lit(False))
