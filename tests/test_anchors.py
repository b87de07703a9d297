"""Anchors of tag soup against a parser with a stack of open elements."""

import random
from html.parser import HTMLParser

import pytest

from feedmill.operators import discovery as D


class Soup(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found, self.open, self.said = [], [], []

    def flush(self):
        """Text up to a tag or comment is one piece, whatever the parser cuts it into."""
        data, self.said = "".join(self.said).strip(), []
        if not any(t in ("script", "style") for t, _ in self.open):
            for _, row in self.open:
                if row:
                    row["text"].append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_starttag(self, tag, attrs):
        self.flush()
        row = None
        if tag == "a":
            row = {"href": dict(attrs).get("href", None if "href" not in dict(attrs) else ""), "has": "href" in dict(attrs), "text": []}
            self.found.append(row)
        if tag not in D._VOID:
            self.open.append((tag, row))

    def handle_startendtag(self, tag, attrs):
        self.flush()
        n = len(self.open)
        self.handle_starttag(tag, attrs)
        del self.open[n:]

    def handle_endtag(self, tag):
        self.flush()
        if any(t == tag for t, _ in self.open):
            while self.open.pop()[0] != tag:
                pass

    def handle_data(self, data):
        self.said.append(data)


def parsed(html):
    page = Soup()
    page.feed(html or "")
    page.close()
    page.flush()
    return [(k, r["href"] or "", "".join(r["text"])) for k, r in enumerate([r for r in page.found if r["has"]])]


ODD = [
    None, "", "no tags", "<a href=x>one<a href=y>two</a>three</a>four", "<p><a href='x'>in <b>bold</p> out</b></a> after", "<a href=\"x>y\" title='<b>'>q</a>", "<A HREF=X>u</A >", "<a>no href</a><a href>empty</a><a href=''>e2</a>",
    "<a href=x/>t</a>", "<a href='x'/>not in</a>", "<div><a href=z>open <div>inner</div> still</div> closed", "</a></p><a href=q>a<!-- <a href=no>c</a> -->b</a>", "<script>var s='<a href=n>x</a>'</script><a href=y>v<style>p{}</style>w</a>",
    "<a href=x>a &amp; b &lt;c&gt; &quot;d&quot; &#33;</a>", "<a href='?a=1&amp;b=2'>q</a>", "<ul><li><a href=1>one<li><a href=2>two</ul><a href=3>three", "a < b <a href=m>1 < 2</a>", "<a data-href=no href=yes>d</a>", "<a\nhref = 'sp'\n>n\n l</a>", "<!-- open <a href=x>y</a>",
]


def test_odd_pages(spark):
    rows = [(k, h) for k, h in enumerate(ODD)]
    out = spark.createDataFrame(rows, "k int, body string").select("k", D.parsed_anchors("body").alias("a"))
    assert "Python" not in out._jdf.queryExecution().toString()
    got = {r.k: [tuple(x) for x in r.a] for r in out.collect()}
    assert got == {k: parsed(h) for k, h in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_soup(spark, seed):
    rng = random.Random(seed)
    bits = ["<a href=x{}>", "<a href='y{}'>", "<a>", "</a>", "</a>", "<p>", "</p>", "<div class=\"c\">", "</div>", "<br>", "<b>", "</b>", "<img src=i>", "<li>", "</ul>", "<ul>", "<!-- c -->", "<i/>", " words {} ", "w{}", "\n", "é語"]
    rows = [(k, "".join(rng.choice(bits).format(rng.randrange(9)) for _ in range(rng.randrange(60)))) for k in range(300)] + [(300, "<p>" * 2000 + "<a href=deep>t"), (301, "<a href=n>" * 150 + "x")]
    got = {r.k: [tuple(x) for x in r.a] for r in spark.createDataFrame(rows, "k int, body string").select("k", D.parsed_anchors("body").alias("a")).collect()}
    for k, html in rows:
        assert got[k] == parsed(html), html
