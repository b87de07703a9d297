"""Queries over tables with rows that the smaller given tables don't have, against their SQL."""

import pytest

PAGES = "page_id long, url string, html string"


def same_as_sql(spark, folder, name, **tables):
    """Whether the query gives the rows of its SQL over these tables; returns the rows."""
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    con = duckdb.connect()
    for table, rows in tables.items():
        rows.coalesce(1).write.parquet(f"{folder}/{table}.parquet")
        con.execute(f"create view {table} as select * from read_parquet('{folder}/{table}.parquet/*.parquet')")
    df = e.queries()[name](spark, str(folder))
    want = con.execute(f"select {', '.join(df.columns)} from ({e.oracle_sql()[name]})").fetchall()
    got = sorted(tuple(map(str, r)) for r in df.collect())
    assert got == sorted(tuple(map(str, r)) for r in want)
    return got


def test_responses_of_a_repeated_url(spark, tmp_path):
    pages = spark.createDataFrame([(1, "https://a/x", ""), (3, "https://a/x", ""), (4, "https://a/x", ""), (8, "https://a/y", "")], PAGES)
    got = same_as_sql(spark, tmp_path, "landed_responses", pages=pages)
    assert got == [("https://a/x", "200", "True")] * 2 + [("https://a/x", "204", "False"), ("https://a/y", "200", "True")]


def test_a_url_with_a_valid_and_an_invalid_response_is_purged(spark, tmp_path):
    pages = spark.createDataFrame([(4, "https://a/x", "<rss>"), (20, "https://a/x", ""), (8, "https://a/y", "<rss>"), (28, "https://a/y", "")], PAGES)
    got = same_as_sql(spark, tmp_path, "purged_blogs", pages=pages)
    assert [r[3] for r in got] == ["True", "False", "True", "False"]


@pytest.mark.parametrize("name", ["page_main_content", "page_markdown"])
def test_references_that_were_cut(spark, tmp_path, name):
    html = '<html><body><div class="ad">An ad.</div><article><h1>Title = &quot</h1><p>{}A &amp and &quot;b&quot;.</p></article></body></html>'
    pages = spark.createDataFrame([(k, f"https://a/{k}", html.format("Some words of a story. " * 9)) for k in range(1, 9)], PAGES)
    same_as_sql(spark, tmp_path, name, pages=pages)


def test_white_space_of_an_ad_that_wins(spark, tmp_path):
    html = '<html><body><div class="ad">{}</div><article><h1>Title</h1><p>A short\nstory.</p></article></body></html>'
    ads = ["An ad that is longer than the story.\nIt has two lines.", " One line, \n\n\n  then  another,\tand a third.\r\n ", "\nA line break before a longer text", "Brief\nad"]
    pages = spark.createDataFrame([(k, f"https://a/{k}", html.format(ad)) for k, ad in enumerate(ads)], PAGES)
    got = same_as_sql(spark, tmp_path, "page_main_content", pages=pages)
    assert [r[1] for r in got] == ["div", "div", "div", "section"]


@pytest.mark.parametrize("name", ["translation_jobs", "translated_clippings"])
def test_short_clippings_beside_chinese(spark, tmp_path, name):
    rows = [(1, 3, "user", "Le de éç de."), (1, 4, "user", "Le de éç de."), (3, 1, "user", "A longer text, most of which is not Chinese at all.")]
    talks = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    same_as_sql(spark, tmp_path, name, conversations=talks)


def test_a_listing_holds_a_fifth_of_all_pages(spark, tmp_path):
    pages = spark.range(0, 1500).selectExpr("id as page_id", "'https://a/' || id as url", "'' as html")
    got = same_as_sql(spark, tmp_path, "listed_issues", pages=pages)
    assert len({r[0] for r in got}) == 5 and max(int(r[1]) for r in got) > 100
