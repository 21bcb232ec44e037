"""Cascades of the page extraction on hand-made pages."""

import datetime as dt

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from newsflow.operators import pages as P
from newsflow.operators.html_facts import article_facts, link_cards

TODAY = dt.date(2024, 3, 1)


def extract(spark, htmls, **options):
    df = spark.createDataFrame([(i, h) for i, h in enumerate(htmls)], "i int, html string")
    done = P.to_articles(df, F.lit(TODAY), **options).orderBy("i").collect()
    return done


TITLES = {
    '<meta property="og:title" content=" Og "><h1>h</h1>': "Og",
    '<meta property="og:title" content="   "><h1>h</h1>': "",
    '<meta property="og:title" content=""><h1>h</h1>': "h",
    '<meta property="og:title"><meta name="title" content="named">': "named",
    "<h1> </h1><article><h1>second</h1></article>": "second",
    "<h1></h1><header><h1>top</h1></header><article><h1>low</h1></article>": "top",
    '<h1></h1><div class="x caas-title-wrapper"><h1>caas</h1></div>': "caas",
    "<head><title> only </title></head>": "only",
    "<p>nothing</p>": "",
    "<h1>a <b>b</b> &amp; c</h1>": "ab& c",
}


def test_titles(spark):
    got = [r.title for r in extract(spark, TITLES)]
    assert got == list(TITLES.values())


BODIES = {
    "<article><p> a </p><p></p><p>b</p></article>": "a b",
    "<main><div><p>m</p></div></main>": "m",
    "<div data-test-locator='mega'><p>g</p></div>": "g",
    "<article><p>a</p></article><main><p>m</p></main>": "a m",
    '<div class="caas-body"><p>one</p></div>': "one",
    '<div id="article-body"><p>two</p></div>': "two",
    '<div itemprop="articleBody"><p>three</p></div>': "three",
    '<div itemprop="articleBody"><div><p>four</p></div></div>': "four",
    '<section data-test-locator="mega"><p>five</p></section>': "five",
    '<div id="article-body"><p>later</p></div><div class="caas-body"><p>first</p></div>': "first",
    '<article><p> </p></article><meta name="description" content="d">': "본문 없음",
    '<meta name="description" content=" d ">': "d",
    '<meta property="og:description" content="od">': "od",
    '<meta name="description" content=""><meta property="og:description" content="od">': "본문 없음",
    "<p>outside</p>": "본문 없음",
    "<article><p>a <b>b</b><!-- no --> c<script>var x='no'</script></p></article>": "abc",
    "<article><p>one<p>two</article>": "one two",
    "<article><p><b>one<br><p>two</p></article>": "one two",
    "": "본문 없음",
}


def test_bodies(spark):
    got = [r.content for r in extract(spark, BODIES)]
    assert got == list(BODIES.values())


def test_nested_paragraphs_and_separator(spark):
    page = "<article><p>one<p>two</article>"
    assert extract(spark, [page], nested_p=True)[0].content == "onetwo two"
    assert extract(spark, ["<article><p>a <b>b</b></p></article>"], inline_sep=" ")[0].content == "a b"


def _time(value):
    return f'<time datetime="{value}">x</time>'


DATES = {
    _time("2024-01-01T20:00:00Z"): dt.date(2024, 1, 2),
    _time("2024-01-01T20:00:00-0500"): dt.date(2024, 1, 2),
    _time("2024-01-01T10:00:00+09:00"): dt.date(2024, 1, 1),
    _time("2024-01-01T20:00:00.123Z"): dt.date(2024, 1, 2),
    _time("2024-01-01 20Z"): dt.date(2024, 1, 2),
    _time("Mon, 01 Jan 2024 20:00:00 +0000"): dt.date(2024, 1, 2),
    _time("Mon, 01 Jan 2024 20:00:00 GMT"): TODAY,
    _time("2024-01-01T20:00:00"): TODAY,
    _time("2024-01-01"): TODAY,
    _time("2024-01-01T25:00:00Z"): TODAY,
    _time("junk"): TODAY,
    _time(""): TODAY,
    "": TODAY,
    _time("junk") + '<meta name="publish-date" content="2024-01-05T00:00:00Z">': dt.date(2024, 1, 5),
    '<meta itemprop="datePublished" content="2024-01-06T00:00:00Z">'
    '<meta property="article:published_time" content="2024-01-04T00:00:00Z">': dt.date(2024, 1, 4),
    '<meta property="article:published_time" content="2024-01-04">'
    '<meta name="article:published_time" content="2024-01-03T00:00:00Z">': dt.date(2024, 1, 3),
    _time("2024-01-02T00:00:00Z") + _time("2024-01-09T00:00:00Z"): dt.date(2024, 1, 2),
}


def test_dates(spark):
    got = [r.date for r in extract(spark, DATES)]
    assert got == list(DATES.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_dates_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        assert [r.date for r in extract(spark, DATES)] == list(DATES.values())
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unreadable_page_is_an_error_row(spark, monkeypatch):
    facts = article_facts(12)  # type: ignore[arg-type]
    assert facts["error"]
    df = spark.createDataFrame([(1, None)], "i int, html string")
    row = P.to_articles(df, F.lit(TODAY)).collect()[0]
    assert (row.title, row.content, row.date) == (None, None, TODAY) and row.error


def test_pages_are_parsed_once_and_without_a_shuffle(rows):
    df = rows([("u", "<h1>x</h1>", 200)], "url string, html string, status_code int")
    plan = P.to_articles(df, F.lit(TODAY))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan


def test_listings_are_parsed_once(rows):
    df = rows([("T", LISTING)], "ticker string, html string")
    plan = P.collect_links(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_status_is_kept_unless_asked(rows):
    df = rows([("u", "<h1>x</h1>", 404)], "url string, html string, status_code int")
    assert P.to_articles(df, F.lit(TODAY)).count() == 1
    assert P.to_articles(df, F.lit(TODAY), ok_only=True).count() == 0


LISTING = """
<section data-testid="storyitem"><a href="/news/1">x</a><time datetime="2024-01-02T10:00:00Z"></time></section>
<section data-testid="storyitem"><a href="https://e.com/2">x</a><a href="/no">y</a></section>
<section data-testid="storyitem"><a>no target</a><a href="/no">y</a></section>
<section data-testid="storyitem"><a href="">empty</a></section>
<section data-testid="storyitem">no link</section>
<section data-testid="storyitem"><a href="/news/1">again</a><time datetime="2024-01-09T10:00:00Z"></time></section>
<li class="js-stream-content"><a href="/news/li">l</a></li>
"""


def test_story_cards():
    assert link_cards(LISTING) == [
        {"pos": 0, "href": "/news/1", "datetime": "2024-01-02T10:00:00Z"},
        {"pos": 1, "href": "https://e.com/2", "datetime": None},
        {"pos": 5, "href": "/news/1", "datetime": "2024-01-09T10:00:00Z"},
    ]


def test_fallback_cards():
    hrefs = lambda html, which="fallback": [c["href"] for c in link_cards(html, which)]
    assert hrefs(LISTING)[0] == "/news/1"
    assert hrefs('<li class="a js-stream-content"><p><a href="/li">x</a></p></li>') == ["/li"]
    wrapped = '<div class="caas-content-wrapper"><a href="/out">o</a><article><a href="/in">i</a></article></div>'
    assert hrefs(wrapped) == ["/in"]
    assert hrefs('<div class="caas-content-wrapper"><a href="/out">o</a></div>') == ["/out"]
    assert hrefs('<article><div class="caas-content-wrapper"><a href="/x">o</a></div></article>') == ["/x"]
    assert hrefs(wrapped, "story") == []
    assert hrefs(wrapped, "anchors") == ["/out", "/in"]


def test_links_are_distinct_in_page_order(rows):
    df = rows([("T", LISTING)], "ticker string, html string")
    links = P.collect_links(df).orderBy("pos").collect()
    assert [(r.pos, r.url) for r in links] == [
        (0, "https://finance.yahoo.com/news/1"),
        (1, "https://e.com/2"),
    ]
    news = P.news_links(df).collect()
    assert [r.url for r in news] == ["https://finance.yahoo.com/news/1"]


def test_best_fetch(rows):
    site = "https://finance.yahoo.com/a"
    fetch = "url string, title string, content string, date date, pos int, rendered boolean"
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    df = rows(
        [
            (site + "1", "t", "short", d1, 0, False), (site + "1", "", "longer text", d2, 1, True),
            (site + "2", "t", "x" * 120, d1, 0, False), (site + "2", "n", "x" * 500, d2, 1, True),
            ("https://other/3", "t", "short", d1, 0, False), ("https://other/3", "n", "longer text", d2, 1, True),
            (site + "4", "t", "same1", d1, 0, False), (site + "4", "n", "same2", d2, 1, True),
            (site + "5", "t", "alone", d1, 0, False),
            (site + "6", "t", "short", d1, 0, False), (site + "6", "n", "longer text", None, 1, True),
        ],
        fetch,
    )
    got = {r.url[-1]: r for r in P.best_fetch(df, F.col("rendered")).collect()}
    assert (got["1"].title, got["1"].content, got["1"].date) == ("t", "longer text", d2)
    assert not got["2"].used_second and not got["3"].used_second and not got["4"].used_second
    assert got["5"].content == "alone"
    assert (got["6"].title, got["6"].date) == ("n", d1)


def test_a_reference_cut_off_counts_only_if_asked():
    html = "<h1>a &amp; b&amp</h1><article><p>x&quo &ampx; &lt;&#38;&#38</p></article>"
    loose, closed = article_facts(html), article_facts(html, open_refs=False)
    assert loose["headings"][0] == "a & b&"
    assert closed["headings"][0] == "a & b&amp"
    assert closed["paragraphs"] == ["x&quo &ampx; <&&#38"]


def test_pages_are_read_in_bounded_slices(spark):
    pages = pa.array(["x" * n for n in (5, 5, 1, 50, 2, 2)] + [None, ""])
    parts = list(P.page_slices(pages, 10))
    assert pa.concat_arrays(parts) == pages
    assert [len(p) for p in parts] == [2, 1, 1, 4]
    assert [len(p) for p in P.page_slices(pages.slice(0, 0), 10)] == [0]
    key, before = "spark.sql.execution.arrow.maxRecordsPerBatch", spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set(key, "10000")
        extract(spark, ["<h1>x</h1>"])
        assert int(spark.conf.get(key)) <= 1000
    finally:
        spark.conf.set(key, before)
