import pytest
from pyspark.sql import functions as F

from sparksignal.functions.common import collapse, is_blank, strip
from sparksignal.functions.dates import floor_minutes, with_publication_day
from sparksignal.functions.html import (
    business_section,
    filing_text,
    page_body,
    page_pieces,
    page_links,
    page_title,
    visible_text,
)
from sparksignal.functions.sentiment import label_scores, label_value, softmax
from sparksignal.functions.text import (
    category_id,
    category_search_text,
    category_sentence,
    compose_headline,
    normalize_symbol,
    url_title,
)
from sparksignal.functions.vectors import cosine, distance_score, squared_distance
from sparksignal.operators.filters import (
    contains_any,
    keyword_filter,
    outlet_filter,
    pending_enrichment,
    raw_keyword_filter,
)
from sparksignal.plans.filings import filing_sections


def one(spark, expression, value, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v")).alias("out")).first()["out"]


@pytest.mark.parametrize(
    "url, title",
    [
        ("https://a.org/a/fed-raises+rates_again.html", "fed raises+rates again"),
        ("https://a.org/x/100%zz", "100%zz"),
        ("https://a.org/x/100%zz%20b", "100%zz b"),
        ("https://a.org/x%2Fslug-1", "slug 1"),
        ("https://a.org/x/last-segment/", "last segment"),
        ("https://a.org/x/last-segment//", "last segment"),
        ("https://a.org/n/story-123e4567-e89b-12d3-a456-426614174000", "story"),
        ("https://a.org/n/the-name;v=1?q=2#f", "the name"),
        ("https://a.org", ""),
        ("https://a.org/caf%C3%A9-news.HTML", "café news"),
        ("https://a.org/report.2024-final", "report.2024 final"),
    ],
)
def test_url_title(spark, url, title):
    assert one(spark, url_title, url) == title


def headline(spark, **row):
    names = ["title", "news_summary", "article_text", "article_text_source"]
    schema = ", ".join(f"{n} string" for n in names if n in row)
    df = spark.createDataFrame([tuple(row[n] for n in names if n in row)], schema)
    return df.select(compose_headline(df).alias("h")).first()["h"]


def test_headline_composition(spark):
    assert headline(spark, title="T", news_summary="S", article_text="", article_text_source="url") == ". S"
    assert headline(spark, title="T", news_summary="S", article_text="A", article_text_source="url") == "A. S"
    assert headline(spark, title="T", news_summary="S", article_text="A", article_text_source="web") == "A"
    assert headline(spark, title="T", news_summary="S", article_text=" \n", article_text_source="web") == "T. S"
    assert headline(spark, title="T", news_summary=None) == "T."
    # Not blank, so there is no fallback.
    assert headline(spark, title="T", news_summary="", article_text="", article_text_source="url") == "."
    assert headline(spark, title="", news_summary="") == "."
    assert headline(spark, title="None", news_summary="x") == "None. x"


def test_white_space(spark):
    assert one(spark, strip, " \n a b \t ") == "a b"
    assert one(spark, collapse, "  a \n  b ") == "a b"
    assert one(spark, is_blank, "  \n") is True
    assert one(spark, is_blank, None) is True
    assert one(spark, is_blank, " x") is False


@pytest.mark.parametrize(
    "raw, day, minute",
    [
        ("2024-01-31", "2024-02-01", "00:00"),
        ("2024-01-31 09:05", "2024-01-31", "09:05"),
        ("2024-01-31T09:05:59Z", "2024-01-31", "09:05"),
        ("2024-01-31T23:30:00-02:00", "2024-02-01", "01:30"),
        ("Wed, 31 Jan 2024 09:05:00 GMT", "2024-01-31", "09:05"),
        ("Wed, 31 Jan 2024 23:05:00 EST", "2024-02-01", "04:05"),
        ("Wed, 31 Jan 2024 23:05:00 +0100", "2024-01-31", "22:05"),
        ("5 May 2024 07:08 +0000", "2024-05-05", "07:08"),
        ("January 5, 2024", "2024-01-06", "00:00"),
        ("Jan 5, 2024 9:07 PM", "2024-01-05", "21:07"),
        ("2024/01/05 10:11", "2024-01-05", "10:11"),
        ("", "2024-03-02", "00:00"),
        ("nonsense: really", "2024-03-02", "00:00"),
    ],
)
def test_publication_day(spark, raw, day, minute):
    df = spark.createDataFrame([(raw,)], "raw string")
    row = with_publication_day(df, F.col("raw"), "2024-03-01 12:00:00").first()
    assert (row["day"], row["hour_minute"]) == (day, minute)


def test_stamp_day(spark):
    df = spark.createDataFrame([("20240131090500",), ("x",)], "raw string")
    rows = with_publication_day(df, F.col("raw"), "2024-03-01 12:00:00", stamps=True).collect()
    assert [(r["day"], r["hour_minute"]) for r in rows] == [("2024-01-31", "09:05"), ("2024-03-02", "00:00")]


def test_floor(spark):
    assert str(one(spark, lambda c: floor_minutes(c.cast("timestamp")), "2024-01-01 10:29:59.999")) == "2024-01-01 10:15:00"
    assert str(one(spark, lambda c: floor_minutes(c.cast("timestamp")), "1969-12-31 23:59:00")) == "1969-12-31 23:45:00"


def test_visible_text(spark):
    html = (
        "<html><head><title>T &amp; x</title><style>p{}</style><script>var a='</nav><p>';</script></head>"
        "<body><header>h<nav>n<nav>deep</nav>m</nav>h2</header><!-- <p>gone</p> -->"
        "<p>One&nbsp; <b>two</b></p>\n<noscript>no</noscript><navy>kept</navy><footer>f</footer>end &lt;b&gt;</body></html>"
    )
    assert one(spark, visible_text, html) == "T & x One two kept end <b>"
    assert one(spark, visible_text, "plain") == "plain"
    assert one(spark, visible_text, None) is None


def test_page_title_and_body(spark):
    html = "<html><head><title> A &amp; B </title></head><body><p>x</p> y</body></html>"
    assert one(spark, page_title, html) == "A & B"
    assert one(spark, page_body, html) == "x y"
    assert one(spark, page_title, "<p>x</p>") is None


def test_hidden_blocks_and_sections(spark):
    assert one(spark, lambda c: F.trim(filing_text(c)), '<div style="DISPLAY: none">x<div>z</div></div>y') == "y"
    assert one(spark, lambda c: F.trim(filing_text(c)), "<p style='display:none'>x</p><br style=display:none>y") == "y"
    assert one(spark, lambda c: F.trim(filing_text(c)), "a  &nbsp;b<br/>c") == "a b c"
    contents = "Item 1. Business 3 Item 1A. Risk Factors 9 "
    body = "ITEM 1.  Business We make things. Item 1A. Risk Factors Many. Item 1A. Risk Factors"
    text = f"<p>{contents}</p><p>{body}</p>"
    assert one(spark, lambda c: business_section(filing_text(c)), text) == "ITEM 1. Business We make things."
    assert one(spark, business_section, "Item 1A. Risk Factors Item 1. Business tail") is None
    assert one(spark, business_section, "Item 1. Business a Item 1A. Risk Factors b Item 1. Business c") is None
    assert one(spark, business_section, "nothing") is None
    df = spark.createDataFrame([(1, text), (2, "none")], "id int, html string")
    assert [tuple(r) for r in filing_sections(df).collect()] == [(1, "ITEM 1. Business We make things.")]


def test_links(spark):
    html = (
        '<a href="/b">1</a><a class="x" HREF=\'c?x=1&amp;y=2\'>2</a><a href=http://z.org/>3</a><a href="/b">4</a>'
        '<a href="mailto:a@b.c">5</a><a data-href="/no">6</a><script>"<a href=\'/js\'>"</script><a name="q">7</a>'
    )
    df = spark.createDataFrame([("https://a.org/d/e", html)], "url string, html string")
    links = df.select(page_links(F.col("url"), F.col("html")).alias("l")).first()["l"]
    assert links == ["http://z.org/", "https://a.org/b", "https://a.org/d/c?x=1&y=2"]


def test_category_texts(spark):
    df = spark.createDataFrame([("A B", "C D", "desc", ["k1", "k2"])], "s string, c string, d string, k array<string>")
    cols = [F.col(x) for x in "scdk"]
    row = df.select(
        category_search_text(*cols).alias("t"), category_sentence(*cols[1:]).alias("x"), category_id(*cols[:2]).alias("i")
    ).first()
    assert row["t"] == "[A B]\nC D\n\ndesc\n\nTérminos clave: k1 k2\n\nRelevantes: k1 k2"
    assert row["x"] == "Sub-industry: C D. Description: desc. Keywords: k1, k2."
    assert row["i"] == "a_b:c_d"
    assert one(spark, normalize_symbol, "BRK.B") == "BRK-B"


def test_sentiment_functions(spark):
    assert one(spark, label_value, "positive") == 1.0
    assert one(spark, label_value, "Positive") is None
    probs = one(spark, softmax, [1.0, 2.0, 3.0], "array<double>")
    assert sum(probs) == pytest.approx(1.0)
    large = one(spark, lambda c: softmax(c, 0.03), [1000.0, 0.0], "array<double>")
    assert large == pytest.approx([1.0, 0.0])
    scores = one(spark, label_scores, [0.0, 2.0, 1.0], "array<double>")
    assert scores["sentiment"] == "negative"
    assert scores["sentiment_value"] == pytest.approx(scores["score_positive"] - scores["score_negative"])


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    a, b = F.col("a"), F.col("b")
    row = df.select(
        cosine(a, b).alias("c"),
        distance_score(squared_distance(a, b)).alias("s"),
        distance_score(F.lit(4.0), "legacy").alias("l"),
        cosine(a, F.array(F.lit(0.0), F.lit(0.0))).alias("z"),
    ).first()
    assert row["c"] == pytest.approx(0.5**0.5)
    assert row["s"] == 0.5
    assert row["l"] == -7.0
    assert row["z"] is None


def test_keyword_filters(spark):
    df = spark.createDataFrame(
        [(1, "Tesla up", "x"), (2, "other", "APPLE"), (3, "none", None)], "id int, title string, news_summary string"
    )
    ids = lambda rows: sorted(r["id"] for r in rows.collect())
    assert ids(keyword_filter(df, "Tesla, ,Apple".split(","))) == [1, 2]
    assert ids(keyword_filter(df, ["apple"], match_summary=False)) == []
    assert ids(keyword_filter(df, [" ", ""])) == []
    raw = df.select("id", F.col("title").alias("value"))
    assert ids(raw_keyword_filter(raw, ["zzz", ""])) == [1, 2, 3]
    assert ids(raw_keyword_filter(raw, [" up"])) == [1]
    assert ids(raw_keyword_filter(raw, None)) == [1, 2, 3]
    assert df.filter(contains_any(F.col("title"), [])).count() == 0


def test_outlet_and_pending(spark):
    df = spark.createDataFrame([(" 1 ", "a\n b", " WSJ "), ("2", "x", "FT")], "date string, headline string, outlet string")
    assert [tuple(r) for r in outlet_filter(df).collect()] == [("1", "a b", "wsj")]
    news = spark.createDataFrame(
        [("http://a", "GDELT"), ("https://b", "GDELT"), ("httpx", "GDELT"), ("http://c", "RSS"), ("t", "GDELT")],
        "title string, source string",
    )
    assert pending_enrichment(news).count() == 3
    assert [r["title"] for r in pending_enrichment(news, order="title", limit=1).collect()] == ["http://a"]


DATE_TEXTS = [
    ("Tue, 02 Jan 2024 10:00:00 +01:00", "2024-01-02 09:00"),
    ("Tue, 02 Jan 2024 10:00:00 CET", "2024-01-02 10:00"),
    ("Tue, 02 Jan 2024 10:00:00 BST", "2024-01-02 10:00"),
    ("Tue, 02 Jan 2024 10:00:00 EST", "2024-01-02 15:00"),
    ("Tue, 02 Jan 2024 10:00:00 GMT+0200", "2024-01-02 08:00"),
    ("Tue, 2 Jan 24 10:00:00 +0000", "2024-01-02 10:00"),
    ("02 Jan 2024 9:05:00 GMT", "2024-01-02 09:05"),
    ("2 January 2024 10:00:00 GMT", "2024-01-02 10:00"),
    ("Jan. 2, 2024 10:00", "2024-01-02 10:00"),
    ("Tue Jan  2 10:00:00 2024", "2024-01-02 10:00"),
    ("Tue Jan 2 10:00:00 UTC 2024", "2024-01-02 10:00"),
    ("02-Jan-2024 10:00", "2024-01-02 10:00"),
    ("1/2/2024 9:05 AM", "2024-01-02 09:05"),
    ("31/12/2023 9:05 PM", "2023-12-31 21:05"),
    ("May 5 2024 12:30 a.m.", "2024-05-05 00:30"),
    ("2024-01-02 10:00 PM", "2024-01-02 22:00"),
    ("2024-01-02T10:00:00.123+02:00", "2024-01-02 08:00"),
    ("2024-01-02T10:00:00-0500", "2024-01-02 15:00"),
    ("2024/01/02 03:04", "2024-01-02 03:04"),
    ("Sept 2, 2024", "2024-09-02 00:00"),
    ("2 Jan 70", "1970-01-02 00:00"),
    ("20240102", "2024-01-02 00:00"),
    ("20240102103000", "2024-01-02 10:30"),
    ("2024-13-45", None),
    ("30 Feb 2024", None),
    ("soon: maybe", None),
    ("99999999999999999999", None),
    ("Jan", None),
    ("", None),
    (None, None),
]


def test_date_texts_of_many_styles(spark):
    from pyspark.sql import functions as F

    from sparksignal.functions.dates import parse_date_text, unreadable_dates, with_publication_day

    df = spark.createDataFrame(DATE_TEXTS, "raw string, want string")
    got = df.select("raw", "want", F.date_format(parse_date_text(F.col("raw")), "yyyy-MM-dd HH:mm").alias("got")).collect()
    assert [(r["raw"], r["got"]) for r in got] == [(r["raw"], r["want"]) for r in got]
    counts = unreadable_dates(df, F.col("raw")).first()
    assert tuple(counts) == (len(DATE_TEXTS), 2, sum(1 for t, w in DATE_TEXTS if t and w is None))
    day = {r["raw"]: r for r in with_publication_day(df, F.col("raw"), "2024-03-01 12:00:00").collect()}
    assert (day["Sept 2, 2024"]["day"], day["Sept 2, 2024"]["hour_minute"]) == ("2024-09-03", "00:00")
    assert (day["soon: maybe"]["day"], day["soon: maybe"]["hour_minute"]) == ("2024-03-02", "00:00")


def test_urls_that_landed_twice_keep_one_row(spark):
    from pyspark.sql import functions as F

    from sparksignal.operators.joins import attach_page_text, enrich_articles

    news = spark.createDataFrame([(1, "http://a/x-y"), (2, "http://a/x-y"), (3, "plain"), (4, "http://b/z")], "n int, title string")
    pages = spark.createDataFrame(
        [("http://a/x-y", "one"), ("http://a/x-y", "two"), ("http://a/x-y", "two"), ("http://c/", "unused")], "url string, html string"
    )
    rows = attach_page_text(news, pages, text=F.upper("html")).collect()
    assert sorted(r["n"] for r in rows) == [1, 2, 3, 4]
    texts = {r["article_text"] for r in rows if r["n"] < 3}
    assert len(texts) == 1 and texts < {"ONE", "TWO"}
    pending = news.select("n", "title", F.lit("").alias("news_summary"), F.lit("S").alias("source"))
    extracted = pages.select("url", F.col("html").alias("page_title"), F.col("html").alias("page_body"))
    assert sorted(r["n"] for r in enrich_articles(pending, extracted).collect()) == [1, 2, 3, 4]


PAGES = [
    # (page, filing text, visible text)
    ("<div><p style='display:none'>x<p>y</p></div>Item 1. Business tail", "y Item 1. Business tail", "x y Item 1. Business tail"),
    ('<li style="display:none">a<li>b</ul><p>tail', "b tail", "a b tail"),
    ("<div style='display:none'>a<span>b</div>c", "c", "a b c"),
    ("<b style='display:none'>a<i>b</b>c</i>d", "c d", "a b c d"),
    ("<main><nav>menu<a>x</main>text", "menu x text", "text"),
    ("<div><header>top</div>text<footer>end", "top text end", "text"),
    ("<nav>a<nav>b</nav>c</nav>d", "a b c d", "d"),
    ("</nav>a</p>b", "a b", "a b"),
    ("<table><tr><td style=display:none>a<td>b<tr><td>c<table><tr><td style='display: none'>d</table>e</table>f", "b c e f", "a b c d e f"),
    ("<p style='display:none'>a<div>b</div>", "b", "a b"),
    ("<p style='display:none'>a<button><p>b</button>c</p>d", "d", "a b c d"),
    ("<div style='display:none'/>a<br style='display:none'>b", "a b", "a b"),
    ("<script>var a = '<nav>';</script>a<style>b</style>c<!-- <nav> -->d", "a c d", "a c d"),
    ("<script>never closed", "", ""),
    ("<dl><dt style='display:none'>a<dd>b</dl>c<select><option style='display:none'>d<option>e</select>", "b c e", "a b c d e"),
    ("a < b and 1<2 <nav", "a < b and 1<2 <nav", "a < b and 1<2 <nav"),
    ("", "", ""),
]


def test_open_elements(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAGES)] + [(len(PAGES), None)], "i int, html string")
    found = df.select("i", F.trim(filing_text(F.col("html"))), visible_text(F.col("html"))).orderBy("i").collect()
    assert [tuple(r)[1:] for r in found] == [p[1:] for p in PAGES] + [(None, None)]


def test_deep_pages_take_one_pass():
    page = "<div>" * 50_000 + "<p style='display:none'>x" + "<b>" * 50_000 + "</div>text"
    assert page_pieces(page, styled=True)[-1] == "text"
