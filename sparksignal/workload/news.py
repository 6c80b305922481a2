"""Landed news: scans, filters, texts, de-duplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.common import collapse
from ..functions.dates import with_publication_day
from ..functions.html import filing_text, page_body, page_links, page_title, visible_text
from ..functions.sentiment import sentiment_value
from ..functions.text import category_sentence, compose_headline, url_title
from ..operators.dedupe import (
    dedupe_first_wins,
    dedupe_incremental,
    first_by_key,
    sequential_id,
    union_batches,
)
from ..operators.filters import (
    day_range_filter,
    first_rows,
    keyword_filter,
    outlet_filter,
    pending_enrichment,
    raw_keyword_filter,
)
from ..operators.joins import attach_page_text, enrich_articles
from ..operators.keywords import keyword_rows
from ..plans.filings import filing_sections
from ..plans.pipeline import prepare_news
from ..session import work_path
from ..sources.filings import main_documents
from ..sources.news import (
    api_articles,
    event_records,
    feed_entries,
    feed_rows,
    file_manifest,
    parse_api_json,
    ragged_headlines,
    read_news_csv,
    read_ragged_csv,
)
from ..sources.sinks import publish, write_csv
from ..sources.versions import publish_version, read_published
from ..sources.taxonomy import check_dimension, flatten_raw_taxonomy, taxonomy_entries
from .tables import SQL_HEADLINES, headlines, sql_visible, stamp, table

INGEST = "2024-03-01 12:00:00"


def news_csv_roundtrip(spark, sf):
    """Documents written as CSV and read back, line breaks and quotes included."""
    path = work_path(spark, "news-csv")
    write_csv(table(spark, sf, "documents").select("doc_id", "source", "text"), path)
    back = read_news_csv(spark, path, "doc_id long, source string, text string")
    return back.select("doc_id", "source", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


def published_news(spark, sf):
    """Published twice; the second write replaces the first as a whole."""
    path = work_path(spark, "published")
    news = headlines(spark, sf).select("doc_id", "title", "source")
    publish(news.filter("source = 'src1'"), path)
    publish(news, path)
    return spark.read.parquet(path)


def versioned_news(spark, sf):
    """Published ten times, source by source and then whole; readers of the table get the last version."""
    path = work_path(spark, "versions")
    news = headlines(spark, sf).select("doc_id", "title", "source")
    for k in range(9):
        publish_version(news.where(F.col("source") == f"src{k}"), path)
    publish_version(news, path)
    return read_published(spark, path)


def _record_lines(spark, sf):
    """Documents as tab-separated event records; those in Spanish are too short."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    docs = table(spark, sf, "documents").join(pages, F.col("doc_id") == F.col("page_id"), "left")
    when = F.date_format(
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 61), "yyyyMMddHHmmss"
    )
    empty = F.lit("")
    full = F.concat_ws(
        "\t",
        F.col("doc_id"),
        F.when(F.col("lang") == "de", "unknown").otherwise(when),
        F.lit("1"),
        F.col("source"),
        F.coalesce("url", empty),
        *[empty] * 5,
        F.translate(collapse(F.col("text")), " ", ";"),
        F.lit("tail"),
    )
    short = F.concat_ws("\t", F.col("doc_id"), when, F.lit("1"), F.col("source"))
    return docs.select("doc_id", "lang", F.when(F.col("lang") == "es", short).otherwise(full).alias("value"))


def event_record_rows(spark, sf):
    return event_records(_record_lines(spark, sf), INGEST).drop("lang")


def event_record_rows_by_keyword(spark, sf):
    lines = _record_lines(spark, sf).select("doc_id", "value")
    return event_records(lines, INGEST, keywords=["SRC1\t", "src7\thttps"]).select("doc_id", "title", "day")


def raw_record_filter(spark, sf):
    lines = table(spark, sf, "documents").select(
        "doc_id", F.concat_ws("\t", "source", "lang", "text").alias("value")
    )
    return raw_keyword_filter(lines, ["SRC1\t", " la le "]).select("doc_id")


def event_file_manifest(spark, sf):
    """Orders as listed event files, one per order."""
    orders = table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "P", ".export.csv.zip").otherwise(".gkg.csv.zip")
    when = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyyMMddHHmmss")
    name = F.concat(F.when(F.col("o_orderpriority") == "5-LOW", "latest").otherwise(when), kind)
    size = F.when(F.col("o_orderkey") % 7 == 0, "-").otherwise(F.col("o_orderkey").cast("string"))
    line = F.concat(size, F.lit(" h "), F.lit("http://files.example.org/"), F.col("o_orderkey"), F.lit("/"), name)
    files = file_manifest(orders.select(line.alias("value")), "1995-03-01", "1996-02-29")
    return files.select(stamp("file_ts").alias("file_ts"), "url", "size_bytes")


def feed_xml_entries(spark, sf):
    """Headlines wrapped as feed documents and read back."""
    when = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 3600)
    item = F.struct(
        F.concat(F.lit("  "), "title", F.lit(" & more <")).alias("title"),
        F.col("news_summary").alias("description"),
        F.when(F.col("source") == "src3", F.lit(None))
        .otherwise(F.concat(F.date_format(when, "dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .alias("pubDate"),
        F.date_format(when, "yyyy-MM-dd").alias("updated"),
    )
    doc = F.to_xml(F.struct(F.struct(F.array(item).alias("item")).alias("channel")))
    documents = headlines(spark, sf).select("doc_id", F.col("source").alias("feed_name"), doc.alias("xml"))
    return feed_rows(feed_entries(documents), INGEST)


def api_json_articles(spark, sf):
    """Headlines wrapped as API responses and read back."""
    article = F.struct(
        F.when(F.col("source") == "src2", F.lit(None)).otherwise(F.concat(F.lit(" "), "title")).alias("title"),
        F.col("news_summary").alias("description"),
        F.date_format(F.timestamp_seconds(F.col("doc_id") * 7261), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        F.when(F.col("source") == "src5", F.create_map(F.lit("id"), F.col("source")))
        .otherwise(F.create_map(F.lit("name"), F.col("source")))
        .alias("source"),
    )
    documents = headlines(spark, sf).select(
        "doc_id", F.to_json(F.struct(F.array(article).alias("articles"))).alias("json")
    )
    return api_articles(parse_api_json(documents), INGEST)


def _taxonomy_json(spark, sf, nested):
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    ident = F.concat(F.lit("n"), "n_nationkey")
    if nested:
        subs = joined.groupBy("r_regionkey", "r_name").agg(
            F.collect_list(F.struct(ident.alias("id"), F.col("n_name").alias("nombre"))).alias("subindustrias")
        )
        industry = F.struct(F.col("r_name").alias("id"), F.col("r_name").alias("nombre"), "subindustrias")
        return subs.select(F.to_json(F.struct(F.array(industry).alias("industrias"))).alias("json"))
    sector = F.when(F.col("r_name") == "ASIA", F.lit(None)).otherwise(F.col("r_name"))
    category = F.struct(ident.alias("id"), sector.alias("sector"), F.col("n_name").alias("categoria"))
    return joined.select(F.to_json(F.struct(F.array(category).alias("categorias"))).alias("json"))


def taxonomy_nested(spark, sf):
    return check_dimension(taxonomy_entries(_taxonomy_json(spark, sf, nested=True)))


def taxonomy_flat(spark, sf):
    return check_dimension(taxonomy_entries(_taxonomy_json(spark, sf, nested=False)))


def raw_taxonomy(spark, sf):
    """A raw document per part type: brands as categories, notes included."""
    part = table(spark, sf, "part")
    detail = F.to_json(
        F.struct(
            F.concat(F.lit("About "), "p_brand").alias("description"),
            F.sort_array(F.collect_set("p_size")).cast("array<string>").alias("keywords"),
        )
    )
    brands = part.groupBy("p_type", "p_brand").agg(detail.alias("_detail"))
    entry = F.concat(F.lit('"'), "p_brand", F.lit('":'), "_detail")
    bodies = brands.groupBy("p_type").agg(F.array_join(F.sort_array(F.collect_list(entry)), ",").alias("_body"))
    return bodies.select(
        F.concat(
            F.lit('{"_note":{"x":{"description":"skip"}},"'),
            "p_type",
            F.lit('":{"_note":{"description":"skip"},"plain":"skip",'),
            "_body",
            F.lit("}}"),
        ).alias("json")
    )


def taxonomy_flattened(spark, sf):
    flat = flatten_raw_taxonomy(raw_taxonomy(spark, sf))
    return flat.select(
        "id",
        "sector",
        "categoria",
        "descripcion",
        F.array_join("keywords", ",").alias("keywords"),
        "keywords_count",
        "texto_para_embedding",
        category_sentence(F.col("categoria"), F.col("descripcion"), F.col("keywords")).alias("sentence"),
    )


def ragged_outlet_headlines(spark, sf):
    """Headline pieces split at commas, written as lines and read back as ragged rows."""
    path = work_path(spark, "ragged")
    text = collapse(F.translate(F.col("text"), '"', " "))
    line = F.when(
        F.col("lang") == "es", F.concat_ws(",", F.col("doc_id"), "source")
    ).otherwise(F.concat(F.col("doc_id"), F.lit(","), text, F.lit(', '), F.upper("source"), F.lit(" ")))
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    rows = ragged_headlines(read_ragged_csv(spark, path))
    kept = outlet_filter(rows, {"src1", "src7"})
    return kept.select("date", "outlet", F.md5("headline").alias("headline_md5"))


def main_filing_documents(spark, sf):
    """Pages as filing files: one filing per host, pages in French are report parts."""
    host = F.regexp_extract("url", r"^https?://([^/]+)/", 1)
    prefix = F.when(F.col("url").contains("/fr/"), "R").otherwise("doc")
    files = table(spark, sf, "pages").select(
        host.alias("filing"),
        F.concat(host, F.lit("/"), prefix, F.col("page_id"), F.lit(".htm")).alias("path"),
        F.length("html").cast("long").alias("length"),
    )
    return main_documents(files)


def keyword_news(spark, sf):
    news = table(spark, sf, "documents").select("doc_id", F.col("text").alias("title"), F.col("source").alias("news_summary"))
    return keyword_filter(news, ["SRC7 ", " ", "Von Der"]).select("doc_id", "news_summary")


def keyword_table_news(spark, sf):
    """Orders as news that name their customer and parts, against all names of parts and customers, with what they name."""
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    padded = F.concat(F.lit(" \t"), F.upper("keyword"), F.lit("\n"))
    names = part.select(F.col("p_name").alias("keyword")).unionByName(customer.select(F.col("c_name").alias("keyword")))
    blank = spark.createDataFrame([(" ",), (None,)], "keyword string")
    asked = names.select(padded.alias("keyword")).unionByName(blank)
    items = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    sold = items.groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_name")), ", ").alias("news_summary"))
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    news = orders.join(sold, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", F.concat(F.lit("Order by "), "c_name").alias("title"), "news_summary"
    )
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("news_summary", F.lit("")))
    return keyword_rows(news, text, asked).select("o_orderkey", F.array_join("matched", "|").alias("matched"))


def raw_keyword_table(spark, sf):
    """Raw lines of whole documents against all words of the benchmark and of the taxonomy, blanks around them kept."""
    lines = table(spark, sf, "documents").select("doc_id", F.concat_ws("\t", "source", "lang", "text").alias("value"))
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", r"[ \n]")).alias("keyword")).distinct()
    names = table(spark, sf, "customer").select("c_name").union(table(spark, sf, "part").select("p_name"))
    asked = words.select(F.concat(F.lit(" "), "keyword", F.lit(" ")).alias("keyword")).where("keyword <> '  '").unionByName(
        names.toDF("keyword")
    )
    return keyword_rows(lines, F.col("value"), asked, trim=False).select(
        "doc_id", F.size("matched").cast("long").alias("n_matched"), F.md5(F.array_join("matched", "|")).alias("matched_md5")
    )


def keyword_summaries(spark, sf):
    news = headlines(spark, sf).withColumn("news_summary", F.col("source"))
    return keyword_filter(news, ["src1"], match_title=False).select("doc_id")


def outlet_news(spark, sf):
    news = table(spark, sf, "documents").select(
        F.concat(F.lit(" "), F.col("doc_id"), F.lit("\n")).alias("date"),
        F.col("text").alias("headline"),
        F.concat(F.lit(" "), F.upper("source"), F.lit(" ")).alias("outlet"),
    )
    kept = outlet_filter(news, {"src3", "src11"})
    return kept.select("date", "outlet", F.md5("headline").alias("headline_md5"), F.length("headline").alias("chars"))


def orders_in_range(spark, sf):
    kept = day_range_filter(table(spark, sf, "orders"), "1995-03-05", "1996-01-17", "o_orderdate")
    return kept.select("o_orderkey", stamp("o_orderdate").alias("at"))


def publication_times(spark, sf):
    """Order dates written in several date styles and parsed back."""
    when = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.pmod("o_orderkey", F.lit(1440)).cast("int")
    )
    day, clock = F.date_format(when, "EEE, dd MMM yyyy"), F.date_format(when, "HH:mm:ss")

    def text(layout, tail=""):
        return F.concat(F.date_format(when, layout), F.lit(tail))

    styles = [
        F.concat(day, F.lit(" "), clock, F.lit(" +0200")),
        F.concat(day, F.lit(" "), clock, F.lit(" EST")),
        F.concat(day, F.lit(" "), clock, F.lit(" -05:30")),
        F.concat(day, F.lit(" "), clock, F.lit(" CET")),
        text("yyyy-MM-dd"),
        text("yyyy-MM-dd'T'HH:mm:ss", "Z"),
        text("EEE, d MMM yy H:mm:ss", " GMT"),
        text("MMMM d, yyyy h:mm a"),
        text("MMM. d, yyyy HH:mm"),
        text("EEE MMM d HH:mm:ss yyyy"),
        text("dd-MMM-yyyy HH:mm"),
        text("M/d/yyyy h:mm a"),
        text("yyyy-MM-dd h:mm a"),
        text("d MMMM yyyy"),
        text("yyyyMMdd"),
        F.lit("soon: maybe"),
    ]
    style = F.pmod(F.floor(F.col("o_orderkey") / 3), F.lit(len(styles))).cast("int")
    raw = F.lit(None)
    for k, written in enumerate(styles):
        raw = F.when(style == k, written).otherwise(raw)
    rows = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return with_publication_day(rows, F.col("raw"), INGEST).drop("raw")


def pending_pages(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id",
        F.col("url").alias("title"),
        F.when(F.col("url").startswith("https"), "GDELT").otherwise("RSS").alias("source"),
    )
    return pending_enrichment(pages)


def first_pending_pages(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("url").alias("title"), F.lit("GDELT").alias("source"))
    return pending_enrichment(pages, order="page_id", limit=25)


def latest_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", (-F.col("n_chars")).alias("order"), F.col("doc_id").alias("id"))
    ranked = docs.select(F.struct("order", "doc_id").alias("order"), "id")
    return first_rows(ranked, "order", 20).select("id")


def url_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", url_title(F.col("url")).alias("title"))


def composed_headlines(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    news = docs.join(labels, "doc_id", "left").select(
        "doc_id",
        F.col("source").alias("title"),
        F.col("lang").alias("news_summary"),
        F.when(F.col("quality") == 1, F.col("text")).when(F.col("quality") == 0, "  ").alias("article_text"),
        F.when(F.col("toxic") == 1, "url").when(F.col("toxic") == 0, "web").alias("article_text_source"),
    )
    text = compose_headline(news)
    return news.select("doc_id", F.md5(text).alias("headline_md5"), F.length(text).alias("chars"))


def prepared_news(spark, sf):
    """Documents dated by the event of the same number, numbered in time order."""
    events = table(spark, sf, "events").select("event_id", "ts")
    news = headlines(spark, sf).join(events, F.col("doc_id") == F.col("event_id")).select(
        "doc_id",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.date_format("ts", "HH:mm").alias("hour_minute"),
        "title",
        "news_summary",
    )
    prepared = prepare_news(news, "2024-01-01", "2024-01-31", order=["published_at", "doc_id"])
    return prepared.select("doc_id", "article_id", "headline", stamp("published_at").alias("published_at"))


def _linked_news(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url")
    docs = table(spark, sf, "documents").select("doc_id", "source")
    return docs.join(pages, F.col("doc_id") == F.col("page_id"), "left").select(
        "doc_id", F.coalesce("url", "source").alias("title"), F.lit("").alias("news_summary"), F.lit("GDELT").alias("source")
    )


def attached_page_text(spark, sf):
    """Text of landed https pages; other URLs give their own words."""
    pages = table(spark, sf, "pages").filter(F.col("url").startswith("https"))
    return attach_page_text(_linked_news(spark, sf), pages, text=visible_text(F.col("html"))).select(
        "doc_id", "article_text_source", F.md5("article_text").alias("text_md5")
    )


def enriched_articles(spark, sf):
    pages = table(spark, sf, "pages").filter(F.col("url").startswith("https"))
    extracted = pages.select(
        "url", page_title(F.col("html")).alias("page_title"), page_body(F.col("html")).alias("page_body")
    )
    pending = pending_enrichment(_linked_news(spark, sf))
    return enrich_articles(pending, extracted)


def _as_html(text):
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _unclosed_pages(spark, sf):
    """Whole documents in pages that leave hidden elements and menus open."""
    docs = table(spark, sf, "documents")
    text, lang = _as_html(F.coalesce("text", F.lit(""))), F.coalesce("lang", F.lit("?"))
    parts = [
        ("<div><p style='display:none'>gone <b>gone<p>", lang, "</div><section>", text),
        ("<ul><li style=\"color:red; DISPLAY: none\">gone<li>", lang, "</ul></b><p>", text),
        ("<main><nav style='display:none'><a>gone</main><p>", lang, "<section>", text),
        ("<table><tr><td style=display:none>gone<td>", lang, "<tr><td>", text, "</table><header style='display:none'>gone"),
    ]
    pages = [F.concat(*[F.lit(p) if isinstance(p, str) else p for p in page]) for page in parts]
    html = F.get(F.array(*pages), F.pmod("doc_id", F.lit(len(pages))).cast("int"))
    return docs.select("doc_id", html.alias("html"))


def unclosed_hidden_filings(spark, sf):
    """Filing text of pages with hidden elements that nothing closes."""
    text = F.trim(filing_text(F.col("html")))
    return _unclosed_pages(spark, sf).select("doc_id", F.length(text).alias("chars"), F.md5(text).alias("text_md5"))


def unclosed_block_pages(spark, sf):
    """Visible text of pages whose menus are closed by the elements around them; styles hide nothing here."""
    text = F.replace(F.replace(visible_text(F.col("html")), F.lit("\n"), F.lit("")), F.lit(" "), F.lit(""))
    return _unclosed_pages(spark, sf).select("doc_id", F.length(text).alias("chars"), F.md5(text).alias("text_md5"))


def page_visible_text(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", visible_text(F.col("html")).alias("text"))
    return pages.select("page_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


def page_link_edges(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", F.explode(page_links(F.col("url"), F.col("html"))).alias("target"))


def filing_html(spark, sf):
    """Documents as filings with a contents list, a hidden block and non-breaking blanks."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    safe = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    ending = F.when(F.col("toxic") == 1, "").otherwise("<h2>Item&nbsp;1A. Risk Factors</h2><p>Many.</p>")
    html = F.concat(
        F.lit('<html><body><div style="DISPLAY: none">a<div>Item 1. Business</div>b</div>'),
        F.lit("<p>Item 1. Business</p><p>Item 1A. Risk Factors</p><h1>ITEM 1.&nbsp;Business</h1>\n<p>"),
        safe,
        F.lit("</p>"),
        ending,
        F.lit("</body></html>"),
    )
    return docs.join(labels, "doc_id", "left").select("doc_id", html.alias("html"))


def business_sections(spark, sf):
    return filing_sections(filing_html(spark, sf)).select(
        "doc_id", F.md5("section").alias("section_md5"), F.length("section").alias("chars")
    )


def deduped_headlines(spark, sf):
    return dedupe_first_wins(headlines(spark, sf).drop("text"), ["doc_id"])


def newly_seen_headlines(spark, sf):
    """All documents against the labelled ones, which count as stored already."""
    news = headlines(spark, sf).drop("text")
    stored = news.join(table(spark, sf, "labels"), "doc_id", "left_semi")
    return dedupe_incremental(news, stored, ["doc_id"])


def distinct_titles(spark, sf):
    return first_by_key(headlines(spark, sf).select("title", "doc_id", "source"), ["title"], ["doc_id"])


def united_batches(spark, sf):
    news = headlines(spark, sf)
    pages = table(spark, sf, "pages").select(F.lit("web").alias("source"), F.col("page_id").alias("id"))
    docs = news.select(F.col("doc_id").alias("id"), "source")
    turns = table(spark, sf, "conversations").select("conv_id", "role")
    return union_batches(docs, pages, turns.select(F.col("conv_id").alias("id"), F.col("role").alias("source")))


def numbered_events(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return sequential_id(events, ["value", "event_id"]).select("event_id", "article_id")


def sentiment_values(spark, sf):
    """Value from scores, with every document label read as model scores."""
    scored = table(spark, sf, "labels").select(
        "doc_id",
        (F.col("quality") * 0.75).alias("score_positive"),
        (F.col("toxic") * 0.5).alias("score_negative"),
    )
    return scored.select("doc_id", sentiment_value(scored).alias("sentiment_value"))


QUERIES = {
    f.__name__: f
    for f in (
        news_csv_roundtrip,
        published_news,
        versioned_news,
        event_record_rows,
        event_record_rows_by_keyword,
        raw_record_filter,
        event_file_manifest,
        feed_xml_entries,
        api_json_articles,
        taxonomy_nested,
        taxonomy_flat,
        taxonomy_flattened,
        ragged_outlet_headlines,
        main_filing_documents,
        keyword_news,
        keyword_table_news,
        raw_keyword_table,
        keyword_summaries,
        outlet_news,
        orders_in_range,
        publication_times,
        pending_pages,
        first_pending_pages,
        latest_documents,
        url_titles,
        composed_headlines,
        prepared_news,
        attached_page_text,
        enriched_articles,
        page_visible_text,
        unclosed_hidden_filings,
        unclosed_block_pages,
        page_link_edges,
        business_sections,
        deduped_headlines,
        newly_seen_headlines,
        distinct_titles,
        united_batches,
        numbered_events,
        sentiment_values,
    )
}

_COLLAPSED = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
_DOC_TIME = "(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 61))"
_URL_TITLE = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  list_last(string_split(regexp_replace(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)', 1),
  '/+$', ''), '/')), '(?i)\.[a-z0-9]{2,5}$', ''),
  '(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}', '', 'g'), '[-_]+', ' ', 'g'), '\s+', ' ', 'g'), ' -')"""
_RECORDS = f"""
records AS (
  SELECT doc_id, source, lang, coalesce(url, '') AS url, {_DOC_TIME} AS t,
         replace({_COLLAPSED}, ' ', ';') AS orgs
  FROM documents LEFT JOIN pages ON doc_id = page_id)
"""
_LINKED = """
linked AS (SELECT doc_id, source AS doc_source, url, html, coalesce(url, source) AS title
           FROM documents LEFT JOIN pages ON doc_id = page_id)
"""
_RAW_TAXONOMY = """
brands AS (
  SELECT p_type AS sector, p_brand AS categoria, 'About ' || p_brand AS descripcion,
         list_sort(list_distinct(list(p_size))) AS sizes FROM part GROUP BY 1, 2),
flat AS (
  SELECT lower(replace(sector, ' ', '_')) || ':' || lower(replace(categoria, ' ', '_')) AS id, sector, categoria,
         descripcion, sizes, CAST(len(sizes) AS INTEGER) AS keywords_count FROM brands)
"""

ORACLES = {
    "news_csv_roundtrip": "SELECT doc_id, source, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS chars FROM documents",
    "published_news": f"WITH {SQL_HEADLINES} SELECT doc_id, title, source FROM headlines",
    "event_record_rows": f"""
WITH {_RECORDS}
SELECT doc_id,
       CASE WHEN lang = 'de' THEN '2024-03-02' ELSE strftime(t, '%Y-%m-%d') END AS day,
       CASE WHEN lang = 'de' THEN '00:00' ELSE strftime(t, '%H:%M') END AS hour_minute,
       url AS title, orgs AS news_summary, 'GDELT' AS source
FROM records WHERE lang <> 'es' AND url <> ''""",
    "event_record_rows_by_keyword": f"""
WITH {_RECORDS}
SELECT doc_id, url AS title, CASE WHEN lang = 'de' THEN '2024-03-02' ELSE strftime(t, '%Y-%m-%d') END AS day
FROM records WHERE lang <> 'es' AND url <> '' AND (source = 'src1' OR (source = 'src7' AND url LIKE 'https%'))""",
    "raw_record_filter": """
SELECT doc_id FROM documents
WHERE contains(lower(concat_ws(chr(9), source, lang, text)), 'src1' || chr(9))
   OR contains(lower(concat_ws(chr(9), source, lang, text)), ' la le ')""",
    "event_file_manifest": """
SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS file_ts,
       'http://files.example.org/' || o_orderkey || '/' || strftime(o_orderdate, '%Y%m%d%H%M%S') || '.gkg.csv.zip' AS url,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS size_bytes
FROM orders
WHERE o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW'
  AND o_orderdate >= TIMESTAMP '1995-03-01' AND o_orderdate < TIMESTAMP '1996-03-01'""",
    "feed_xml_entries": f"""
WITH {SQL_HEADLINES}, dated AS (SELECT *, TIMESTAMP '2024-01-01' + to_hours(doc_id) AS t FROM headlines)
SELECT doc_id, CASE WHEN source = 'src3' THEN strftime(t + INTERVAL 1 DAY, '%Y-%m-%d')
                    ELSE strftime(t, '%Y-%m-%d') END AS day,
       CASE WHEN source = 'src3' THEN '00:00' ELSE strftime(t, '%H:%M') END AS hour_minute,
       title || ' & more <' AS title, news_summary, source
FROM dated""",
    "api_json_articles": f"""
WITH {SQL_HEADLINES}, dated AS (SELECT *, TIMESTAMP '1970-01-01' + to_seconds(doc_id * 7261) AS t FROM headlines)
SELECT doc_id, strftime(t, '%Y-%m-%d') AS day, strftime(t, '%H:%M') AS hour_minute, title, news_summary,
       CASE WHEN source = 'src5' THEN 'NewsAPI' ELSE source END AS source
FROM dated WHERE source <> 'src2' AND title <> ''""",
    "taxonomy_nested": """
SELECT r_name AS industria_id, 'n' || n_nationkey AS subindustria_id, n_name AS subindustria_nombre
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "taxonomy_flat": """
SELECT CASE WHEN r_name = 'ASIA' THEN 'sin_sector' ELSE r_name END AS industria_id,
       'n' || n_nationkey AS subindustria_id, n_name AS subindustria_nombre
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "taxonomy_flattened": f"""
WITH {_RAW_TAXONOMY}
SELECT id, sector, categoria, descripcion, array_to_string(sizes, ',') AS keywords, keywords_count,
       '[' || sector || ']' || chr(10) || categoria || chr(10) || chr(10) || descripcion || chr(10) || chr(10)
       || 'Términos clave: ' || array_to_string(sizes, ' ') || chr(10) || chr(10)
       || 'Relevantes: ' || array_to_string(sizes, ' ') AS texto_para_embedding,
       'Sub-industry: ' || categoria || '. Description: ' || descripcion || '. Keywords: '
       || array_to_string(sizes, ', ') || '.' AS sentence
FROM flat""",
    "ragged_outlet_headlines": r"""
SELECT CAST(doc_id AS VARCHAR) AS date, source AS outlet,
       md5(trim(regexp_replace(replace(replace(text, '"', ' '), ',', ' '), '\s+', ' ', 'g'))) AS headline_md5
FROM documents WHERE lang <> 'es' AND source IN ('src1', 'src7')""",
    "main_filing_documents": r"""
WITH files AS (
  SELECT regexp_extract(url, '^https?://([^/]+)/', 1) AS filing,
         filing || '/' || (CASE WHEN contains(url, '/fr/') THEN 'R' ELSE 'doc' END) || page_id || '.htm' AS path,
         length(html) AS length, contains(url, '/fr/') AS part FROM pages)
SELECT filing, path, length FROM files WHERE NOT part
QUALIFY row_number() OVER (PARTITION BY filing ORDER BY length DESC, path) = 1""",
    "keyword_news": """
SELECT doc_id, source AS news_summary FROM documents
WHERE contains(lower(text || ' ' || source), 'src7') OR contains(lower(text || ' ' || source), 'von der')""",
    "keyword_table_news": r"""
WITH asked AS (SELECT DISTINCT lower(k) AS k FROM (SELECT p_name AS k FROM part UNION ALL SELECT c_name FROM customer)),
sold AS (SELECT l_orderkey, string_agg(p_name, ', ' ORDER BY p_name) AS s
         FROM (SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1),
news AS (SELECT o_orderkey, lower('Order by ' || c_name || ' ' || coalesce(s, '')) AS t
         FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN sold ON o_orderkey = l_orderkey)
SELECT o_orderkey, string_agg(k, '|' ORDER BY k) AS matched FROM news JOIN asked ON contains(t, k) GROUP BY 1""",
    "raw_keyword_table": r"""
WITH asked AS (
  SELECT DISTINCT lower(' ' || k || ' ') AS k FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS k FROM benchmark) WHERE k <> ''
  UNION SELECT lower(p_name) FROM part UNION SELECT lower(c_name) FROM customer),
lines AS (SELECT doc_id, lower(concat_ws(chr(9), source, lang, text)) AS t FROM documents)
SELECT doc_id, count(*) AS n_matched, md5(string_agg(k, '|' ORDER BY k)) AS matched_md5
FROM lines JOIN asked ON contains(t, k) GROUP BY 1""",
    "keyword_summaries": "SELECT doc_id FROM documents WHERE contains(lower(source), 'src1')",
    "outlet_news": f"""
SELECT CAST(doc_id AS VARCHAR) AS date, source AS outlet, md5({_COLLAPSED}) AS headline_md5,
       CAST(length({_COLLAPSED}) AS INTEGER) AS chars
FROM documents WHERE source IN ('src3', 'src11')""",
    "orders_in_range": """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "at" FROM orders
WHERE o_orderdate >= TIMESTAMP '1995-03-05' AND o_orderdate < TIMESTAMP '1996-01-18'""",
    "publication_times": """
WITH timed AS (
  SELECT o_orderkey, o_orderkey // 3 % 16 AS k, o_orderdate + to_minutes(o_orderkey % 1440) AS t FROM orders),
zoned AS (
  SELECT *, CASE k WHEN 0 THEN t - INTERVAL 2 HOUR WHEN 1 THEN t + INTERVAL 5 HOUR
                   WHEN 2 THEN t + INTERVAL 330 MINUTE ELSE t END AS u FROM timed)
SELECT o_orderkey,
       CASE WHEN k IN (4, 13, 14) THEN strftime(u + INTERVAL 1 DAY, '%Y-%m-%d')
            WHEN k = 15 THEN '2024-03-02' ELSE strftime(u, '%Y-%m-%d') END AS day,
       CASE WHEN k IN (4, 13, 14, 15) THEN '00:00' ELSE strftime(u, '%H:%M') END AS hour_minute
FROM zoned""",
    "pending_pages": "SELECT page_id, url AS title, 'GDELT' AS source FROM pages WHERE url LIKE 'https%'",
    "first_pending_pages": "SELECT page_id, url AS title, 'GDELT' AS source FROM pages ORDER BY page_id LIMIT 25",
    "latest_documents": "SELECT doc_id AS id FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20",
    "url_titles": f"SELECT page_id, {_URL_TITLE} AS title FROM pages",
    "composed_headlines": r"""
WITH news AS (
  SELECT doc_id, source AS title, lang AS summary,
         coalesce(CASE WHEN quality = 1 THEN text WHEN quality = 0 THEN '  ' END, '') AS article,
         coalesce(CASE WHEN toxic = 1 THEN 'url' WHEN toxic = 0 THEN 'web' END, 'web') AS src
  FROM documents LEFT JOIN labels USING (doc_id)),
chosen AS (
  SELECT doc_id, regexp_replace(title || '. ' || summary, '^\s+|\s+$', '', 'g') AS fallback,
         CASE WHEN src = 'url' THEN regexp_replace(article || '. ' || summary, '^\s+|\s+$', '', 'g')
              ELSE article END AS pick FROM news),
done AS (SELECT doc_id, CASE WHEN regexp_matches(pick, '\S') THEN pick ELSE fallback END AS headline FROM chosen)
SELECT doc_id, md5(headline) AS headline_md5, CAST(length(headline) AS INTEGER) AS chars FROM done""",
    "prepared_news": f"""
WITH {SQL_HEADLINES}, dated AS (
  SELECT doc_id, title || '. ' || news_summary AS headline, date_trunc('minute', ts) AS t
  FROM headlines JOIN events ON doc_id = event_id)
SELECT doc_id, row_number() OVER (ORDER BY t, doc_id) - 1 AS article_id, headline,
       strftime(t, '%Y-%m-%d %H:%M:%S') AS published_at
FROM dated WHERE t >= TIMESTAMP '2024-01-01' AND t < TIMESTAMP '2024-02-01'""",
    "attached_page_text": f"""
WITH {_LINKED}, texts AS (
  SELECT doc_id, url, {_URL_TITLE} AS words, {sql_visible("html")} AS page FROM linked)
SELECT doc_id,
       CASE WHEN url IS NULL THEN 'none' WHEN url LIKE 'https%' AND page <> '' THEN 'web' ELSE 'url' END AS article_text_source,
       md5(CASE WHEN url IS NULL THEN '' WHEN url LIKE 'https%' AND page <> '' THEN page ELSE words END) AS text_md5
FROM texts""",
    "enriched_articles": rf"""
WITH {_LINKED}, found AS (
  SELECT doc_id, url, url LIKE 'https%' AS hit,
         regexp_extract(html, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1) AS raw_title,
         {sql_visible("regexp_replace(html, '(?is)^.*?</head" + chr(92) + "s*>', '')")} AS body
  FROM linked WHERE url IS NOT NULL),
named AS (
  SELECT *, regexp_replace(replace(replace(replace(replace(raw_title, '&copy;', '©'), '&middot;', '·'),
            '&quot;', '"'), '&amp;', '&'), '^\s+|\s+$', '', 'g') AS page_title FROM found)
SELECT doc_id, CASE WHEN hit AND page_title <> '' THEN page_title ELSE url END AS title,
       CASE WHEN hit AND body <> '' THEN substr(replace(body, chr(10), ' '), 1, 500) ELSE '' END AS news_summary,
       CASE WHEN hit THEN 'GDELT|' || url ELSE 'GDELT' END AS source
FROM named""",
    "unclosed_hidden_filings": r"""
SELECT doc_id, length(t) AS chars, md5(t) AS text_md5
FROM (SELECT doc_id, trim(coalesce(lang, '?') || ' ' || trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) AS t FROM documents)""",
    "unclosed_block_pages": r"""
SELECT doc_id, length(t) AS chars, md5(t) AS text_md5
FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'gonegone' WHEN 2 THEN '' ELSE 'gone' END || coalesce(lang, '?')
             || regexp_replace(coalesce(text, ''), '\s+', '', 'g') AS t FROM documents)""",
    "page_visible_text": f"""
WITH texts AS (SELECT page_id, {sql_visible("html")} AS text FROM pages)
SELECT page_id, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS chars FROM texts""",
    "page_link_edges": r"""
WITH found AS (
  SELECT page_id, regexp_extract(url, '^https?://[^/]+') AS host,
         unnest(list_distinct(regexp_extract_all(html, '<a href="([^"]*)"', 1))) AS href FROM pages)
SELECT page_id, host || href AS target FROM found""",
    "business_sections": r"""
SELECT doc_id, md5(section) AS section_md5, CAST(length(section) AS INTEGER) AS chars
FROM (SELECT doc_id, trim(regexp_replace('ITEM 1. Business ' || text, '\s+', ' ', 'g')) AS section
      FROM documents LEFT JOIN labels USING (doc_id) WHERE toxic IS NULL OR toxic <> 1)""",
    "deduped_headlines": f"""
WITH {SQL_HEADLINES}
SELECT doc_id, title, news_summary, source, md5(title || '|' || source) AS dedupe_key FROM headlines
QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY doc_id) = 1""",
    "newly_seen_headlines": f"""
WITH {SQL_HEADLINES}, keyed AS (SELECT *, md5(title || '|' || source) AS dedupe_key FROM headlines)
SELECT doc_id, title, news_summary, source, dedupe_key FROM keyed
WHERE dedupe_key NOT IN (SELECT dedupe_key FROM keyed JOIN labels USING (doc_id))
QUALIFY row_number() OVER (PARTITION BY dedupe_key ORDER BY doc_id) = 1""",
    "distinct_titles": f"""
WITH {SQL_HEADLINES}
SELECT title, doc_id, source FROM headlines QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1""",
    "united_batches": """
SELECT doc_id AS id, source FROM documents UNION ALL SELECT page_id, 'web' FROM pages
UNION ALL SELECT conv_id, role FROM conversations""",
    "numbered_events": "SELECT event_id, row_number() OVER (ORDER BY value, event_id) - 1 AS article_id FROM events",
    "sentiment_values": "SELECT doc_id, quality * 0.75::DOUBLE - toxic * 0.5::DOUBLE AS sentiment_value FROM labels",
}
ORACLES["versioned_news"] = ORACLES["published_news"]
