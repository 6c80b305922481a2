"""Text built from URLs, titles, summaries and taxonomy entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import is_blank, squeeze, strip

# The patterns that turn the last part of a URL path into words.
URL_PATH = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^?#]*)"
FILE_EXTENSION = r"(?i)\.[a-z0-9]{2,5}$"
UUID_PATTERN = r"(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"


def url_title(url: Column) -> Column:
    """Readable words from the last path segment of a URL.

    Escapes are decoded before the path is split, a plus sign stays a plus sign,
    and a malformed escape is kept as it stands.
    """
    path = F.regexp_replace(F.regexp_extract(url, URL_PATH, 1), r";[^/]*$", "")
    guarded = F.replace(F.regexp_replace(path, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
    decoded = F.coalesce(F.try_url_decode(guarded), path)
    slug = F.element_at(F.split(F.regexp_replace(decoded, r"/+$", ""), "/"), -1)
    words = F.regexp_replace(F.regexp_replace(slug, FILE_EXTENSION, ""), UUID_PATTERN, "")
    spaced = squeeze(F.regexp_replace(words, r"[-_]+", " "))
    return F.trim(spaced, F.lit(" -"))


def is_web_url(text: Column) -> Column:
    return text.startswith("http://") | text.startswith("https://")


def compose_headline(df: DataFrame) -> Column:
    """The text to classify, from whichever of the text columns exist.

    URL-derived text is joined with the summary, fetched text stands alone, and
    a blank result falls back to title and summary.
    """

    def text_or(names: list[str], default: str) -> Column:
        for name in names:
            if name in df.columns:
                return F.coalesce(F.col(name).cast("string"), F.lit(default))
        return F.lit(default)

    title = text_or(["title", "headline"], "")
    summary = text_or(["news_summary"], "")
    article = text_or(["article_text"], "")
    source = text_or(["article_text_source"], "web")
    fallback = strip(F.concat(title, F.lit(". "), summary))
    from_url = strip(F.concat(article, F.lit(". "), summary))
    chosen = F.when(source == "url", from_url).otherwise(article)
    return F.when(is_blank(chosen), fallback).otherwise(chosen)


def category_search_text(sector: Column, category: Column, description: Column, keywords: Column) -> Column:
    """Embedding text of a category; the keywords appear twice for weight."""
    words = F.array_join(keywords, " ")
    # Fixed value: the layout the category texts have.
    layout = "[%s]\n%s\n\n%s\n\nTérminos clave: %s\n\nRelevantes: %s"
    return strip(F.format_string(layout, sector, category, description, words, words))


def category_sentence(name: Column, description: Column, keywords: Column) -> Column:
    """One-line category text used for sector scoring."""
    # Fixed value: the layout the category sentences have.
    layout = "Sub-industry: %s. Description: %s. Keywords: %s."
    return F.format_string(layout, name, description, F.array_join(keywords, ", "))


def category_id(sector: Column, category: Column) -> Column:
    def slug(col: Column) -> Column:
        return F.replace(F.lower(col), F.lit(" "), F.lit("_"))

    return F.concat(slug(sector), F.lit(":"), slug(category))


def normalize_symbol(symbol: Column) -> Column:
    """Share class written with a dash: BRK.B becomes BRK-B."""
    return F.replace(symbol, F.lit("."), F.lit("-"))
