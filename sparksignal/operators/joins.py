"""Joins with a stated contract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import fail_if
from ..functions.text import is_web_url, url_title


def many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that fails if a key repeats on the right.

    The check is part of every joined value, so it cannot be optimised away.
    """
    keys = list(keys)
    values = [c for c in right.columns if c not in keys]
    grouped = right.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in values]
    )
    checked = grouped.select(
        *keys,
        *[
            fail_if(F.col("_n") > 1, "the right side of a many-to-one join repeats a key", F.col(c)).alias(c)
            for c in values
        ],
    )
    return left.join(checked, keys, "left")


def dimension_join(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left join to a dimension; Spark broadcasts it only while it is small."""
    return facts.join(dimension, key, "left")


def attach_url_text(news: DataFrame, url: str = "title") -> DataFrame:
    """Text derived from the URL itself; rows without a URL get empty text.

    Deriving it is cheaper than any exchange, so it happens in place.
    """
    web = F.coalesce(is_web_url(F.col(url)), F.lit(False))
    return news.withColumns(
        {
            "article_text": F.when(web, url_title(F.col(url))).otherwise(F.lit("")),
            "article_text_source": F.when(web, F.lit("url")).otherwise(F.lit("none")),
        }
    )


def first_per_url(pages: DataFrame, wanted: DataFrame, url: str = "url") -> DataFrame:
    """One landed copy of each page whose URL is in ``wanted`` (url): the one of least content hash.

    Only hashes are compared and grouped; page contents move once, and only those of wanted pages.
    """
    rest = [c for c in pages.columns if c != url]
    asked = pages.join(wanted.select(F.col(url)).distinct(), url, "left_semi")
    hashed = asked.withColumn("_hash", F.xxhash64(*rest))
    least = hashed.groupBy(url).agg(F.min("_hash").alias("_hash"), F.count(F.lit(1)).alias("_n"))
    found = hashed.join(least, [url, "_hash"])
    # Equal copies share the hash; only URLs landed more than once are grouped.
    single = found.where("_n = 1").drop("_hash", "_n")
    several = found.where("_n > 1").drop("_hash", "_n").dropDuplicates([url])
    return single.unionByName(several)


def attach_page_text(
    news: DataFrame, pages: DataFrame, url: str = "title", *, text: Column | None = None
) -> DataFrame:
    """Text of landed pages by URL, else text derived from the URL.

    ``pages`` holds ``url`` and either ``text`` or what the ``text`` expression
    needs; it is evaluated once per referenced URL. A URL may have landed several
    times: one copy counts. Every news row comes back once.
    """
    web = F.coalesce(is_web_url(F.col(url)), F.lit(False))
    asked = news.filter(web).select(F.col(url).alias("url"))
    copies = first_per_url(pages, asked)
    found = copies.select(F.col("url").alias("_key"), (F.col("text") if text is None else text).alias("_text"))
    found = found.filter(F.col("_text") != "")
    # Rows without a URL, often most of the table, take no part in the exchange.
    plain = news.filter(~web).withColumns(
        {"article_text": F.lit(""), "article_text_source": F.lit("none")}
    )
    joined = news.filter(web).join(found, F.col(url) == F.col("_key"), "left")
    fetched = joined.withColumns(
        {
            "article_text": F.coalesce("_text", url_title(F.col(url))),
            "article_text_source": F.when(F.col("_text").isNotNull(), "web").otherwise("url"),
        }
    ).drop("_key", "_text")
    return fetched.unionByName(plain)


def urls_without_text(attached: DataFrame, url: str = "title") -> DataFrame:
    """Counts of all rows and of URL rows that stayed without text."""
    missing = is_web_url(F.col(url)) & (F.col("article_text") == "")
    return attached.agg(
        F.count(F.lit(1)).alias("processed"),
        F.coalesce(F.sum(missing.cast("long")), F.lit(0)).alias("failed"),
    )


def enrich_articles(pending: DataFrame, extracted: DataFrame, summary_chars: int = 500) -> DataFrame:
    """Put the page's title and the start of its body into rows that hold a bare URL.

    ``extracted`` has (url, page_title, page_body) rows; of several with one URL, one
    counts. The source keeps the URL; rows without a page stay as they are.
    """
    pages = first_per_url(extracted, pending.select(F.col("title").alias("url")))
    found = pages.select(
        F.col("url").alias("title"),
        "page_title",
        F.replace(F.trim("page_body"), F.lit("\n"), F.lit(" ")).alias("page_body"),
        F.lit(True).alias("_found"),
    )
    joined = pending.join(found, "title", "left")
    hit = F.col("_found").isNotNull()
    return joined.select(
        *[
            {
                "title": F.coalesce("page_title", "title").alias("title"),
                "news_summary": F.coalesce(
                    F.substring("page_body", 1, summary_chars), F.col("news_summary")
                ).alias("news_summary"),
                "source": F.when(hit, F.concat("source", F.lit("|"), "title"))
                .otherwise(F.col("source"))
                .alias("source"),
            }.get(name, F.col(name))
            for name in pending.columns
        ]
    )
