"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.common import collapse, is_blank, strip
from ..functions.dates import in_day_range
from .keywords import keyword_rows

# Outlets whose headlines are kept by default.
DEFAULT_OUTLETS = {"wsj"}

# Longer keyword lists are looked for by an automaton, in one pass.
FEW_KEYWORDS = 32

DEFAULT_THRESHOLD = 0.55
LEGACY_THRESHOLD = -35.0


def contains_any(text: Column, keywords: Iterable[str]) -> Column:
    """True where the lower-cased text contains one of the lower-cased keywords."""
    lowered = F.lower(text)
    tests = [lowered.contains(k.lower()) for k in keywords]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def keyword_filter(
    df: DataFrame,
    keywords: Sequence[str] | DataFrame,
    *,
    title: str = "title",
    summary: str = "news_summary",
    match_title: bool = True,
    match_summary: bool = True,
) -> DataFrame:
    """Rows whose title and/or summary contain a keyword.

    Keywords are trimmed and blank ones ignored; without any keyword there is
    no output. They are a list or a table's first column, of any length.
    """
    parts = [F.coalesce(F.col(title), F.lit(""))] * match_title
    parts += [F.coalesce(F.col(summary), F.lit(""))] * match_summary
    text = F.concat_ws(" ", *parts) if parts else F.lit("")
    if isinstance(keywords, DataFrame):
        return _by_table(df, text, keywords, trim=True)
    words = [k.strip() for k in keywords if k.strip()]
    if not words:
        return df.limit(0)
    return df.filter(contains_any(text, words)) if len(words) <= FEW_KEYWORDS else _by_table(df, text, words, trim=True)


def raw_keyword_filter(df: DataFrame, keywords: Sequence[str] | DataFrame | None, line: str = "value") -> DataFrame:
    """Raw records that contain a keyword anywhere.

    Keywords are taken as they are, so an empty one matches every record; no
    keyword list at all, or an empty one, keeps everything. An empty table does not.
    """
    if isinstance(keywords, DataFrame):
        return _by_table(df, F.col(line), keywords, trim=False)
    if not keywords:
        return df
    few = len(keywords) <= FEW_KEYWORDS
    return df.filter(contains_any(F.col(line), keywords)) if few else _by_table(df, F.col(line), keywords, trim=False)


def _by_table(df: DataFrame, text: Column, keywords: Sequence[str] | DataFrame, trim: bool) -> DataFrame:
    return keyword_rows(df, text, keywords, out="_matched", trim=trim).drop("_matched")


def outlet_filter(
    df: DataFrame, outlets: Iterable[str] = DEFAULT_OUTLETS, outlet: str = "outlet"
) -> DataFrame:
    """Rows of permitted outlets, with date, headline and outlet cleaned."""
    name = F.lower(strip(F.col(outlet)))
    kept = df.filter(name.isin(sorted(outlets)))
    return kept.withColumns(
        {
            "date": strip(F.col("date")),
            "headline": collapse(F.col("headline")),
            outlet: name,
        }
    )


def day_range_filter(df: DataFrame, start_date: str, end_date: str, time: str = "published_at") -> DataFrame:
    """Rows from the start of the first day to the end of the last one."""
    return df.filter(in_day_range(F.col(time), start_date, end_date, df.schema[time].dataType.simpleString()))


def pending_enrichment(
    df: DataFrame,
    *,
    source_name: str = "GDELT",
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows whose title still is a bare URL; optionally only the first ``limit`` by ``order``."""
    pending = df.filter((F.col("source") == source_name) & F.col("title").startswith("http"))
    return first_rows(pending, order, limit) if limit else pending


def first_rows(df: DataFrame, order: str | None, limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order``; without one, by a hash of the whole row, so that runs agree."""
    return df.orderBy(order if order else F.xxhash64(*df.columns)).limit(limit)


def non_blank(df: DataFrame, *names: str) -> DataFrame:
    return reduce(lambda rows, name: rows.filter(~is_blank(F.col(name))), names, df)


def confident(df: DataFrame, threshold: float = DEFAULT_THRESHOLD, score: str = "confidence_score") -> DataFrame:
    return df.filter(F.col(score) >= threshold)
