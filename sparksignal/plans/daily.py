"""Daily sentiment for every taxonomy entry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import in_day_range, prune_days, publication_time, time_column_of
from ..functions.sentiment import sentiment_value
from ..operators.grid import day_calendar, forward_fill, reindex

DEFAULT_START_DATE = "2022-01-01"
DEFAULT_END_DATE = "2024-12-31"


def daily_means(
    news: DataFrame, start_date: str, end_date: str, key: str = "subindustria_id", strict: bool = False
) -> DataFrame:
    """Mean sentiment and row count per (day, key) inside the day range."""
    if strict:
        # Evaluates every value, also outside the range, and fails on a bad one.
        _dated_values(news, key).agg(F.sum("_value"), F.max("_ts")).collect()
    inside = prune_days(news, time_column_of(news, allow_date=True), start_date, end_date)
    return (
        _dated_values(inside, key)
        .filter(in_day_range(F.col("_ts"), start_date, end_date) & F.col(key).isNotNull())
        .groupBy(F.to_date("_ts").alias("date"), key)
        .agg(F.count(F.lit(1)).alias("news_count"), F.avg("_value").alias("sentiment_mean"))
    )


def _dated_values(news: DataFrame, key: str) -> DataFrame:
    return news.select(
        publication_time(news, allow_date=True).alias("_ts"), F.col(key), sentiment_value(news).alias("_value")
    )


def daily_sentiment(
    news: DataFrame,
    taxonomy: DataFrame,
    *,
    start_date: str = DEFAULT_START_DATE,
    end_date: str = DEFAULT_END_DATE,
    strict: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """One row per (day, sub-industry) with its own mean and a carried value.

    ``taxonomy`` has industria_id, subindustria_id and subindustria_nombre.
    ``sentiment`` repeats a sub-industry's last known mean on days without news;
    days before its first news stay NULL. ``strict`` also rejects bad sentiment
    values outside the day range, at the price of an extra pass.
    """
    dimension = taxonomy.select("industria_id", "subindustria_id", "subindustria_nombre")
    grid = day_calendar(dimension, start_date, end_date)
    means = daily_means(news, start_date, end_date, strict=strict)
    filled = forward_fill(
        reindex(grid, means, ["date", "subindustria_id"], ["news_count"]),
        "sentiment_mean",
        "sentiment",
        ["subindustria_id"],
        "date",
    )
    result = filled.select(
        "date",
        "subindustria_id",
        "news_count",
        "sentiment_mean",
        "sentiment",
        "industria_id",
        "subindustria_nombre",
    )
    return result.orderBy("date", "subindustria_id") if ordered else result
