"""Dense 15-minute sentiment series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import floor_minutes, publication_time
from ..functions.sentiment import sentiment_value
from ..operators.grid import forward_fill_blocks, interval_calendar, reindex
from ..operators.recurrence import recursive_smoothing
from ..session import cut_lineage

CARRIED_SHARE = 0.8


def scored_times(news: DataFrame, keys: Sequence[str] = (), **columns: str) -> DataFrame:
    """Only the keys, the publication time and the sentiment value."""
    sentiment_column = columns.pop("sentiment_column", "sentiment_value")
    return news.select(
        *keys,
        publication_time(news, **columns).alias("_ts"),
        sentiment_value(news, sentiment_column).alias("_value"),
    )


def interval_means(rows: DataFrame, keys: Sequence[str] = (), minutes: int = 15) -> DataFrame:
    """Mean and count per window."""
    return rows.groupBy(*keys, floor_minutes(F.col("_ts"), minutes).alias("timestamp")).agg(
        F.count(F.lit(1)).alias("news_count"), F.avg("_value").alias("sentiment_mean")
    )


def sentiment_series(
    news: DataFrame,
    *,
    keys: Sequence[str] = (),
    minutes: int = 15,
    previous_window_weight: float = CARRIED_SHARE,
    **columns: str,
) -> DataFrame:
    """Mean, carried and smoothed sentiment for every window, per key if keys are given.

    The first window is the first one with news. ``columns`` may rename
    timestamp_column, sentiment_column, date_column and time_column.
    """
    if not 0.0 <= previous_window_weight <= 1.0:
        raise ValueError("previous_window_weight lies outside 0..1")
    keys = list(keys)
    rows = scored_times(news, keys, **columns)
    # The news are read once: calendar, filling and smoothing all start from the stored means.
    means = cut_lineage(interval_means(rows, keys, minutes))
    grid = interval_calendar(means, "timestamp", keys, minutes)
    dense = reindex(grid, means, [*keys, "timestamp"], ["news_count"])
    filled = cut_lineage(forward_fill_blocks(dense, "sentiment_mean", "sentiment", "position", keys))
    smooth = recursive_smoothing(
        filled, "sentiment", "sentiment_influenced", previous_window_weight, "position", keys
    )
    return smooth.select(
        *keys, "timestamp", "news_count", "sentiment_mean", "sentiment", "sentiment_influenced"
    )
