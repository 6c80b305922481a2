"""Market indicators per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import normalize_symbol
from ..operators.indicators import number_series, series_indicators

OUTPUT = ["timestamp", "ticker", "open", "high", "low", "close", "volume", "rsi", "macd"]


def numbered_bars(bars: DataFrame, chunk: str = "month") -> DataFrame:
    """Bars that have a closing price, numbered per ticker in time order."""
    usable = bars.filter(F.col("close").isNotNull() & ~F.isnan("close")).withColumn(
        "ticker", normalize_symbol(F.col("ticker"))
    )
    return number_series(usable, ["ticker"], ["timestamp"], "_position", chunk)


def bar_indicators(
    bars: DataFrame, *, period: int = 14, fast: int = 12, slow: int = 26, chunk: str = "month"
) -> DataFrame:
    """All indicator columns, before incomplete rows are dropped."""
    return series_indicators(
        numbered_bars(bars, chunk),
        "close",
        "_position",
        ["ticker"],
        period=period,
        fast=fast,
        slow=slow,
    )


def market_indicators(
    bars: DataFrame, *, period: int = 14, fast: int = 12, slow: int = 26, chunk: str = "month"
) -> DataFrame:
    """RSI and MACD for every ticker; rows with any missing value are dropped."""
    rows = bar_indicators(bars, period=period, fast=fast, slow=slow, chunk=chunk)
    return rows.select(*OUTPUT).dropna()
