"""Series numbering and market indicators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .recurrence import block_carries, block_size, block_window, in_blocks, share_of, smoothed, span_ratio, with_history


def number_series(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, chunk: str = "month"
) -> DataFrame:
    """Number each key's rows 0, 1, 2, ... in time order.

    The rows of one key are numbered in calendar chunks side by side; chunk
    offsets come from row counts. A key that holds most of the table therefore
    still spreads over many tasks.
    """
    keys = list(keys)
    chunked = df.withColumn("_chunk", F.date_trunc(chunk, F.col(order[0])))
    counts = chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    local = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    return (
        chunked.withColumn("_local", F.row_number().over(local))
        .join(offsets, [*keys, "_chunk"])
        .withColumn(out, F.col("_base") + F.col("_local") - 1)
        .drop("_chunk", "_local", "_base")
    )


def difference(value: Column, window) -> Column:
    return value - F.lag(value).over(window)


def strength_index(gain: Column, loss: Column, position: str, window, period: int = 14) -> Column:
    """RSI from simple rolling means of gains and losses.

    The first value falls on row ``period``: the undefined first difference
    counts as no change. Only gains give 100; a flat stretch gives NULL.
    """
    frame = window.rowsBetween(1 - period, 0)
    up, down = F.avg(gain).over(frame), F.avg(loss).over(frame)
    ratio = F.when(down > 0, 100.0 - 100.0 / (1.0 + up / down)).when(up > 0, F.lit(100.0))
    return F.when(F.col(position) >= period - 1, ratio)


def series_indicators(
    df: DataFrame,
    value: str,
    position: str,
    keys: Sequence[str],
    *,
    period: int = 14,
    fast: int = 12,
    slow: int = 26,
) -> DataFrame:
    """Add ``diff``, ``rsi``, ``ema_fast``, ``ema_slow`` and ``macd`` to numbered series.

    All of them share one block layout, whatever the spans. The numbered rows
    are stored once: the blocks' end values are taken from them first.
    """
    ratios = {"_fast": span_ratio(fast), "_slow": span_ratio(slow)}
    block = block_size(ratios.values())
    price = F.col(value).cast("double")
    stored = cut_lineage(df)
    shares = {name: (share_of(price, ratio, position), ratio) for name, ratio in ratios.items()}
    carries = block_carries(in_blocks(stored, position, block), {k: v for k, v in shares.items() if v[1] > 0}, block, keys)
    rows = with_history(stored, position, block, period).join(carries, [*keys, "_block"], "left")
    window = block_window(keys, position)
    moved = F.when(F.col(position) == 0, F.lit(0.0)).otherwise(F.col("diff"))

    def mean(name: str) -> Column:
        share, ratio = shares[name]
        return smoothed(share, F.col(name) if name in carries.columns else F.lit(0.0), ratio, window)

    return (
        rows.withColumn("diff", difference(price, window))
        .withColumn("_gain", F.greatest(moved, F.lit(0.0)))
        .withColumn("_loss", F.greatest(-moved, F.lit(0.0)))
        .withColumns(
            {
                "rsi": strength_index(F.col("_gain"), F.col("_loss"), position, window, period),
                "ema_fast": mean("_fast"),
                "ema_slow": mean("_slow"),
            }
        )
        .filter(~F.col("_repeat"))
        .withColumn("macd", F.col("ema_fast") - F.col("ema_slow"))
        .drop("_block", "_offset", "_repeat", "_gain", "_loss", "_fast", "_slow")
    )
