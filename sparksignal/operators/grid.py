"""Dense calendars, reindexing and forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import floor_minutes

FILL_BLOCK = 4096


def day_calendar(dimension: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """One row per (day, dimension row), both end days included.

    The days are generated inside each dimension row, so nothing is joined.
    """
    if start_date > end_date:
        raise ValueError("the day range ends before it starts")
    days = F.sequence(F.lit(start_date).cast("date"), F.lit(end_date).cast("date"))
    return dimension.select(F.explode(days).alias("date"), *dimension.columns)


def interval_calendar(
    rows: DataFrame, time: str, keys: Sequence[str] = (), minutes: int = 15
) -> DataFrame:
    """Every window from each key's first to its last observed one.

    ``position`` numbers the windows of a key from 0. Only the time column and
    the keys are read.
    """
    step = F.expr(f"interval {int(minutes)} minutes")
    bounds = rows.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
    windows = F.sequence(floor_minutes(F.col("_first"), minutes), floor_minutes(F.col("_last"), minutes), step)
    return bounds.select(*keys, F.posexplode(windows).alias("position", "timestamp")).withColumn(
        "position", F.col("position").cast("long")
    )


def reindex(grid: DataFrame, measures: DataFrame, on: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """Bring aggregates onto a full grid.

    Counts become 0 where nothing was observed, other measures stay NULL, and
    keys outside the grid vanish.
    """
    joined = grid.join(measures, list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in counts})


def forward_fill(df: DataFrame, value: str, out: str, keys: Sequence[str], order: str) -> DataFrame:
    """Last known value per key; a leading gap stays NULL.

    Meant for grids, where a key holds one row per calendar step.
    """
    window = (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.withColumn(out, F.last(value, ignorenulls=True).over(window))


def forward_fill_blocks(
    df: DataFrame,
    value: str,
    out: str,
    position: str,
    keys: Sequence[str] = (),
    block: int = FILL_BLOCK,
) -> DataFrame:
    """``forward_fill`` over a numbered series that may be one single long series.

    The series is cut into blocks of ``block`` rows that are filled side by side.
    Only one row per block takes part in the ordered pass over block ends.
    """
    keys = list(keys)
    blocked = df.withColumn("_block", F.floor(F.col(position) / block))
    inside = (
        Window.partitionBy(*keys, "_block")
        .orderBy(position)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ends = blocked.groupBy(*keys, "_block").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(position))).alias("_end")
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *keys, "_block", F.last("_end", ignorenulls=True).over(before).alias("_carry")
    )
    return (
        blocked.withColumn("_inside", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [*keys, "_block"], "left")
        .withColumn(out, F.coalesce("_inside", "_carry"))
        .drop("_block", "_inside", "_carry")
    )
