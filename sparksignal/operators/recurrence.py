"""Recursive smoothing e[0] = x[0], e[i] = r*e[i-1] + (1-r)*x[i] as a parallel scan.

A series is cut into fixed blocks of consecutive positions, so no task ever
holds more than one block of one key, however long a single key's series is.
Inside a block the rows are folded in order, as a plain loop would, or, where
several recurrences share one pass, summed with weights; what all earlier blocks
leave behind, the carry, comes from the blocks' end values. These form a recurrence
of the same kind, many times shorter, and nothing of the history is cut off.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_BLOCK = 4096
# Rows that are folded one by one; a fold copies what it has found so far, so blocks are short.
FOLD_BLOCK = 256
MAX_LAGS = 64
# Powers of the ratio inside a block span about 50 decimal places.
MAX_EXPONENT = 115.0
# Factors below e**-1500 turn any double into zero.
ZERO_EXPONENT = 1500.0


def block_size(ratios: Sequence[float]) -> int:
    """Rows of a block that serves all ratios."""
    return max(1, min([MAX_BLOCK, *(int(MAX_EXPONENT / -math.log(r)) for r in ratios if 0.0 < r < 1.0)]))


def block_window(keys: Sequence[str], position: str):
    return Window.partitionBy(*keys, "_block").orderBy(position)


def in_blocks(df: DataFrame, position: str, block: int) -> DataFrame:
    """Add each row's ``_block`` and its ``_offset`` in it."""
    return df.withColumn("_block", F.floor(F.col(position) / block)).withColumn(
        "_offset", F.pmod(F.col(position), F.lit(block))
    )


def with_history(df: DataFrame, position: str, block: int, history: int) -> DataFrame:
    """``in_blocks``, with the ``history`` rows before a block repeated in it.

    ``_repeat`` marks the copies to drop after the window functions ran; their
    ``_offset`` is negative.
    """
    first, last = F.floor(F.col(position) / block), F.floor((F.col(position) + history) / block)
    return (
        df.withColumn("_block", F.explode(F.sequence(first, last)))
        .withColumn("_repeat", F.col("_block") != first)
        .withColumn("_offset", F.col(position) - F.col("_block") * block)
    )


def share_of(value: Column, ratio: float, position: str) -> Column:
    """What a row adds to the recurrence."""
    return F.when(F.col(position) == 0, value.cast("double")).otherwise(value * F.lit(1.0 - ratio))


def smoothed(share: Column, carry: Column, ratio: float, window) -> Column:
    """The smoothed value inside a block, given the carry from the blocks before; rows of history add nothing."""
    if ratio <= 0.0:
        return share
    running = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rate = F.lit(float(ratio))
    own = F.when(F.col("_offset") >= 0, share / F.pow(rate, F.col("_offset")))
    inside = F.coalesce(F.sum(own).over(running), F.lit(0.0)) * F.pow(rate, F.col("_offset"))
    return inside + F.pow(rate, F.col("_offset") + 1) * F.coalesce(carry, F.lit(0.0))


def recursive_smoothing(
    df: DataFrame,
    value: str,
    out: str,
    ratio: float,
    position: str,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Smooth ``value`` along ``position``, which counts 0, 1, 2, ... in each key.

    ``ratio`` is the weight of the previous smoothed value. The rows are read
    twice, so a costly input should be stored first.
    """
    if not 0.0 <= ratio <= 1.0:
        raise ValueError("the weight of the previous value must be between 0 and 1")
    keys = list(keys)
    if ratio == 0.0:
        return df.withColumn(out, F.col(value).cast("double"))
    if ratio == 1.0:
        first = df.filter(F.col(position) == 0).select(*keys, F.col(value).cast("double").alias(out))
        return df.join(first, keys) if keys else _attach_single(df, first, out)
    shares = df.withColumn("_share", share_of(F.col(value), ratio, position))
    return _scan(shares, "_share", out, ratio, position, keys).drop("_share")


def span_ratio(span: int) -> float:
    """Weight of the previous value in an exponential mean of the given span."""
    return 1.0 - 2.0 / (span + 1.0)


def _attach_single(df: DataFrame, one: DataFrame, out: str) -> DataFrame:
    return df.withColumn("_one", F.lit(1)).join(one.withColumn("_one", F.lit(1)), "_one").drop("_one")


def _scan(df: DataFrame, share: str, out: str, ratio: float, position: str, keys: list[str]) -> DataFrame:
    """e[i] = ratio*e[i-1] + share[i], folded row by row inside each block."""
    names, rate = df.columns, F.lit(ratio)
    order = lambda a, b: F.when(a[position] < b[position], -1).otherwise(1)
    packed = (
        df.withColumn("_block", F.floor(F.col(position) / FOLD_BLOCK))
        .groupBy(*keys, "_block")
        .agg(F.array_sort(F.collect_list(F.struct(*names)), order).alias("_rows"))
    )
    end = F.aggregate("_rows", F.lit(0.0), lambda e, row: rate * e + row[share])
    carried = _carries(packed.select(*keys, "_block", end.alias("_end")), ratio, FOLD_BLOCK, keys)

    def fold(state: Column, row: Column) -> Column:
        value = rate * state["e"] + row[share]
        return F.struct(value.alias("e"), F.array_append(state["values"], value).alias("values"))

    start = F.struct(F.coalesce("_carry", F.lit(0.0)).alias("e"), F.expr("cast(array() as array<double>)").alias("values"))
    values = F.aggregate("_rows", start, fold, lambda state: state["values"])
    joined = packed.join(carried, [*keys, "_block"], "left").select("_rows", values.alias("_values"))
    opened = joined.select(F.explode(F.arrays_zip("_rows", "_values")).alias("_row"))
    return opened.select(*[F.col(f"_row._rows.{c}").alias(c) for c in names], F.col("_row._values").alias(out))


def block_carries(
    blocked: DataFrame, recurrences: dict[str, tuple[Column, float]], block: int, keys: Sequence[str]
) -> DataFrame:
    """For every block that has one before it, the value each recurrence starts from.

    ``recurrences`` names (share, ratio) pairs; all must fit ``block``. Rows
    come as from ``in_blocks``.
    """
    keys = list(keys)
    ends = blocked.groupBy(*keys, "_block").agg(
        *[
            (F.sum(share / F.pow(F.lit(ratio), F.col("_offset"))) * F.pow(F.lit(ratio), F.max("_offset"))).alias(name)
            for name, (share, ratio) in recurrences.items()
        ]
    )
    carried = None
    for name, (_, ratio) in recurrences.items():
        one = _carries(ends.select(*keys, "_block", F.col(name).alias("_end")), ratio, block, keys)
        one = one.withColumnRenamed("_carry", name)
        carried = one if carried is None else carried.join(one, [*keys, "_block"])
    return carried


def _carries(ends: DataFrame, ratio: float, block: int, keys: list[str]) -> DataFrame:
    """The smoothed value each block starts from, keyed by block."""
    exponent = -math.log(ratio) * block
    lags = math.ceil(ZERO_EXPONENT / exponent) + 1
    if lags <= MAX_LAGS:
        # Every block takes from each earlier one that can still be felt; only existing blocks are kept.
        reach = F.explode(F.sequence(F.lit(0), F.lit(lags - 1)))
        # Two factors, so that the power itself cannot vanish before the product does.
        half = F.floor(F.col("_lag") / 2)
        rate = F.lit(math.exp(-exponent))
        part = F.col("_end") * F.pow(rate, half) * F.pow(rate, F.col("_lag") - half)
        parts = ends.select(*keys, "_block", "_end", reach.alias("_lag")).select(
            *keys, (F.col("_block") + F.col("_lag") + 1).alias("_block"), part.alias("_part")
        )
        return parts.groupBy(*keys, "_block").agg(F.sum("_part").alias("_carry"))
    # The block ends form a recurrence of the same kind, many times shorter.
    renamed = ends.withColumnsRenamed({"_block": "_level", "_end": "_level_share"})
    scanned = _scan(renamed, "_level_share", "_level_value", math.exp(-exponent), "_level", keys)
    return scanned.select(
        *keys, (F.col("_level") + 1).alias("_block"), F.col("_level_value").alias("_carry")
    )
