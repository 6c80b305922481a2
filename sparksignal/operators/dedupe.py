"""De-duplication, set operations and row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# monotonically_increasing_id keeps the row's place within its partition in the low 33 bits.
_ROW_BITS = 33


def article_key(title: Column, source: Column) -> Column:
    """MD5 of ``title|source``; a NULL counts as empty text."""
    empty = F.lit("")
    return F.md5(F.concat(F.coalesce(title, empty), F.lit("|"), F.coalesce(source, empty)))


def with_article_key(df: DataFrame, title: str = "title", source: str = "source") -> DataFrame:
    """Fix ``dedupe_key`` when a row is first collected.

    Later steps rewrite title and source; the key stays, so a second collection
    still recognises the article.
    """
    if "dedupe_key" in df.columns:
        return df
    return df.withColumn("dedupe_key", article_key(F.col(title), F.col(source)))


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key group.

    Each task reduces its own rows before anything is shuffled, so a group of
    copies that makes up a large part of the table arrives as one row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(c) for c in order])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def dedupe_first_wins(
    df: DataFrame, order: Sequence[str], title: str = "title", source: str = "source"
) -> DataFrame:
    """One row per (title, source): the earliest by ``order``."""
    return first_by_key(with_article_key(df, title, source), ["dedupe_key"], order)


def dedupe_incremental(
    new: DataFrame, stored: DataFrame, order: Sequence[str], title: str = "title", source: str = "source"
) -> DataFrame:
    """``dedupe_first_wins`` on the rows whose key is not stored yet."""
    seen = with_article_key(stored, title, source).select("dedupe_key")
    fresh = with_article_key(new, title, source).join(seen, "dedupe_key", "left_anti")
    others = [c for c in new.columns if c != "dedupe_key"]
    return first_by_key(fresh, ["dedupe_key"], order).select(*others, "dedupe_key")


def union_batches(first: DataFrame, *others: DataFrame) -> DataFrame:
    """Stack tables by column name."""
    for other in others:
        first = first.unionByName(other)
    return first


def sequential_id(df: DataFrame, order: Sequence[str], out: str = "article_id") -> DataFrame:
    """Number all rows 0..n-1 in the given order.

    Range partitions are sorted side by side and written once; the numbers of
    rows before each partition, one value per partition, complete the count.
    ``order`` should identify a row.
    """
    sorted_rows = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    fixed = cut_lineage(sorted_rows).withColumn("_part", F.shiftright("_mid", _ROW_BITS))
    counts = fixed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    place = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_base") + place)
        .drop("_part", "_mid", "_base")
    )
