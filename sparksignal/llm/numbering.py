"""Places of rows in ordered groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

_PART_BITS = 33


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with pos (place in the group, from 0) and total (rows of the group).

    Range partitions over all rows are sorted side by side; a group may lie in
    any number of them. Rows of each group are counted per partition, and the
    counts, one per partition and group in it, complete the place.
    """
    keys = [*group, *order]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_mid", F.monotonically_increasing_id())
    fixed = cut_lineage(placed).withColumn("_part", F.shiftright("_mid", _PART_BITS))
    counts = fixed.groupBy("_part", *group).agg(F.count("*").alias("_n"), F.min("_mid").alias("_first"))
    # A group's counts are one per partition it lies in.
    of_group = Window.partitionBy(*group)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *group,
        F.col("_part").alias("_in"),
        (F.col("_first") - F.coalesce(F.sum("_n").over(before), F.lit(0))).alias("_base"),
        F.sum("_n").over(of_group).alias("total"),
    )
    same = F.col("_part") == F.col("_in")
    for g in group:
        starts = starts.withColumnRenamed(g, f"_of_{g}")
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return fixed.join(starts, same).select(*rows.columns, (F.col("_mid") - F.col("_base")).alias("pos"), "total")
