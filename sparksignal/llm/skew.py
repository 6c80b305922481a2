"""Joins with one row per key whose other side may be full of one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is heavy if it has more than this share of all rows; so many keys can be heavy at most.
HEAVY_KEYS = 1000


def join_per_key(rows: DataFrame, per_key: DataFrame, keys: list[str], weight: str) -> DataFrame:
    """``rows`` with the columns of their key's row in ``per_key``; rows of other keys go.

    ``weight`` is the column of ``per_key`` with the number of rows of the key.
    Heavy keys, ``HEAVY_KEYS`` at most, are broadcast, so their rows stay where
    they are; all others meet in a shuffle, and none of them has many rows.
    Both sides are read twice and should be stored.
    """
    total = per_key.agg(F.sum(weight)).first()[0] or 0
    is_heavy = F.col(weight) * HEAVY_KEYS > total
    heavy, light = F.broadcast(per_key.where(is_heavy)), per_key.where(~is_heavy)
    rest = rows.join(heavy.select(*keys), keys, "left_anti")
    return rows.join(heavy, keys).unionByName(rest.join(light, keys))
