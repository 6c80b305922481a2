"""A stored daily series that grows and is corrected day by day, and stages that know what they were made from."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grid import day_calendar, forward_fill, reindex
from ..session import cut_lineage
from .daily import daily_means, daily_sentiment


def fingerprint(*inputs: DataFrame | str, **parameters: object) -> str:
    """A digest of parameters, earlier fingerprints and all rows of tables, in any order; one pass over each table."""
    known: list = [json.dumps({k: repr(v) for k, v in parameters.items()}, sort_keys=True)]
    for given in inputs:
        if isinstance(given, str):
            known.append(given)
            continue
        row = F.to_json(F.struct(*sorted(given.columns)), {"ignoreNullFields": "false"}) if given.columns else F.lit("")
        h = F.xxhash64(row)
        # Repeated rows cancel out in one number and not in the other.
        seen = given.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(20,0)"))).first()
        known.append([given.schema.simpleString(), *map(str, seen)])
    return hashlib.sha256(json.dumps(known).encode()).hexdigest()


def _mark(spark: SparkSession, path: str):
    """(file system, file) of a stored table's fingerprint; tables do not read files of such names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_fingerprint")
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def write_mark(spark: SparkSession, path: str, mark: str) -> None:
    """Remember what the table at ``path`` was made from."""
    files, target = _mark(spark, path)
    stream = files.create(target, True)
    stream.write(mark.encode())
    stream.close()


def read_mark(spark: SparkSession, path: str) -> str | None:
    files, target = _mark(spark, path)
    if not files.exists(target):
        return None
    stream = files.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def clear_mark(spark: SparkSession, path: str) -> None:
    files, target = _mark(spark, path)
    files.delete(target, False)


def _store(rows: DataFrame, path: str) -> None:
    """Replace the partitions of the days that the rows have, and no others."""
    (
        rows.repartition("date")
        .sortWithinPartitions("date", "subindustria_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


_COLUMNS = ["date", "subindustria_id", "news_count", "sentiment_mean", "sentiment", "industria_id", "subindustria_nombre"]


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The stored series, one partition per day."""
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("date")).select(*_COLUMNS)


def build_days(news: DataFrame, taxonomy: DataFrame, path: str, start_date: str, end_date: str, **parameters: object) -> None:
    """``daily_sentiment`` of the whole range, stored by day; ``parameters`` name what else the values depend on."""
    spark = news.sparkSession
    clear_mark(spark, path)
    _store(daily_sentiment(news, taxonomy, start_date=start_date, end_date=end_date, ordered=False), path)
    write_mark(spark, path, fingerprint(taxonomy, **parameters))


def update_days(
    news: DataFrame,
    taxonomy: DataFrame,
    path: str,
    first_day: str,
    last_day: str,
    end_date: str | None = None,
    **parameters: object,
) -> None:
    """Give the days from ``first_day`` to ``last_day`` the news they now have, and carry on from there.

    ``news`` holds all news of these days; other rows are ignored. Read are the
    carried values of the day before, one partition, and the means of the days
    after; written are the partitions from ``first_day`` on, up to ``end_date`` or
    the last stored day. Days before are not touched. The result is that of a full
    run. A series built with another taxonomy or other parameters is refused: its
    days would not fit together. So is one whose last update did not finish.
    """
    spark = news.sparkSession
    mark = fingerprint(taxonomy, **parameters)
    if read_mark(spark, path) != mark:
        raise ValueError(f"the series at {path} was made from another taxonomy or other parameters, or is unfinished; build it anew")
    stored = read_days(spark, path)
    known = stored.agg(F.min("date").cast("string"), F.max("date").cast("string")).first()
    if known[0] is None or not known[0] <= first_day <= last_day:
        raise ValueError("the days must be in order and start inside the stored series")
    end = max(last_day, known[1], end_date or last_day)
    gap = F.datediff(F.lit(first_day).cast("date"), F.lit(known[1]).cast("date"))
    if spark.range(1).select(gap).first()[0] > 1:
        raise ValueError(f"days are missing between {known[1]} and {first_day}")
    later = stored.where(F.col("date") > F.lit(last_day).cast("date")).where("news_count > 0")
    fresh = daily_means(news, first_day, last_day)
    means = fresh.unionByName(later.select("date", "subindustria_id", "news_count", "sentiment_mean"))
    day_before = F.date_sub(F.lit(first_day).cast("date"), 1)
    carried = stored.where(F.col("date") == day_before).select("subindustria_id", F.col("sentiment").alias("_carried"))
    grid = day_calendar(taxonomy.select("industria_id", "subindustria_id", "subindustria_nombre"), first_day, end)
    dense = reindex(grid, means, ["date", "subindustria_id"], ["news_count"])
    filled = forward_fill(dense, "sentiment_mean", "_filled", ["subindustria_id"], "date").join(carried, "subindustria_id", "left")
    rows = cut_lineage(filled.withColumn("sentiment", F.coalesce("_filled", "_carried")).select(*_COLUMNS))
    # Without its mark, a series that stops half-way is known to be unfinished.
    clear_mark(spark, path)
    _store(rows, path)
    write_mark(spark, path, mark)


def stored_stage(spark: SparkSession, path: str, mark: str, build: Callable[[], DataFrame], resume: bool = True) -> DataFrame:
    """The stage at ``path`` if it was made from the same input and parameters, else made and stored anew."""
    if not (resume and read_mark(spark, path) == mark):
        clear_mark(spark, path)
        build().write.mode("overwrite").parquet(path)
        write_mark(spark, path, mark)
    return spark.read.parquet(path)
