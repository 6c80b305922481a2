"""Continuous collection and live aggregation."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedupe import dedupe_incremental, first_by_key, with_article_key

DEFAULT_INTERVAL = "900 seconds"


def landed_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    fmt: str = "parquet",
    name_filter: str | None = None,
    max_files: int | None = None,
    **options: str,
) -> DataFrame:
    """Stream of files that land in a folder; ``max_files`` bounds one trigger."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _start(writer, checkpoint: str, interval: str | None) -> StreamingQuery:
    """One cycle over all that has landed, or a cycle per interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def append_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    interval: str | None = DEFAULT_INTERVAL,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append to Parquet exactly once; without an interval, one cycle and stop."""
    writer = stream.writeStream.format("parquet").option("path", path).outputMode("append")
    return _start(writer.partitionBy(*partition_by) if partition_by else writer, checkpoint, interval)


def dedupe_within(stream: DataFrame, time: str, delay: str, keys: Sequence[str] = ("dedupe_key",)) -> DataFrame:
    """Drop repeats within ``delay`` of each other, later ones at times too; the state stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def dedupe_all(stream: DataFrame, keys: Sequence[str] = ("dedupe_key",)) -> DataFrame:
    """Drop every repeat ever seen; the state keeps one entry per key."""
    return stream.dropDuplicates(list(keys))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def collect_once_each(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str],
    *,
    interval: str | None = DEFAULT_INTERVAL,
) -> StreamingQuery:
    """Append only articles not stored by an earlier cycle; the first by ``order`` wins.

    Every cycle of a checkpoint owns one partition of the output and rewrites it
    if repeated, so a restarted cycle neither loses nor doubles rows, and a new
    checkpoint adds to what is stored.
    """
    order = list(order)
    run = "r" + hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def store(batch: DataFrame, cycle: int) -> None:
        spark = batch.sparkSession
        keyed = with_article_key(batch)
        if _exists(spark, path):
            layout = T.StructType(
                [
                    keyed.schema["dedupe_key"],
                    T.StructField("run", T.StringType()),
                    T.StructField("cycle", T.LongType()),
                ]
            )
            stored = spark.read.schema(layout).parquet(path)
            earlier = stored.filter((F.col("run") != run) | (F.col("cycle") < cycle))
            fresh = dedupe_incremental(keyed, earlier.select("dedupe_key"), order)
        else:
            fresh = first_by_key(keyed, ["dedupe_key"], order)
        fresh.select(*keyed.columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}/cycle={cycle}")

    return _start(stream.writeStream.foreachBatch(store), checkpoint, interval)


def live_interval_means(
    stream: DataFrame,
    *,
    time: str = "timestamp",
    value: str = "sentiment_value",
    keys: Sequence[str] = (),
    minutes: int = 15,
    delay: str = "10 minutes",
) -> DataFrame:
    """Mean and count per window, emitted once a window is closed.

    The dense series, its fill and its smoothing run downstream on closed windows.
    """
    keys = list(keys)
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, f"{minutes} minutes").alias("_w"), *keys)
        .agg(F.count(F.lit(1)).alias("news_count"), F.avg(value).alias("sentiment_mean"))
        .select(F.col("_w.start").alias("timestamp"), *keys, "news_count", "sentiment_mean")
    )
