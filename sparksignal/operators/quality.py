"""Reports and checks on tables."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.common import fail_if, strip
from ..session import cut_lineage
from .dedupe import sequential_id
from .filters import contains_any, first_rows

EXACT_ROWS = 1_000_000
HISTOGRAM_BINS = 4096

#: How the time of a file is named, also in the name of its partition.
FILE_TIME = "yyyyMMddHHmmss"
#: Column of the exact time of a stored record's file.
FILE_AT = "_file_at"
#: Partitions of records stored by file time, at most: files next to each other in time share one.
TIME_PARTITIONS = 1024

# Planning constants of the backfill estimate.
BYTES_PER_ROW, SECONDS_PER_FILE = 400, 0.5


def order_statistics(df: DataFrame, value: str, positions: Sequence[int]) -> list[float]:
    """Values at the given 0-based places of the sorted column, exactly.

    The value range is narrowed by histograms until few rows are left, so no
    task sorts the whole column. Only bin counts and single values reach the
    driver. NULL values have no place; NaN and infinite ones are an error.
    """
    column = fail_if(
        F.isnan(value) | (F.abs(F.col(value)) == float("inf")), "a value is not a finite number", F.col(value).cast("double")
    )
    rows = df.select(column.alias("_v")).filter(F.col("_v").isNotNull())
    return [_value_at(rows, place) for place in positions]


def _value_at(rows: DataFrame, place: int) -> float:
    low_high = rows.agg(F.min("_v"), F.max("_v"), F.count("_v")).first()
    low, high, count = low_high
    if not 0 <= place < count:
        raise ValueError("position outside the table")
    while True:
        part = rows.filter((F.col("_v") >= low) & (F.col("_v") <= high))
        if low == high:
            return low
        if count <= EXACT_ROWS:
            share = place / (count - 1) if count > 1 else 0.0
            # A place is a whole number of steps, so the exact percentile is one of the values.
            return part.agg(F.percentile("_v", F.lit(share))).first()[0]
        width = (high - low) / HISTOGRAM_BINS
        bin_of = F.least(F.floor((F.col("_v") - low) / F.lit(width)), F.lit(HISTOGRAM_BINS - 1))
        bins = (
            part.groupBy(bin_of.alias("_bin"))
            .agg(F.count("_v").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
            .orderBy("_bin")
            .collect()
        )
        for entry in bins:
            if place < entry["n"]:
                low, high, count = entry["low"], entry["high"], entry["n"]
                break
            place -= entry["n"]


def exact_median(df: DataFrame, value: str) -> float | None:
    """Median of all values; the mean of the middle two for an even count."""
    count = df.filter(F.col(value).isNotNull()).count()
    if count == 0:
        return None
    middle = sorted({(count - 1) // 2, count // 2})
    found = order_statistics(df, value, middle)
    return sum(found) / len(found)


def similarity_statistics(scores: DataFrame, score: str = "confidence_score") -> DataFrame:
    """Count, min, max, mean, median and population deviation, before any threshold.

    The scores are stored once, since the median takes several passes over them.
    """
    stored = cut_lineage(scores.select(score))
    median = exact_median(stored, score)
    return stored.agg(
        F.count(score).alias("n"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("std_score"),
    ).withColumn("median_score", F.lit(median).cast("double"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of ``n`` rows: the lowest hashes of key and seed."""
    order = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return df.orderBy(order, key).limit(n)


def classification_quality(
    labelled: DataFrame, *, key: str, n: int = 100, seed: int = 42, score: str = "confidence_score"
) -> DataFrame:
    """Score spread and label variety over a sample of classified rows."""
    return hash_sample(labelled, key, n, seed).agg(
        F.count(F.lit(1)).alias("sampled"),
        F.avg(score).alias("mean_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
        F.stddev_samp(score).alias("std_score"),
        F.count_distinct("industria_id").alias("industries"),
        F.count_distinct("subindustria_id").alias("subindustries"),
    )


def industry_distribution(labelled: DataFrame, *, key: str, n: int = 100, seed: int = 42) -> DataFrame:
    """Sampled rows per industry."""
    return hash_sample(labelled, key, n, seed).groupBy("industria_id").agg(F.count(F.lit(1)).alias("rows"))


def taxonomy_report(categories: DataFrame) -> DataFrame:
    """Totals over a flat taxonomy."""
    return categories.agg(
        F.count(F.lit(1)).alias("categories"),
        F.count_distinct("sector").alias("sectors"),
        F.coalesce(F.sum("keywords_count"), F.lit(0)).alias("keywords"),
        F.avg("keywords_count").alias("mean_keywords"),
        F.min("keywords_count").alias("min_keywords"),
        F.max("keywords_count").alias("max_keywords"),
    )


def categories_per_sector(categories: DataFrame) -> DataFrame:
    return categories.groupBy("sector").agg(F.count(F.lit(1)).alias("categories"))


def dataset_profile(
    df: DataFrame,
    required: Sequence[str] = ("date", "headline", "outlet"),
    *,
    headline: str = "headline",
    outlet: str = "outlet",
    first: int | None = None,
) -> DataFrame:
    """Missing columns, NULLs, blank and mean headline length, distinct outlets in one pass.

    ``first`` profiles only that many rows; the row count always covers all.
    """
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    rows = first_rows(df, None, first) if first else df
    nulls = [
        expr
        for c in required
        for expr in (
            F.sum(F.col(c).isNull().cast("long")).alias(f"{c}_nulls"),
            F.avg(F.col(c).isNull().cast("double") * 100.0).alias(f"{c}_null_pct"),
        )
    ]
    profile = rows.agg(
        F.count(F.lit(1)).alias("profiled_rows"),
        *nulls,
        F.sum((strip(F.col(headline)) == "").cast("long")).alias("blank_headlines"),
        F.avg(F.length(headline)).alias("mean_headline_length"),
        F.count_distinct(outlet).alias("outlets"),
    )
    if not first:
        return profile.withColumn("total_rows", F.col("profiled_rows"))
    total = df.agg(F.count(F.lit(1)).alias("total_rows")).withColumn("_one", F.lit(1))
    return profile.withColumn("_one", F.lit(1)).join(total, "_one").drop("_one")


def taxonomy_violations(industries: DataFrame) -> DataFrame:
    """Rows (check, item) for each broken rule of a nested taxonomy.

    ``industries`` has id, nombre and subindustrias (ARRAY<STRUCT<id, nombre>>).
    """
    subs = industries.select("id", F.explode_outer("subindustrias").alias("_s"))
    blank = industries.filter(F.col("id").isNull() | F.col("nombre").isNull()).select(
        F.lit("industry without id or name").alias("check"), F.coalesce("id", "nombre").alias("item")
    )
    blank_subs = subs.filter(
        F.col("_s").isNotNull() & (F.col("_s.id").isNull() | F.col("_s.nombre").isNull())
    ).select(
        F.lit("sub-industry without id or name").alias("check"), F.coalesce("_s.id", "_s.nombre").alias("item")
    )
    repeated = _repeated(industries.select("id"), "repeated industry id")
    repeated_subs = _repeated(subs.select(F.col("_s.id").alias("id")), "repeated sub-industry id")
    return blank.unionByName(blank_subs).unionByName(repeated).unionByName(repeated_subs)


def _repeated(ids: DataFrame, message: str) -> DataFrame:
    counts = ids.filter(F.col("id").isNotNull()).groupBy("id").agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > 1).select(F.lit(message).alias("check"), F.col("id").alias("item"))


def require_valid_taxonomy(industries: DataFrame) -> DataFrame:
    """The taxonomy itself, or an error naming the first broken rule."""
    problem = taxonomy_violations(industries).first()
    if problem is not None:
        raise ValueError(f"{problem['check']}: {problem['item']}")
    return industries


def stride_sample(manifest: DataFrame, sample_files: int) -> DataFrame:
    """Every (n // sample_files)-th listed file in time order, at most ``sample_files``."""
    places = sequential_id(manifest, ["file_ts", "url"], "_place")
    stride = max(1, places.count() // sample_files)
    return places.filter(
        (F.pmod(F.col("_place"), F.lit(stride)) == 0) & (F.col("_place") < stride * sample_files)
    ).drop("_place")


def backfill_estimate(
    manifest: DataFrame,
    contents: DataFrame,
    keywords: Sequence[str] | None = None,
    *,
    sample_files: int = 20,
    line: str = "value",
    partition: str | None = None,
) -> DataFrame:
    """Volume of a backfill, extrapolated from a sample of its files.

    ``manifest`` is (file_ts, url, size_bytes); ``contents`` is (url, value) with
    one record per row. Only records of sampled files are read further. If the
    contents are stored by file time (see ``land_by_file_time``), ``partition``
    names that column, and only the partitions that hold sampled files are read.
    """
    sample = cut_lineage(stride_sample(manifest, sample_files))
    keys = sample.select("url")
    if partition:
        # The sample has at most ``sample_files`` rows: it is broadcast, and its partitions prune the scan. Without a
        # comparison on this side the planner would not expect that to pay; no listed URL is empty.
        named = _held_in(sample.select("url", F.date_format("file_ts", FILE_TIME).alias(FILE_AT)), contents, partition)
        keys = F.broadcast(named.where(F.col("url") != "").select("url", FILE_AT, F.col("_name").alias(partition)))
        if FILE_AT not in contents.columns:
            # Stored elsewhere, with a partition for each time.
            contents = contents.withColumn(FILE_AT, F.col(partition).cast("string"))
    records = contents.join(keys, keys.columns, "left_semi").filter(strip(F.col(line)) != "")
    matched = contains_any(F.col(line), keywords) if keywords else F.lit(True)
    content = records.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.coalesce(F.sum(matched.cast("long")), F.lit(0)).alias("matched_rows"),
        F.coalesce(F.sum(F.octet_length(line) + 1), F.lit(0)).alias("sample_bytes"),
    )
    sizes = sample.agg(
        F.count(F.lit(1)).alias("sampled_files"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("sample_zip_bytes")
    )
    listed = manifest.agg(
        F.count(F.lit(1)).alias("files"),
        (F.avg(F.when(F.col("size_bytes") > 0, F.col("size_bytes"))) * F.count(F.lit(1))).alias("listed_bytes"),
    )
    one = F.lit(1)
    joined = (
        listed.withColumn("_one", one)
        .join(sizes.withColumn("_one", one), "_one")
        .join(content.withColumn("_one", one), "_one")
    )
    per_file = F.try_divide(F.col("total_rows"), F.col("sampled_files"))
    rate = F.try_divide(F.col("matched_rows"), F.col("total_rows"))
    estimated = F.floor(per_file * F.col("files") * rate)
    return joined.select(
        "files",
        "sampled_files",
        "total_rows",
        "matched_rows",
        rate.alias("match_rate"),
        "listed_bytes",
        (F.try_divide(F.col("sample_zip_bytes"), F.col("sampled_files")) * F.col("files")).alias("zip_bytes"),
        (F.try_divide(F.col("sample_bytes"), F.col("sampled_files")) * F.col("files")).alias("text_bytes"),
        estimated.alias("estimated_rows"),
        (estimated * BYTES_PER_ROW).alias("estimated_output_bytes"),
        (F.col("files") * F.lit(SECONDS_PER_FILE)).alias("estimated_seconds"),
    )


def _held_in(files: DataFrame, stored: DataFrame, partition: str) -> DataFrame:
    """Files with the name of the partition that holds their time: the last one that does not begin after it."""
    names = stored.select(F.col(partition).alias("_name")).distinct()
    begins = F.col("_name").try_cast("long")
    held = files.join(names, begins <= F.col(FILE_AT).cast("long"))
    return cut_lineage(held.groupBy("url", FILE_AT).agg(F.max_by("_name", begins).alias("_name")))


def land_by_file_time(
    contents: DataFrame,
    path: str,
    partition: str = "file_time",
    time: str = "file_ts",
    *,
    partitions: int = TIME_PARTITIONS,
) -> DataFrame:
    """Store records by the time of their file, and return the stored table.

    A partition holds all records from the time it is named by to that of the next
    one. There are at most about ``partitions``, of about as many records each
    wherever the times may lie, so neither folders nor files grow with the files
    landed. The exact time stays in a column. Records without a time have a
    partition of their own.
    """
    at = F.date_format(time, FILE_TIME)
    landed = contents.withColumn(FILE_AT, at).drop(time)
    number = F.col(FILE_AT).cast("long")
    shares = F.array(*[F.lit(k / partitions) for k in range(1, partitions)] or [F.lit(0.0)])
    first, others = landed.agg(F.min(number), F.percentile_approx(number, shares, F.lit(4 * partitions))).first()
    begins = [] if first is None else sorted({first, *others})
    if begins:
        cut = Bucketizer(splits=[-math.inf, *map(float, begins), math.inf], inputCol="_at", outputCol="_k", handleInvalid="keep")
        placed = cut.transform(landed.withColumn("_at", number.cast("double")))
        names = F.array(*[F.lit(f"{x:014d}") for x in begins])
        name = F.when(F.col("_at").isNotNull(), F.element_at(names, F.col("_k").cast("int")))
        landed = placed.withColumn(partition, name).drop("_at", "_k")
    else:
        landed = landed.withColumn(partition, F.lit(None).cast("string"))
    # A partition is written by one task, or by some if it is large.
    landed.hint("rebalance", partition).write.partitionBy(partition).parquet(path)
    schema = T.StructType([f for f in landed.schema if f.name != partition] + [T.StructField(partition, T.StringType())])
    return contents.sparkSession.read.schema(schema).parquet(path)


def observe_run(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Attach run counters that are gathered while the job runs, without a second pass."""
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("total")]
    metrics += [F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in counters.items()]
    return df.observe(observation, *metrics), observation


def write_counted(df: DataFrame, path: str, **counters: Column) -> DataFrame:
    """Store the rows; the same counters as a table, from the job that writes them and no other."""
    watched, seen = observe_run(df, f"run-{uuid.uuid4().hex}", **counters)
    watched.write.parquet(path)
    names = ["total", *counters]
    counted = df.sparkSession.createDataFrame([tuple(seen.get[n] for n in names)], ", ".join(f"`{n}` long" for n in names))
    return _with_shares(counted, counters)


def stream_counters(query: StreamingQuery, name: str) -> list[dict[str, int]]:
    """What an observation of this name counted in each cycle of a running or finished stream."""
    return [p.observedMetrics[name].asDict() for p in query.recentProgress if name in p.observedMetrics]


def run_counters(df: DataFrame, **counters: Column) -> DataFrame:
    """The same counters as a table, each with its share of all rows in percent, in a pass of its own."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.coalesce(F.sum(c.cast("long")), F.lit(0)).alias(n) for n, c in counters.items()],
    )
    return _with_shares(counted, counters)


def _with_shares(counted: DataFrame, counters: Iterable[str]) -> DataFrame:
    shares = [
        F.coalesce(F.try_divide(F.col(n) * F.lit(100.0), F.col("total")), F.lit(0.0)).alias(f"{n}_pct")
        for n in counters
    ]
    return counted.select("total", *counters, *shares)
