"""Landed filings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_filing_files(spark: SparkSession, path: str) -> DataFrame:
    """filing, path, length of the files below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.htm")
        .load(path)
        .select("path", "length")
    )
    return files.withColumn("filing", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))


def main_documents(files: DataFrame) -> DataFrame:
    """The largest ``.htm`` file per filing whose name does not start with R.

    Equal sizes go to the first path.
    """
    name = F.element_at(F.split("path", "/"), -1)
    pages = files.filter(name.endswith(".htm") & ~name.startswith("R"))
    order = F.struct((-F.col("length")).alias("size"), F.col("path"))
    return pages.groupBy("filing").agg(F.min(order).alias("_best")).select(
        "filing", F.col("_best.path").alias("path"), (-F.col("_best.size")).alias("length")
    )


def read_main_documents(spark: SparkSession, path: str) -> DataFrame:
    """filing, path, html of the main document of every filing below a folder.

    Files whose name starts with R are never opened; of the others, the ones that
    are not the largest of their filing are dropped by the join.
    """
    chosen = main_documents(list_filing_files(spark, path))
    pages = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="[!R]*.htm")
        .load(path)
        .select("path", F.decode("content", "UTF-8").alias("html"))
    )
    return pages.join(chosen.select("filing", "path"), "path")
