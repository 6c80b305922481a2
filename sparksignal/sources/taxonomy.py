"""Taxonomies: raw, flat and nested shapes to one dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import fail_if
from ..functions.text import category_id, category_search_text

# The sector of categories without one, and the level every category has.
DEFAULT_SECTOR, LEVEL = "sin_sector", "CATEGORIA"

NESTED_SCHEMA = "industrias array<struct<id:string,nombre:string,subindustrias:array<struct<id:string,nombre:string>>>>"
FLAT_SCHEMA = "categorias array<struct<id:string,sector:string,categoria:string>>"
RAW_SCHEMA = "map<string,map<string,string>>"
CATEGORY_SCHEMA = "description string, keywords array<string>, avoid_confusion_with array<string>"


def taxonomy_entries(documents: DataFrame, json: str = "json") -> DataFrame:
    """industria_id, subindustria_id, subindustria_nombre from taxonomy JSON text.

    A document with ``industrias`` is read as nested; otherwise its flat
    ``categorias`` are used, and a missing sector gets a default.
    """
    nested = F.from_json(json, NESTED_SCHEMA)["industrias"]
    flat = F.from_json(json, FLAT_SCHEMA)["categorias"]
    from_nested = F.flatten(
        F.transform(
            nested,
            lambda industry: F.transform(
                F.coalesce(industry["subindustrias"], F.array()),
                lambda sub: F.struct(
                    industry["id"].alias("industria_id"),
                    sub["id"].alias("subindustria_id"),
                    sub["nombre"].alias("subindustria_nombre"),
                ),
            ),
        )
    )
    from_flat = F.transform(
        flat,
        lambda category: F.struct(
            F.coalesce(category["sector"], F.lit(DEFAULT_SECTOR)).alias("industria_id"),
            category["id"].alias("subindustria_id"),
            category["categoria"].alias("subindustria_nombre"),
        ),
    )
    return documents.select(F.inline(F.coalesce(from_nested, from_flat)))


def check_dimension(entries: DataFrame) -> DataFrame:
    """The dimension, or an error for a missing id or name or a repeated id.

    The checks run with whatever uses the table. Use ``require_entries`` to
    reject an empty taxonomy.
    """
    blank = F.col("subindustria_id").isNull() | F.col("subindustria_nombre").isNull()
    named = entries.select(
        "industria_id",
        fail_if(blank, "a sub-industry lacks its id or name", F.col("subindustria_id")).alias(
            "subindustria_id"
        ),
        "subindustria_nombre",
    )
    grouped = named.groupBy("subindustria_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.first("industria_id").alias("industria_id"),
        F.first("subindustria_nombre").alias("subindustria_nombre"),
    )
    return grouped.select(
        "industria_id",
        fail_if(
            F.col("_n") > 1, "a sub-industry id repeats in the taxonomy", F.col("subindustria_id")
        ).alias("subindustria_id"),
        "subindustria_nombre",
    )


def require_entries(entries: DataFrame) -> DataFrame:
    if entries.isEmpty():
        raise ValueError("the taxonomy has no sub-industries")
    return entries


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """A checked dimension from a taxonomy JSON file of either shape."""
    documents = spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")
    return check_dimension(require_entries(taxonomy_entries(documents)))


def flatten_raw_taxonomy(documents: DataFrame, json: str = "json") -> DataFrame:
    """One row per category from a raw sector -> category -> details document.

    Keys starting with an underscore are notes and skipped at both levels, as
    are categories that are not objects.
    """
    sectors = documents.select(F.explode(F.from_json(json, RAW_SCHEMA)).alias("sector", "_categories"))
    categories = sectors.filter(~F.col("sector").startswith("_")).select(
        "sector", F.explode("_categories").alias("categoria", "_text")
    )
    objects = categories.filter(~F.col("categoria").startswith("_") & F.trim("_text").startswith("{"))
    details = objects.withColumn("_d", F.from_json("_text", CATEGORY_SCHEMA))
    words = F.coalesce(F.col("_d.keywords"), F.array().cast("array<string>"))
    described = F.coalesce(F.col("_d.description"), F.lit(""))
    return details.select(
        category_id(F.col("sector"), F.col("categoria")).alias("id"),
        "sector",
        "categoria",
        described.alias("descripcion"),
        words.alias("keywords"),
        F.size(words).alias("keywords_count"),
        category_search_text(F.col("sector"), F.col("categoria"), described, words).alias("texto_para_embedding"),
        F.coalesce(F.col("_d.avoid_confusion_with"), F.array().cast("array<string>")).alias("evitar_confusion"),
        F.lit(LEVEL).alias("nivel"),
    )


def read_raw_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    documents = spark.read.text(path, wholetext=True).withColumnRenamed("value", "json")
    return flatten_raw_taxonomy(documents)
