"""The sample tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import strip
from ..session import configure, cut_lineage

PLACES = 6

# Sentiment label of each kind of event.
EVENT_LABELS = {
    "purchase": "positive",
    "signup": "positive",
    "view": "neutral",
    "click": "neutral",
    "error": "negative",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def rounded(col: Column | str, places: int = PLACES) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, places)


def quickly_rounded(col: str, places: int = PLACES) -> Column:
    """``rounded`` for doubles. Decimals are slow, so they are used only where arithmetic might differ: near halves of a step."""
    scaled = F.col(col) * F.lit(10.0**places) + F.lit(0.5)
    steps = F.floor(scaled)
    clear = (F.abs(F.col(col)) < 1000) & (scaled - steps).between(0.001, 0.999)
    return F.when(clear, steps / F.lit(10.0**places)).otherwise(rounded(col, places))


def stamp(col: Column | str) -> Column:
    """A timestamp as text."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def event_news(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Events as scored news: a label per event kind, a nation key per user."""
    labels = F.create_map(*[F.lit(x) for pair in EVENT_LABELS.items() for x in pair])
    return table(spark, sf, "events").select(
        F.col("ts").alias("published_at"),
        F.pmod("user_id", F.lit(25)).cast("string").alias("subindustria_id"),
        F.try_element_at(labels, F.col("event_type")).alias("sentiment"),
        *columns,
    )


def nation_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    """Regions as industries, nations as sub-industries."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("industria_id"),
        F.col("n_nationkey").cast("string").alias("subindustria_id"),
        F.col("n_name").alias("subindustria_nombre"),
    )


def unit_price() -> Column:
    return F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100) / F.lit(100.0)


def supplier_bars(spark: SparkSession, sf: str) -> DataFrame:
    """One bar per supplier and ship date from line items, priced in whole cents."""
    price = unit_price()
    cents = F.floor(price * 100)
    # Order key, line and price as one number, so that all aggregates stay primitive.
    order = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * F.lit(100_000_000) + cents
    bars = (
        table(spark, sf, "lineitem")
        .groupBy("l_suppkey", "l_shipdate")
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum("l_quantity").alias("volume"),
        )
    )
    return bars.select(
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("S."), F.col("l_suppkey").cast("string")).alias("ticker"),
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


def landed_bars(spark: SparkSession, sf: str) -> DataFrame:
    """``supplier_bars`` as a stored table: numbering a series reads its bars twice."""
    return cut_lineage(supplier_bars(spark, sf))


def headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as news rows; the whole text stands for the title, and copies for news that repeat."""
    return table(spark, sf, "documents").select(
        "doc_id",
        strip(F.col("text")).alias("title"),
        F.col("lang").alias("news_summary"),
        "source",
        "text",
    )


def vectors(spark: SparkSession, sf: str, ident: str) -> DataFrame:
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias(ident), "embedding")


def labelled_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector as a category whose label is its sector."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("category_id"), F.col("label").cast("string").alias("sector"), "embedding"
    )


def label_centers(spark: SparkSession, sf: str) -> DataFrame:
    """Mean vector per label: (label, embedding). Stored, as it serves several passes."""
    centers = (
        table(spark, sf, "embeddings")
        .select("label", F.posexplode("embedding").alias("at", "x"))
        .groupBy("label", "at")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("label")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("embedding"))
    )
    return cut_lineage(centers)


def group_centers(spark: SparkSession, sf: str) -> DataFrame:
    """Fifty categories, whatever the size: mean vectors of each label's vectors by their number modulo five."""
    group = (F.col("label") * 5 + F.pmod("vec_id", F.lit(5))).cast("long")
    centers = (
        table(spark, sf, "embeddings")
        .select(group.alias("category_id"), F.posexplode("embedding").alias("at", "x"))
        .groupBy("category_id", "at")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy("category_id")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("embedding"))
    )
    sector = F.floor(F.col("category_id") / 5).cast("string")
    return cut_lineage(centers.select("category_id", sector.alias("sector"), "embedding"))


# SQL counterparts of the tables above.

SQL_VALUE = (
    "CASE WHEN event_type IN ('purchase', 'signup') THEN 1.0 "
    "WHEN event_type IN ('view', 'click') THEN 0.0 WHEN event_type = 'error' THEN -1.0 END"
)

SQL_BARS = """
items AS (
  SELECT l_shipdate AS t, 'S-' || l_suppkey AS ticker, l_returnflag AS flag, l_quantity AS q,
         floor(l_extendedprice / l_quantity * 100) / 100.0::DOUBLE AS p, l_orderkey, l_linenumber
  FROM lineitem),
bars AS (
  SELECT t, ticker, arg_min(p, (l_orderkey, l_linenumber, p)) AS o, max(p) AS h, min(p) AS l,
         arg_max(p, (l_orderkey, l_linenumber, p)) AS c, sum(q) AS v
  FROM items GROUP BY 1, 2)
"""

SQL_HEADLINES = r"""
headlines AS (
  SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS title, lang AS news_summary, source, text
  FROM documents)
"""

SQL_CENTERS = """
parts AS (
  SELECT label, pos, avg(embedding[pos]::DOUBLE) AS x
  FROM embeddings, range(1, 65) r(pos) GROUP BY 1, 2),
centers AS (SELECT label, list(x ORDER BY pos) AS embedding FROM parts GROUP BY 1)
"""

SQL_GROUPS = """
group_parts AS (
  SELECT label, vec_id % 5 AS part, pos, avg(embedding[pos]::DOUBLE) AS x
  FROM embeddings, range(1, 65) r(pos) GROUP BY 1, 2, 3),
cats AS (
  SELECT label * 5 + part AS id, label, list(x ORDER BY pos) AS v FROM group_parts GROUP BY 1, 2)
"""


def sql_visible(html: str) -> str:
    """Readable page text in DuckDB; enough for pages whose blocks do not nest."""
    out = f"regexp_replace({html}, '(?s)<!--.*?-->', chr(1), 'g')"
    for name in ("script", "style", "header", "footer", "nav", "noscript"):
        out = rf"regexp_replace({out}, '(?is)<{name}\b[^>]*>.*?</{name}\s*>', chr(1), 'g')"
    out = f"regexp_replace({out}, '(?s)<[^>]*>', chr(1), 'g')"
    for entity, text in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        out = f"replace({out}, '{entity}', '{text}')"
    pieces = rf"list_transform(string_split({out}, chr(1)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g'))"
    return f"array_to_string(list_filter({pieces}, lambda p: p <> ''), ' ')"
