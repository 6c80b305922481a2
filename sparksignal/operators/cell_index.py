"""A stored index of vectors: members partitioned by cell, so that a search reads the cells it probes and no others.

``centers`` holds the trained centres, numbered; ``members`` the vectors, one
partition per cell. Training happens once; vectors are added to the cells that
exist, and searches only read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .similarity import cell_probes, cell_top1_join, kmeans_centers, probes_for_recall, probes_needed

#: Articles that probes are fitted on, chosen by a hash of their id and vector: the share that finds its nearest is known to half a percent.
FITTED_ON = 4096
#: Tasks the chosen articles are spread over.
FIT_TASKS = 32

#: Columns of an indexed vector.
ID, VECTOR = "category_id", "embedding"


def build_index(vectors: DataFrame, path: str, *, cells: int | None = None, rounds: int = 5) -> None:
    """Train about sqrt(n) cells on the vectors and store them all at ``path``.

    ``vectors`` is (category_id, embedding, others); NULL and empty vectors are left out.
    """
    wanted = cells or max(1, math.ceil(math.sqrt(vectors.count())))
    trained = kmeans_centers(vectors, VECTOR, wanted, rounds)
    # As many centres as cells: few enough to number in one task.
    numbered = trained.select(F.row_number().over(Window.orderBy("cell_id")).cast("int").alias("cell_id"), "centre")
    numbered.write.parquet(f"{path}/centers")
    add_to_index(vectors, path)


def add_to_index(vectors: DataFrame, path: str) -> None:
    """Append vectors to the cells of their nearest centres; nothing is trained."""
    placed = cell_probes(vectors.where(F.size(VECTOR) > 0), index_centers(vectors.sparkSession, path), VECTOR, 1)
    placed.withColumnRenamed("_cell", "cell").repartition("cell").write.mode("append").partitionBy("cell").parquet(f"{path}/members")


def index_centers(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/centers")


def probed_members(articles: DataFrame, path: str, probes: int, vector: str = "embedding") -> DataFrame:
    """The indexed vectors in the cells that any article probes: the scan is pruned to their partitions."""
    spark = articles.sparkSession
    probed = cut_lineage(cell_probes(articles.select(vector), index_centers(spark, path), vector, probes).select(F.col("_cell").alias("cell")).distinct())
    # At most one row per cell, sqrt(n) of them; the comparison tells the planner that this side selects.
    return spark.read.parquet(f"{path}/members").join(F.broadcast(probed.where("cell > 0")), "cell", "left_semi")


def search_index(
    articles: DataFrame, path: str, *, probes: int, article_id: str = "article_id", vector: str = "embedding"
) -> DataFrame:
    """The nearest indexed vector of each article among the cells it probes, with its score; see ``cell_top1_join``."""
    members = probed_members(articles, path, probes, vector).drop("cell").withColumnRenamed(VECTOR, vector)
    centers = index_centers(articles.sparkSession, path)
    return cell_top1_join(articles, members, centers, article_id=article_id, category_id=ID, vector=vector, probes=probes)


def fit_probes(
    articles: DataFrame, path: str, target: float, article_id: str = "article_id", vector: str = "embedding", sample: int = FITTED_ON
) -> int:
    """Cells to probe so that a share ``target`` of these articles finds its nearest vector.

    Fit on other articles than those a recall is then measured with. At most
    ``sample`` of the articles are compared with every indexed vector, so the cost
    follows the index, not its square.
    """
    spark = articles.sparkSession
    chosen = articles.where(F.size(vector) > 0).select(article_id, vector).orderBy(F.xxhash64(article_id, vector)).limit(sample)
    # The limit leaves one partition; few vectors meet many, so each task takes few.
    articles = cut_lineage(chosen.repartition(FIT_TASKS))
    members = spark.read.parquet(f"{path}/members").drop("cell").withColumnRenamed(VECTOR, vector)
    needed = probes_needed(
        articles, members, index_centers(spark, path), article_id=article_id, category_id=ID, vector=vector
    )
    return probes_for_recall(needed, target)
