"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(neighbours: DataFrame) -> DataFrame:
    """Each (a, b) with the least node among ``a`` and all its neighbours."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return neighbours.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the least node around it."""
    seen = _with_least(_both_ways(edges))
    return seen.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    seen = _with_least(down)
    return seen.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(seen.select("a", F.col("m").alias("b")))


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges, stored, and a number that names their set, found by the job that stores them."""
    seen = Observation()
    mix = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.bit_xor(F.xxhash64("b", "a")).alias("y")]
    stored = cut_lineage(edges.observe(seen, *mix))
    return stored, tuple(sorted(seen.get.items()))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node that links lead to.

    Large stars and small stars alternate until nothing changes; each round is
    one job that ends in a stored table, and holds as many edges as nodes at most
    after the first. A node with many neighbours meets them by one join key, as
    numbers only; the adaptive planner splits such a key. Self links and repeated
    links are allowed; NULL ends are ignored.
    """
    edges, before = _stored(edges.where("a <> b").select("a", "b").distinct())
    while True:
        edges, now = _stored(_small_star(_large_star(edges)).where("a <> b").distinct())
        # The stars are final once the set of edges stays the same.
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def joined_components(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, component), stored, after further ``links`` (a, b): whole components are linked, not their nodes anew."""
    if labels is None:
        return cut_lineage(connected_components(links))
    of_a = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    of_b = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    ends = links.join(of_a, "a", "left").join(of_b, "b", "left")
    tied = ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    moved = cut_lineage(connected_components(tied))
    new = moved.join(labels, "node", "left_anti")
    renamed = moved.select(F.col("node").alias("component"), F.col("component").alias("_to"))
    old = labels.join(renamed, "component", "left").select("node", F.coalesce("_to", "component").alias("component"))
    return cut_lineage(old.unionByName(new))
