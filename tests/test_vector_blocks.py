"""Pairs by bounds, and the stored index of cells."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparksignal.operators import cell_index
from sparksignal.operators.cell_index import add_to_index, build_index, fit_probes, index_centers, probed_members, search_index
from sparksignal.functions.vectors import unit
from sparksignal.operators import similarity
from sparksignal.operators.similarity import _best_picks, bounded_pairs, recall_against, top_k_join
from sparksignal.session import shared_dir
from sparksignal.workload.tables import quickly_rounded

SCHEMA = "vec_id long, embedding array<double>"


def clustered(seed, clusters, each, spread, width=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, width))
    return np.concatenate([c + spread * rng.normal(size=(each, width)) for c in centers])


def plain_pairs(vectors, score):
    length = np.linalg.norm(vectors, axis=1)
    unit = vectors / np.where(length > 0, length, 1)[:, None]
    cosines = unit @ unit.T
    return {(i, j) for i, j in zip(*np.nonzero(cosines >= score), strict=True) if i < j}


@pytest.mark.parametrize("spread,score", [(0.05, 0.9), (0.3, 0.5), (3.0, 0.2), (0.05, -1.0)])
def test_pairs_equal_brute_force(spark, spread, score):
    vectors = clustered(1, 12, 15, spread)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [])]
    found = bounded_pairs(spark.createDataFrame(rows, SCHEMA), score, piece_rows=20)
    assert sorted((r["id_a"], r["id_b"]) for r in found.pairs.collect()) == sorted(plain_pairs(vectors, score))
    assert found.possible == 180 * 179 // 2 and found.compared <= found.possible
    if spread == 0.05 and score > 0:
        # Tight groups leave most pairs out without comparing them.
        assert found.compared < found.possible / 3
    if score == -1.0:
        assert found.compared == found.possible


def test_pairs_of_few_and_odd_vectors(spark):
    assert bounded_pairs(spark.createDataFrame([], SCHEMA), 0.5).pairs.collect() == []
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, [-1.0, 0.0]), (5, [1.0, 0.0])]
    found = bounded_pairs(spark.createDataFrame(rows, SCHEMA), 0.99)
    assert sorted((r["id_a"], r["id_b"]) for r in found.pairs.collect()) == [(1, 2), (1, 5), (2, 5)]


@pytest.mark.parametrize("piece_rows", [1, 37, 400])
def test_a_large_cell_of_copies_meets_itself_in_parts(spark, piece_rows):
    vectors = np.concatenate([np.tile([[1.0, 2.0, 0.5]], (90, 1)), clustered(4, 3, 20, 0.4, width=3)])
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    found = bounded_pairs(spark.createDataFrame(rows, SCHEMA), 0.8, cells=4, piece_rows=piece_rows).pairs.collect()
    assert sorted((r["id_a"], r["id_b"]) for r in found) == sorted(plain_pairs(vectors, 0.8))


def test_vectors_are_not_stored_once_per_pair_of_cells(spark):
    folder = shared_dir(spark)
    vectors = np.random.default_rng(6).normal(size=(900, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA)
    before = stored_bytes(folder)
    found = bounded_pairs(rows, 0.2)
    # Thirty cells that all meet: some copies of the table may be stored, thirty may not.
    assert found.compared > 0.9 * found.possible and stored_bytes(folder) - before < 10 * vectors.nbytes
    assert found.pairs.count() == len(plain_pairs(vectors, 0.2))
    assert stored_bytes(folder) - before < 10 * vectors.nbytes


@pytest.mark.parametrize("spread,score", [(0.05, 0.9), (3.0, 0.2)])
def test_vectors_are_not_shuffled_to_the_blocks_they_meet(spark, spread, score, monkeypatch):
    vectors = clustered(5, 10, 30, spread)
    rows = spark.createDataFrame([(f"v{i:03d}", v.tolist()) for i, v in enumerate(vectors)], "vec_id string, embedding array<double>")
    context, sent = type(spark.sparkContext), []
    plain = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: (sent.append(value), plain(self, value))[1])
    # Blocks of 40 vectors, and cells cut at 25.
    found = bounded_pairs(rows, score, piece_rows=25, max_bytes=8 * 16 * 40).pairs
    assert "Exchange" not in found._jdf.queryExecution().toString()
    blocks = [value[0] for value in sent if len(value) == 6]
    assert len(blocks) >= 5 and sum(map(len, blocks)) == 300 and max(map(len, blocks)) <= 80
    pairs = found.collect()
    assert sorted((int(r["id_a"][1:]), int(r["id_b"][1:])) for r in pairs) == sorted(plain_pairs(vectors, score))


def test_tiles_give_the_same_scores(monkeypatch):
    monkeypatch.setattr(similarity, "TILE_ROWS", 7)
    monkeypatch.setattr(similarity, "TILE_SCORES", 60)
    vectors = clustered(7, 5, 8, 0.5, width=4)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[3], vectors[20] = 0.0, np.nan
    block, places = vectors[::-1].copy(), np.r_[0:9, 12:40]
    found = {(x, y): s for rows, picks, scores in similarity._tiles(vectors, block, places, 0.4) for x, y, s in zip(rows, picks, scores, strict=True)}
    wanted = similarity._distance_scores("cosine")(vectors, block, (block**2).sum(axis=1))
    assert set(found) == {(x, y) for x, y in zip(*np.nonzero(wanted >= 0.4), strict=True) if y not in (9, 10, 11)}
    assert all(abs(s - wanted[at]) < 1e-14 for at, s in found.items())


def test_quick_rounding_and_unit_vectors(spark):
    rng = np.random.default_rng(2)
    odd = [0.0, -0.0, 0.2500005, 0.2500015, -0.0000005, 1e-7, -1e-7, 0.9999995, 999.9999995, 1e300, float("nan"), float("inf"), None]
    numbers = odd + [k / 2e6 for k in range(-3000, 3000)] + rng.uniform(-2, 2, 20000).tolist()
    rows = spark.createDataFrame([(x,) for x in numbers], "x double").select(quickly_rounded("x").alias("a"), F.round("x", 6).alias("b"))
    assert all(repr(r["a"]) == repr(r["b"]) for r in rows.collect())
    lists = [[3.0, 4.0], [0.0, 0.0], [], None, [1.0, None]]
    units = [r[0] for r in spark.createDataFrame([(x,) for x in lists], "x array<double>").select(unit(F.col("x"))).collect()]
    assert units == [[0.6, 0.8], [0.0, 0.0], [], None, [1.0, None]]


def stored_bytes(folder):
    return sum(p.stat().st_size for p in Path(folder.removeprefix("file:")).rglob("*.parquet"))


def test_probes_are_fitted_on_a_bounded_number_of_articles(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    vectors = np.random.default_rng(8).normal(size=(500, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    build_index(spark.createDataFrame(rows, "category_id long, embedding array<double>"), path, cells=12)
    asked = [(i, v[::-1].tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [])]
    articles = spark.createDataFrame(asked, "article_id long, embedding array<double>")
    compared = []
    plain = cell_index.probes_needed
    monkeypatch.setattr(cell_index, "probes_needed", lambda a, *rest, **named: (compared.append(a.count()), plain(a, *rest, **named))[1])
    whole, part = fit_probes(articles, path, 0.9), fit_probes(articles, path, 0.9, sample=200)
    assert compared == [500, 200] and abs(whole - part) <= 2
    assert fit_probes(articles.limit(0), path, 0.9) == 1


@pytest.mark.parametrize("depth", [1, 2, 5, 9])
def test_best_picks_equal_sorting_whole_rows(depth, monkeypatch):
    scores = np.round(np.random.default_rng(3).normal(size=(40, 9)), 1)
    scores[0], scores[1, 3:], scores[2], scores[3] = np.nan, np.nan, -np.inf, 0.5
    scores[4, :4], scores[4, 4:] = np.nan, -np.inf
    rows, picks = _best_picks(scores, depth)
    wanted = np.argsort(-scores, axis=1, kind="stable")[:, :depth]
    assert [sorted(picks[rows == r]) for r in range(40)] == [sorted(w) for w in wanted]
    sorts = []
    monkeypatch.setattr(np, "argsort", lambda *a, **k: sorts.append(a))
    clear = np.random.default_rng(4).normal(size=(30, 9))
    if depth < 9:
        _best_picks(clear, depth)
    assert not sorts


def partitions_read(df):
    """Partitions that scans by cell have read."""
    df.collect()
    read, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "Scan parquet" in node.nodeName() and node.metrics().contains("numPartitions"):
            read.append(node.metrics().apply("numPartitions").value())
    return read


def test_index_is_trained_once_and_read_in_part(spark, tmp_path):
    path = str(tmp_path / "index")
    vectors = clustered(3, 20, 30, 0.2)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "category_id long, embedding array<double>")
    build_index(table.where("category_id % 3 <> 0"), path, cells=25)
    before = sorted(map(str, index_centers(spark, path).collect()))
    add_to_index(table.where("category_id % 3 = 0"), path)
    assert sorted(map(str, index_centers(spark, path).collect())) == before
    assert spark.read.parquet(f"{path}/members").count() == 600
    rng = np.random.default_rng(9)
    asked = [(i, (vectors[i] + 0.1 * rng.normal(size=16)).tolist()) for i in range(0, 600, 4)]
    articles = spark.createDataFrame(asked, "article_id long, embedding array<double>")
    probes = fit_probes(articles.where("article_id % 20 <> 0"), path, 0.95)
    measured = articles.where("article_id % 20 = 0")
    found = search_index(measured, path, probes=probes)
    exact = top_k_join(measured, table, 1, article_id="article_id", category_id="category_id")
    assert recall_against(found, exact, "article_id", "category_id").first()["recall"] >= 0.9
    one = articles.where("article_id = 40")
    members = probed_members(one, path, 2)
    assert partitions_read(members) == [2]
    assert search_index(one, path, probes=2).count() == 1
    assert search_index(articles.limit(0), path, probes=2).count() == 0
