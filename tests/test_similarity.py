import numpy as np
import pytest
from pyspark.sql import functions as F

from sparksignal.operators import similarity as sim
from sparksignal.operators.similarity import (
    cell_top1_join,
    kmeans_centers,
    label_lists,
    pairwise_similarity,
    probes_for_recall,
    probes_needed,
    ranked_labels,
    sector_probabilities,
    threshold_join,
    top_k_join,
)

IDS = {"article_id": "a", "category_id": "c"}


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    # A third of all categories are copies of one vector, as in a hot group.
    base = rng.normal(size=(60, 8))
    categories = np.vstack([base, np.repeat(base[:1], 30, axis=0)]).astype(np.float32)
    articles = rng.normal(size=(80, 8)).astype(np.float32)
    left = spark.createDataFrame(
        [(i, f"t{i}", [float(x) for x in v]) for i, v in enumerate(articles)], "a long, title string, embedding array<float>"
    )
    right = spark.createDataFrame(
        [(i, f"s{i % 4}", [float(x) for x in v]) for i, v in enumerate(categories)],
        "c long, sector string, embedding array<float>",
    )
    return left, right, articles.astype(float), categories.astype(float)


def scores(a, b):
    return 1 - ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2) / 2


@pytest.mark.parametrize("threshold", [-6.0, -2.0, 0.0, 2.0])
@pytest.mark.parametrize("max_bytes", [sim.MATRIX_BYTES, 1500])
def test_threshold_join_equals_brute_force(spark, data, threshold, max_bytes):
    left, right, a, b = data
    hits = threshold_join(left, right, threshold, **IDS, max_bytes=max_bytes).collect()
    s = scores(a, b)
    assert {(r["a"], r["c"]) for r in hits} == {(i, j) for i, j in zip(*np.nonzero(s >= threshold))}
    assert len(hits) == int((s >= threshold).sum())
    assert all(r["confidence_score"] == pytest.approx(s[r["a"], r["c"]], abs=1e-6) for r in hits)
    assert all(r["title"] == f"t{r['a']}" and r["sector"] == f"s{r['c'] % 4}" for r in hits)


def test_legacy_formula(spark, data):
    left, right, a, b = data
    squared = 2 * (1 - scores(a, b))
    expected = (1 - squared**2 / 2 >= -35.0).sum()
    for max_bytes in (sim.MATRIX_BYTES, 3000):
        hits = threshold_join(left, right, -35.0, **IDS, formula="legacy", max_bytes=max_bytes)
        assert hits.count() == expected
    with pytest.raises(ValueError):
        threshold_join(left, right, 0.0, **IDS, formula="other")


@pytest.mark.parametrize("max_bytes", [sim.MATRIX_BYTES, 64 * 20])
def test_top_k_breaks_ties_by_id(spark, data, max_bytes):
    left, right, a, b = data
    rows = top_k_join(left, right, 3, **IDS, max_bytes=max_bytes).collect()
    assert len(rows) == 3 * len(a)
    s = scores(a, b)
    for i in range(len(a)):
        best = sorted(range(len(b)), key=lambda j: (-round(s[i, j], 9), j))[:3]
        assert [r["c"] for r in sorted((r for r in rows if r["a"] == i), key=lambda r: r["rank"])] == best


def test_label_lists_match_threshold_join(spark, data):
    left, right, *_ = data
    for max_bytes in (sim.MATRIX_BYTES, 3000):
        lists = label_lists(left, right, -2.0, **IDS, max_bytes=max_bytes)
        flat = lists.select("a", "title", F.inline("labels")).select("a", "title", "c", "sector").collect()
        hits = threshold_join(left, right, -2.0, **IDS).select("a", "title", "c", "sector").collect()
        assert sorted(map(tuple, flat)) == sorted(map(tuple, hits))


def test_ranked_labels(spark, data):
    left, right, *_ = data
    ranked = top_k_join(left, right, 2, **IDS)
    rows = ranked_labels(ranked, "a", ["c"], 0.0).collect()
    assert len(rows) == 80
    assert all(r["classified"] == (r["best_score"] >= 0.0) and len(r["labels"]) == 2 for r in rows)


def test_pairs(spark, data):
    _, right, _, b = data
    unit = b / np.linalg.norm(b, axis=1)[:, None]
    s = unit @ unit.T
    expected = {(i, j) for i in range(len(b)) for j in range(i + 1, len(b)) if s[i, j] >= 0.4 - 1e-12}
    for max_bytes in (sim.MATRIX_BYTES, 3000):
        pairs = pairwise_similarity(right, 0.4, ident="c", max_bytes=max_bytes).collect()
        assert {(r["id_a"], r["id_b"]) for r in pairs} == expected
        assert len(pairs) == len(expected)


def test_cells_with_all_probes_are_exact(spark, data):
    left, right, *_ = data
    centers = kmeans_centers(right, cells=5)
    exact = top_k_join(left, right, 1, **IDS).select("a", "c").collect()
    for piece_rows in (4096, 6):
        found = cell_top1_join(left, right, centers, **IDS, probes=50, piece_rows=piece_rows).select("a", "c").collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, exact))
    assert centers.count() == 5
    one = cell_top1_join(left, right, centers, **IDS, probes=1)
    assert one.count() == 80


@pytest.mark.parametrize("max_bytes", [sim.MATRIX_BYTES, 64 * 20])
def test_probes_needed_reach_the_exact_nearest(spark, data, max_bytes):
    left, right, a, b = data
    centers = kmeans_centers(right, cells=12)
    rows = sorted(centers.collect(), key=lambda r: r["cell_id"])
    c = np.array([r["centre"] for r in rows])
    needed = probes_needed(left, right, centers, **IDS, max_bytes=max_bytes)
    got = {r["a"]: r["probes"] for r in needed.collect()}
    home = scores(b, c).argmax(axis=1)[scores(a, b).argmax(axis=1)]
    order = np.argsort(-scores(a, c), axis=1, kind="stable")
    assert got == {i: int(np.flatnonzero(order[i] == home[i])[0]) + 1 for i in range(len(a))}
    least = probes_for_recall(needed, 0.9)
    share = [sum(p <= n for p in got.values()) / len(got) for n in range(len(c) + 1)]
    assert share[least] >= 0.9 > share[least - 1]


def test_trained_cells_find_nine_tenths_of_the_nearest(spark):
    """Cells trained on all vectors, by the surveyed number of cells, against brute force over every vector."""
    from sparksignal.workload.registry import queries

    sf = "/root/testdata/sf0.001"
    row = queries()["trained_cell_recall"](spark, sf).first()
    table = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    assert row["vectors"] == len(table) and row["cells"] == sim.list_count(len(table))
    assert row["articles"] == row["answered"] == (table["vec_id"] % 20 == 0).sum()
    assert row["recall"] >= 0.9 and row["probes"] < row["cells"]
    assert row["recall"] == pytest.approx(row["matched"] / row["articles"], abs=1e-6)


def test_sector_probabilities(spark, data):
    left, right, a, b = data
    ua, ub = a / np.linalg.norm(a, axis=1)[:, None], b / np.linalg.norm(b, axis=1)[:, None]
    rows = sector_probabilities(left, right).collect()
    assert len(rows) == 80 * 4
    for i in (0, 7):
        mine = {r["sector"]: r for r in rows if r["a"] == i}
        means = {f"s{k}": (ua[i] @ ub[k::4].T).mean() for k in range(4)}
        assert {k: r["score"] for k, r in mine.items()} == pytest.approx(means, abs=1e-6)
        assert sum(r["probability"] for r in mine.values()) == pytest.approx(1.0)
    assert sector_probabilities(left, right.limit(0)).count() == 0


def test_empty_sides(spark, data):
    left, right, *_ = data
    assert threshold_join(left.limit(0), right, -9.0, **IDS).count() == 0
    assert threshold_join(left, right.limit(0), -9.0, **IDS).count() == 0
    assert threshold_join(left, right, 1.5, **IDS, max_bytes=3000).count() == 0


def odd_sides(spark):
    """Repeated, NULL and text ids, and many equal categories."""
    draw = np.random.default_rng(5)
    vectors = [[float(x) for x in v] for v in draw.normal(size=(9, 4))]
    left = [("1", "x", vectors[0]), ("1", "y", vectors[0]), (None, "z", vectors[1]), (None, "z", vectors[1]), ("2", "n", None)]
    right = [("c3", 1, vectors[2]), ("c3", 2, vectors[3]), (None, 3, vectors[4]), (None, 4, vectors[5])]
    right += [(f"t{i:03d}", 9, vectors[6]) for i in range(40)]
    return (
        spark.createDataFrame(left, "a string, title string, embedding array<double>"),
        spark.createDataFrame(right, "c string, n int, embedding array<double>"),
    )


@pytest.mark.parametrize("how", ["threshold", "lists", "top"])
def test_results_do_not_depend_on_the_number_of_chunks(spark, how):
    left, right = odd_sides(spark)

    def run(max_bytes):
        if how == "threshold":
            out = threshold_join(left, right, -4.0, **IDS, max_bytes=max_bytes)
        elif how == "lists":
            out = label_lists(left, right, -4.0, **IDS, max_bytes=max_bytes).select("a", "title", F.inline("labels"))
        else:
            out = top_k_join(left, right, 42, **IDS, max_bytes=max_bytes)
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in out.collect()), key=str)

    whole = run(sim.MATRIX_BYTES)
    assert whole and len({r[1] for r in whole}) == 3
    assert run(700) == run(150) == whole
    if how == "top":
        assert len(whole) == 4 * 42
        ties = [r for r in whole if r[1] == "x" and r[3] == 9]
        assert [r[2] for r in sorted(ties, key=lambda r: r[-1])] == [f"t{i:03d}" for i in range(len(ties))]


def test_cells_keep_text_ids_and_ties(spark):
    left, right = odd_sides(spark)
    exact = top_k_join(left, right, 1, **IDS).select("a", "title", "c", "n").collect()
    for rounds, piece_rows in ((1, 4096), (2, 3)):
        centers = kmeans_centers(right, cells=4, rounds=rounds)
        found = cell_top1_join(left, right, centers, **IDS, probes=9, piece_rows=piece_rows).select("a", "title", "c", "n")
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, exact), key=str)


def test_pairs_inside_blocks(spark, data):
    _, right, _, b = data
    unit = b / np.linalg.norm(b, axis=1)[:, None]
    s = unit @ unit.T
    expected = {(i, j) for i in range(90) for j in range(i + 1, 90) if s[i, j] >= 0.3 and i % 4 == j % 4}
    pairs = pairwise_similarity(right, 0.3, ident="c", block="sector").collect()
    assert {(r["id_a"], r["id_b"]) for r in pairs} == expected and len(pairs) == len(expected)
