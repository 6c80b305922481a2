"""Vector similarity joins.

The category side is normally a taxonomy. It is measured first and cut into
chunks of a bounded size, in the order of its ids; each chunk travels to the
tasks as one matrix and articles are scored batch by batch, without any
shuffle. What an article has found is carried from chunk to chunk in its own
row, so the result does not depend on the number of chunks, and ids may repeat
or be NULL on either side.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.sentiment import softmax
from ..functions.vectors import cosine, unit
from ..session import cut_lineage

#: Bytes of one chunk of categories, other columns included.
MATRIX_BYTES = 128 * 1024 * 1024
SCORES_PER_STEP = 4_000_000
#: Rows of an output batch; article columns repeat with every hit.
EMITTED_ROWS = 16_384
PIECE_ROWS = 4096
#: Bytes of the vectors of one block of cells, which may be twice as large and travels to the tasks as one matrix.
BLOCK_BYTES = 32 * 1024 * 1024
#: Bytes of vectors in one of the files that meet the blocks.
FILE_BYTES = 8 * 1024 * 1024
#: Scores of pairs by blocks that are worked on at once, so few that they stay near the processor.
TILE_ROWS, TILE_SCORES = 1024, 524_288


@dataclass(frozen=True)
class Matrix:
    """Vectors in the order of their ids, with the other columns beside them."""

    vectors: np.ndarray
    columns: dict[str, pa.Array]

    @property
    def squares(self) -> np.ndarray:
        return (self.vectors**2).sum(axis=1)


def vectors_of(batch, name: str) -> np.ndarray:
    """A list column as a float64 matrix."""
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _present(df: DataFrame, vector: str) -> DataFrame:
    return df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0))


def category_chunks(
    categories: DataFrame, vector: str, order: str, max_bytes: int = MATRIX_BYTES
) -> Iterator[Matrix]:
    """The categories as matrices of about ``max_bytes`` each, ids ascending from chunk to chunk and NULL ids last.

    Vectors and all other columns are measured before anything is gathered.
    """
    rows = _present(categories, vector)
    others = [c for c in rows.columns if c != vector]
    each = 8 * F.size(vector) + F.coalesce(F.octet_length(F.to_json(F.struct(*others))), F.lit(0))
    total = rows.agg(F.sum(each.cast("long"))).first()[0] or 0
    wanted = max(1, math.ceil(total / max(1, max_bytes)))
    if wanted == 1:
        yield _matrix(rows, vector, order)
        return
    placed = rows.repartitionByRange(wanted, F.col(order).isNull(), order, F.xxhash64(vector))
    stored = cut_lineage(placed.withColumn("_chunk", F.spark_partition_id()))
    for chunk in range(wanted):
        yield _matrix(stored.where(F.col("_chunk") == chunk).drop("_chunk"), vector, order)


def _matrix(df: DataFrame, vector: str, order: str) -> Matrix:
    table = df.toArrow().sort_by(order)
    return Matrix(
        vectors_of(table, vector), {c: table.column(c).combine_chunks() for c in table.column_names if c != vector}
    )


def _pairwise_squares(a: np.ndarray, b: np.ndarray, b_squares: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(axis=1)[:, None] + b_squares[None, :] - 2.0 * (a @ b.T)
    return np.maximum(squares, 0.0)


def _distance_scores(formula: str) -> Callable:
    if formula not in ("cosine", "legacy"):
        raise ValueError("formula must be cosine or legacy")

    def scores(a: np.ndarray, b: np.ndarray, b_squares: np.ndarray) -> np.ndarray:
        squares = _pairwise_squares(a, b, b_squares)
        return 1.0 - squares / 2.0 if formula == "cosine" else 1.0 - squares * squares / 2.0

    return scores


def _mean_cosines(a: np.ndarray, b: np.ndarray, _) -> np.ndarray:
    """Unit article vectors times the categories as they are."""
    length = np.sqrt((a**2).sum(axis=1))[:, None]
    return (a @ b.T) / np.where(length > 0, length, 1.0)


def _steps(rows: int, width: int) -> Iterator[slice]:
    step = max(1, SCORES_PER_STEP // max(1, width))
    return (slice(i, min(i + step, rows)) for i in range(0, rows, step))


def _added_fields(articles: DataFrame, categories: DataFrame, vector: str, score: str) -> list[T.StructField]:
    kept = {f.name for f in articles.schema if f.name != vector}
    added = [T.StructField(f.name, f.dataType, True) for f in categories.schema if f.name != vector]
    clash = kept & {f.name for f in added}
    if clash:
        raise ValueError(f"rename columns present on both sides: {sorted(clash)}")
    return [*added, T.StructField(score, T.DoubleType())]


def _kept_fields(articles: DataFrame, vector: str) -> list[T.StructField]:
    return [T.StructField(f.name, f.dataType, True) for f in articles.schema if f.name != vector]


def threshold_join(
    articles: DataFrame,
    categories: DataFrame,
    threshold: float,
    *,
    article_id: str,
    category_id: str,
    vector: str = "embedding",
    formula: str = "cosine",
    score: str = "confidence_score",
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """One row per (article, category) pair whose score reaches the threshold.

    Every article meets every category. Both tables hold their vector in a
    column of the same name; all other columns are kept.
    """
    return _threshold_join(articles, categories, threshold, category_id, vector, formula, score, max_bytes)


def _threshold_join(
    articles: DataFrame,
    categories: DataFrame,
    threshold: float,
    category_id: str,
    vector: str,
    formula: str,
    score: str,
    max_bytes: int,
    ordered_by: str | None = None,
) -> DataFrame:
    """With ``ordered_by`` only pairs with the lower id on the left."""
    score_of = _distance_scores(formula)
    kept, added = _kept_fields(articles, vector), _added_fields(articles, categories, vector, score)
    schema = T.StructType([*kept, *added])

    def join_chunk(chunk: Matrix) -> DataFrame:
        shared = articles.sparkSession.sparkContext.broadcast((chunk.vectors, chunk.squares, chunk.columns))

        def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            side, squares, columns = shared.value
            if not len(side):
                return
            for batch in batches:
                left = vectors_of(batch, vector)
                for part in _steps(len(left), len(side)):
                    source = batch.slice(part.start, part.stop - part.start)
                    scores = score_of(left[part], side, squares)
                    near = scores >= threshold
                    if ordered_by is not None:
                        near &= source.column(ordered_by).to_numpy()[:, None] < columns[category_id].to_numpy()[None, :]
                    rows, picks = np.nonzero(near)
                    for at in range(0, len(rows), EMITTED_ROWS):
                        r, p = rows[at : at + EMITTED_ROWS], picks[at : at + EMITTED_ROWS]
                        data = {f.name: source.column(f.name).take(pa.array(r)) for f in kept}
                        data |= {f.name: columns[f.name].take(pa.array(p)) for f in added[:-1]}
                        yield pa.RecordBatch.from_pydict({**data, score: pa.array(scores[r, p])})

        return _present(articles, vector).mapInArrow(match, schema)

    joined = None
    for chunk in category_chunks(categories, vector, category_id, max_bytes):
        hits = join_chunk(chunk)
        joined = hits if joined is None else joined.unionByName(hits)
    return joined


def _best_picks(scores: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the ``depth`` best scores of each row, NaN after all others; of equal scores, those before come first.

    Rows are sorted only if all is asked for, or an equal score stands at the last place.
    """
    everyone = np.arange(len(scores))
    ranked = np.where(np.isnan(scores), -np.inf, scores)
    if depth == 1:
        picks = ranked.argmax(axis=1)
        # A row of no number and of the least one takes the number.
        for row in np.flatnonzero(np.isnan(scores[everyone, picks])):
            picks[row] = np.argsort(-scores[row], kind="stable")[0]
        return everyone, picks
    if depth < scores.shape[1]:
        last = np.partition(ranked, -depth, axis=1)[:, -depth]
        near = ranked >= last[:, None]
        if near.sum() == depth * len(scores):
            return np.nonzero(near)
    return np.repeat(everyone, depth), np.argsort(-scores, axis=1, kind="stable")[:, :depth].ravel()


def _found_per_article(
    articles: DataFrame,
    categories: DataFrame,
    category_id: str,
    vector: str,
    score_of: Callable,
    score: str,
    out: str,
    max_bytes: int,
    *,
    threshold: float | None = None,
    best: int | None = None,
) -> DataFrame:
    """One row per article with what it found in the array ``out``: all scores from ``threshold`` on, or the ``best``.

    The array grows, or is merged, chunk by chunk; at equal scores the category
    that comes first in the order of ids stays ahead.
    """
    kept, added = _kept_fields(articles, vector), _added_fields(articles, categories, vector, score)
    entry = T.StructType(added)
    schema = T.StructType([*kept, articles.schema[vector], T.StructField(out, T.ArrayType(entry))])
    carried = _present(articles, vector).select(*[f.name for f in kept], vector)
    carried = carried.withColumn(out, F.array().cast(T.ArrayType(entry)))

    def search(rows: DataFrame, chunk: Matrix) -> DataFrame:
        shared = articles.sparkSession.sparkContext.broadcast((chunk.vectors, chunk.squares, chunk.columns))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            side, squares, columns = shared.value
            for batch in batches:
                left = vectors_of(batch, vector)
                if not len(side):
                    yield batch
                    continue
                for part in _steps(len(left), len(side)):
                    source = batch.slice(part.start, part.stop - part.start)
                    lists = _merged(score_of(left[part], side, squares), columns, source.column(out))
                    arrays = [lists if n == out else source.column(n) for n in source.schema.names]
                    yield pa.RecordBatch.from_arrays(arrays, names=source.schema.names)

        return rows.mapInArrow(run, schema)

    def _merged(scores: np.ndarray, columns: dict, before: pa.ListArray) -> pa.ListArray:
        """Lists of earlier finds and those of this chunk."""
        if best is not None:
            rows, picks = _best_picks(scores, min(best, scores.shape[1]))
        else:
            rows, picks = np.nonzero(scores >= threshold)
        fresh = [columns[f.name].take(pa.array(picks)) for f in added[:-1]] + [pa.array(scores[rows, picks])]
        old = before.flatten()
        old_rows = np.repeat(np.arange(len(scores)), before.value_lengths().to_numpy(zero_copy_only=False))
        parts = [pa.concat_arrays([old.field(k).cast(x.type), x]) for k, x in enumerate(fresh)]
        owner = np.concatenate([old_rows, rows])
        value = parts[-1].to_numpy(zero_copy_only=False)
        order = np.lexsort((np.arange(len(owner)), -value, owner)) if best is not None else np.argsort(owner, kind="stable")
        sizes = np.bincount(owner, minlength=len(scores))
        if best is not None:
            place = np.arange(len(owner)) - np.repeat(np.concatenate([[0], sizes.cumsum()[:-1]]), sizes)
            order = order[place < best]
            sizes = np.minimum(sizes, best)
        entries = pa.StructArray.from_arrays([p.take(pa.array(order)) for p in parts], names=[f.name for f in added])
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], sizes.cumsum()]).astype(np.int32)), entries)

    for number, chunk in enumerate(category_chunks(categories, vector, category_id, max_bytes)):
        carried = search(cut_lineage(carried) if number else carried, chunk)
    return carried.select(*[f.name for f in kept], out)


def label_lists(
    articles: DataFrame,
    categories: DataFrame,
    threshold: float,
    *,
    article_id: str,
    category_id: str,
    vector: str = "embedding",
    formula: str = "cosine",
    score: str = "confidence_score",
    out: str = "labels",
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """``threshold_join`` with all hits of an article in one array; articles without a hit are left out.

    Keeps one row per article, so later work per article needs no exchange.
    """
    found = _found_per_article(
        articles, categories, category_id, vector, _distance_scores(formula), score, out, max_bytes, threshold=threshold
    )
    return found.where(F.size(out) > 0)


def pairwise_similarity(
    df: DataFrame,
    min_score: float,
    *,
    ident: str = "vec_id",
    vector: str = "embedding",
    score: str = "cosine",
    block: str | None = None,
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """Pairs (id_a < id_b) of one table whose cosine reaches ``min_score``.

    Every row meets every other, chunk by chunk. With ``block`` only rows that
    agree in that column meet: they are compared in pieces of bounded size.
    """
    rows = _present(df, vector)
    names = {"id_a": F.col(ident), vector: unit(F.col(vector))}
    if block is None:
        left = rows.select(*[c.alias(n) for n, c in names.items()])
        return _threshold_join(
            left, left.withColumnRenamed("id_a", "id_b"), min_score, "id_b", vector, "cosine", score, max_bytes, "id_a"
        )
    left = rows.where(F.col(block).isNotNull()).select(*[c.alias(n) for n, c in names.items()], F.col(block).alias("_cell"))
    right = left.select(F.col("id_a").alias("id_b"), F.col(vector), F.col("_cell"))
    score_of = _distance_scores("cosine")

    def pick(a: np.ndarray, b: np.ndarray, squares: np.ndarray, piece: pa.Table, other: pa.Table):
        scores = score_of(a, b, squares)
        lower = piece.column("id_a").to_numpy()[:, None] < other.column("id_b").to_numpy()[None, :]
        found = np.nonzero((scores >= min_score) & lower)
        return *found, scores[found]

    return _by_pieces(left, right, "id_a", "id_b", vector, score, pick, PIECE_ROWS)


def top_k_join(
    articles: DataFrame,
    categories: DataFrame,
    k: int = 1,
    *,
    article_id: str,
    category_id: str,
    vector: str = "embedding",
    formula: str = "cosine",
    score: str = "confidence_score",
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """The ``k`` nearest categories of every article, best first in ``rank``.

    Equal scores go to the lower category id. No threshold applies.
    """
    found = _found_per_article(
        articles, categories, category_id, vector, _distance_scores(formula), score, "_best", max_bytes, best=k
    )
    kept = [f.name for f in _kept_fields(articles, vector)]
    entries = found.select(*kept, F.posexplode("_best").alias("_at", "_hit"))
    return entries.select(*kept, "_hit.*", (F.col("_at") + 1).alias("rank"))


def ranked_labels(
    ranked: DataFrame, article_id: str, labels: Sequence[str], threshold: float, score: str = "confidence_score"
) -> DataFrame:
    """One row per article: its labels best first, the best score, and a flag."""
    entries = F.sort_array(F.collect_list(F.struct("rank", *labels, score)))
    return ranked.groupBy(article_id).agg(entries.alias("labels"), F.max(score).alias("best_score")).withColumn(
        "classified", F.col("best_score") >= threshold
    )


def list_count(vectors: int) -> int:
    """Number of coarse cells for a table of this many vectors."""
    return max(50, vectors // 50)


def kmeans_centers(
    df: DataFrame, vector: str = "embedding", cells: int | None = None, rounds: int = 5, max_bytes: int = MATRIX_BYTES
) -> DataFrame:
    """Coarse cell centres (cell_id, centre) trained on the category vectors, as a table of any size.

    The first centres are distinct vectors in the order of a hash. Each round
    assigns every vector to its nearest centre and takes the mean per cell; a
    cell that gets no vector is dropped.
    """
    rows = _present(df, vector).select(F.col(vector).cast("array<double>").alias(vector))
    wanted = cells or list_count(rows.count())
    distinct = rows.distinct().orderBy(F.xxhash64(vector), F.col(vector)).limit(wanted)
    centers = cut_lineage(distinct.select(F.xxhash64(vector).alias("cell_id"), F.col(vector).alias("centre")))
    for _ in range(rounds):
        nearest = cell_probes(rows, centers, vector, 1, max_bytes)
        means = nearest.groupBy("_cell").agg(Summarizer.mean(array_to_vector(F.col(vector))).alias("m"))
        centers = cut_lineage(means.select(F.col("_cell").alias("cell_id"), vector_to_array("m").alias("centre")))
    return centers


def cell_probes(df: DataFrame, centers: DataFrame, vector: str, count: int, max_bytes: int = MATRIX_BYTES) -> DataFrame:
    """Each row once for each of its ``count`` nearest cells, named in ``_cell``."""
    cells = centers.select(F.col("cell_id").alias("_cell"), F.col("centre").alias("_centre"))
    copied = df.withColumn("_centre", F.col(vector))
    near = top_k_join(
        copied, cells, count, article_id="_cell", category_id="_cell", vector="_centre", score="_near", max_bytes=max_bytes
    )
    return near.select(*df.columns, "_cell")


def _by_pieces(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    vector: str,
    score: str,
    pick: Callable,
    piece_rows: int,
) -> DataFrame:
    """Rows of equal ``_cell`` compared in pieces of about ``piece_rows`` rows on both sides.

    ``pick`` gets vectors and rows of two pieces and returns row numbers on both
    sides and scores. Large cells are split by a hash of the key and vector, and
    every pair of pieces is one bounded group.
    """
    kept = [f for f in left.schema if f.name not in (vector, "_cell")]
    added = [f for f in right.schema if f.name not in (vector, "_cell")]
    schema = T.StructType([*kept, *added, T.StructField(score, T.DoubleType())])

    def pieces(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
        return counts.select("_cell", F.ceil(F.col("_n") / piece_rows).cast("int").alias(name))

    # Cells that one side lacks have no pairs.
    sizes = pieces(left, "_ln").join(pieces(right, "_rn"), "_cell")

    def cut(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        mine, theirs = ("_ln", "_rn") if own == "_lp" else ("_rn", "_ln")
        return (
            df.join(sizes, "_cell")
            .withColumn(own, F.pmod(F.xxhash64(key, vector), F.col(mine)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
            .drop("_ln", "_rn")
        )

    def match(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by(right_key)
        va, vb = vectors_of(a, vector), vectors_of(b, vector)
        squares = (vb**2).sum(axis=1) if len(vb) else None
        tables = []
        for part in _steps(len(va), len(vb)) if len(va) and len(vb) else ():
            piece = a.slice(part.start, part.stop - part.start)
            rows, picks, scores = pick(va[part], vb, squares, piece, b)
            data = {f.name: piece.column(f.name).take(pa.array(rows)) for f in kept}
            data |= {f.name: b.column(f.name).take(pa.array(picks)) for f in added}
            tables.append(pa.Table.from_pydict({**data, score: pa.array(scores)}))
        if not tables:
            data = {f.name: a.column(f.name).slice(0, 0) for f in kept} | {f.name: b.column(f.name).slice(0, 0) for f in added}
            return pa.Table.from_pydict({**data, score: pa.array([], pa.float64())})
        return pa.concat_tables(tables)

    keys = ["_cell", "_lp", "_rp"]
    # Aliased afresh, in case both sides come from one table.
    other = right.select(*[F.col(c).alias(c) for c in right.columns])
    first, second = cut(left, left_key, "_lp", "_rp"), cut(other, right_key, "_rp", "_lp")
    return first.groupBy(*keys).cogroup(second.groupBy(*keys)).applyInArrow(match, schema)


def cell_top1_join(
    articles: DataFrame,
    categories: DataFrame,
    centers: DataFrame,
    *,
    article_id: str,
    category_id: str,
    vector: str = "embedding",
    probes: int = 1,
    formula: str = "cosine",
    score: str = "confidence_score",
    piece_rows: int = PIECE_ROWS,
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """Approximate nearest category: only the nearest ``probes`` cells are searched.

    Candidates inside the probed cells are compared exactly. Cells are split
    into bounded pieces on both sides, and the best piece result wins; equal
    scores go to the lower category id. Rows are numbered first, so ids may repeat
    or be NULL; articles whose cells hold no category are left out.
    """
    added = _added_fields(articles, categories, vector, score)
    score_of = _distance_scores(formula)
    names = [f.name for f in (*_kept_fields(articles, vector), *added)]
    left = cut_lineage(_present(articles, vector).withColumn("_a", F.monotonically_increasing_id()))
    right = cut_lineage(_present(categories, vector).withColumn("_c", F.monotonically_increasing_id()))
    # Only numbers, ids and vectors are copied to cells and pieces.
    members = cell_probes(right.select("_c", category_id, vector), centers, vector, 1, max_bytes)
    seekers = cell_probes(left.select("_a", vector), centers, vector, probes, max_bytes)

    def nearest(a: np.ndarray, b: np.ndarray, squares: np.ndarray, piece: pa.Table, other: pa.Table):
        scores = score_of(a, b, squares)
        best = scores.argmax(axis=1)
        rows = np.arange(len(best))
        return rows, best, scores[rows, best]

    hits = _by_pieces(cut_lineage(seekers), cut_lineage(members), "_a", category_id, vector, score, nearest, piece_rows)
    rank = F.struct((-F.col(score)).alias("s"), F.col(category_id).isNull().alias("n"), F.col(category_id).alias("i"), "_c")
    best = hits.groupBy("_a").agg(F.min_by(F.struct("_c", score), rank).alias("_best")).select("_a", "_best.*")
    return best.join(left.drop(vector), "_a").join(right.drop(vector), "_c").select(*names)


def probes_needed(
    articles: DataFrame,
    categories: DataFrame,
    centers: DataFrame,
    *,
    article_id: str,
    category_id: str,
    vector: str = "embedding",
    formula: str = "cosine",
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """(article_id, probes): how many cells, nearest first, an article searches until the one of its exact nearest category.

    Cells stand in the order of ``cell_probes``. An article's cells are ranked inside its own row.
    """
    members = cell_probes(categories.select(category_id, vector), centers, vector, 1, max_bytes)
    copied = articles.select(F.col(article_id).alias("_a"), vector, F.col(vector).alias("_centre"))
    nearest = top_k_join(
        copied, members, 1, article_id="_a", category_id=category_id, vector=vector, formula=formula, max_bytes=max_bytes
    )
    cells = cut_lineage(centers.select(F.col("cell_id").alias("_other"), F.col("centre").alias("_centre")))
    ranked = _found_per_article(
        nearest.select("_a", "_centre", "_cell"),
        cells,
        "_other",
        "_centre",
        _distance_scores("cosine"),
        "_near",
        "_order",
        max_bytes,
        best=cells.count(),
    )
    place = F.array_position(F.transform("_order", lambda c: c["_other"]), F.col("_cell"))
    return ranked.select(F.col("_a").alias(article_id), place.alias("probes"))


def probes_for_recall(needed: DataFrame, target: float) -> int:
    """The least number of probes with which a share ``target`` of the articles of ``probes_needed`` is answered exactly; 1 if there are none."""
    return int(needed.agg(F.expr(f"percentile_disc({target!r}) WITHIN GROUP (ORDER BY probes)")).first()[0] or 1)


def recall_against(approximate: DataFrame, exact: DataFrame, article_id: str, category_id: str) -> DataFrame:
    """Share of articles whose approximate nearest category is the exact one."""
    found = approximate.select(article_id, F.col(category_id).alias("_found"))
    return exact.join(found, article_id, "left").agg(
        F.count(F.lit(1)).alias("articles"),
        F.count("_found").alias("answered"),
        F.sum(F.coalesce(F.col(category_id) == F.col("_found"), F.lit(False)).cast("long")).alias("matched"),
    ).select("articles", "answered", "matched", F.try_divide("matched", "articles").alias("recall"))


def sector_centroids(categories: DataFrame, sector: str, vector: str = "embedding") -> DataFrame:
    """Mean of the unit category vectors per sector.

    The mean cosine to a sector's categories equals the article's unit vector
    times this mean, so an article meets sectors instead of categories.
    """
    return (
        _present(categories, vector)
        .select(sector, F.posexplode(unit(F.col(vector))).alias("_at", "_x"))
        .groupBy(sector, "_at")
        .agg(F.avg("_x").alias("_x"))
        .groupBy(sector)
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("_at", "_x"))), lambda p: p["_x"]).alias(vector))
    )


def sector_probabilities(
    articles: DataFrame,
    categories: DataFrame,
    *,
    sector: str = "sector",
    vector: str = "embedding",
    temperature: float = 0.03,
    max_bytes: int = MATRIX_BYTES,
) -> DataFrame:
    """Mean cosine per (article, sector) and its softmax over the sectors.

    An empty taxonomy gives an empty result.
    """
    centroids = sector_centroids(categories, sector, vector)
    kept = [f.name for f in _kept_fields(articles, vector)]
    scored = _found_per_article(
        articles, centroids, sector, vector, _mean_cosines, "score", "_sectors", max_bytes, threshold=-math.inf
    )
    shares = softmax(F.transform("_sectors", lambda s: s["score"]), temperature)
    both = F.arrays_zip(F.col("_sectors").alias("s"), F.col("_probs").alias("p"))
    rows = scored.withColumn("_probs", shares).select(*kept, F.explode(both).alias("_row"))
    return rows.select(*kept, f"_row.s.{sector}", "_row.s.score", F.col("_row.p").alias("probability"))


def _cells_of(rows: DataFrame, vector: str, cells: int | None, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(rows with ``_cell``, cells with their centre and radius): about sqrt(n) cells, radii as angles."""
    wanted = cells or max(1, math.ceil(math.sqrt(rows.count())))
    centers = kmeans_centers(rows, vector, wanted, rounds=3, max_bytes=max_bytes)
    centers = cut_lineage(centers.select("cell_id", unit(F.col("centre")).alias("centre")))
    placed = cut_lineage(cell_probes(rows, centers, vector, 1, max_bytes))
    with_centre = placed.join(centers.withColumnRenamed("cell_id", "_cell"), "_cell")
    radius = F.max(_angle(cosine(F.col(vector), F.col("centre"))))
    sizes = with_centre.groupBy("_cell").agg(radius.alias("radius"), F.count(F.lit(1)).alias("size"))
    return placed, cut_lineage(sizes.join(centers.withColumnRenamed("cell_id", "_cell"), "_cell"))


def _angle(cosine_: Column) -> Column:
    return F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), cosine_)))


#: Angles are known up to so much; bounds are wider by it, so that rounding skips nothing.
_ROUNDING = 1e-6


def _near_cells(cells: DataFrame, min_score: float, max_bytes: int) -> DataFrame:
    """Pairs (cell_a <= cell_b) that may hold vectors as close as ``min_score``.

    The angle between two vectors is at least that between their centres, less
    both radii.
    """
    widest = cells.agg(F.max("radius")).first()[0] or 0.0
    reach = math.acos(max(-1.0, min(1.0, min_score))) + _ROUNDING
    least = math.cos(min(math.pi, reach + 2 * widest))
    left = cells.select(F.col("_cell").alias("cell_a"), F.col("radius").alias("radius_a"), F.col("size").alias("size_a"), "centre")
    right = cells.select(F.col("_cell").alias("cell_b"), F.col("radius").alias("radius_b"), F.col("size").alias("size_b"), "centre")
    # Scores carry rounding errors, too.
    met = _threshold_join(left, right, least - _ROUNDING, "cell_b", "centre", "cosine", "_score", max_bytes)
    angle = _angle(F.col("_score"))
    return met.where((F.col("cell_a") <= F.col("cell_b")) & (angle - F.col("radius_a") - F.col("radius_b") <= reach))


def _parts_of_cells(cells: DataFrame, part_rows: int, block_rows: int) -> DataFrame:
    """(cell, of, at, part, block): cells of more than ``part_rows`` vectors cut into ``of`` parts, which are numbered and packed into blocks of about ``block_rows`` vectors."""
    of = F.greatest(F.ceil(F.col("size") / part_rows), F.lit(1)).cast("int")
    parts = cells.select(F.col("_cell").alias("cell"), "size", of.alias("of")).withColumn("at", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
    # About sqrt(n) rows: few enough to number in one task.
    order = Window.orderBy("cell", "at")
    before = F.sum(F.col("size") / F.col("of")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    block = F.floor(F.coalesce(before, F.lit(0.0)) / block_rows).cast("int")
    return cut_lineage(parts.select("cell", "of", "at", F.row_number().over(order).cast("int").alias("part"), block.alias("block")))


def _block(members: DataFrame, met: DataFrame, vector: str) -> tuple:
    """Vectors, ids, parts and row numbers of ``members`` in the order of the latter two; then pairs of parts that meet, sorted."""
    table = members.toArrow().sort_by([("part", "ascending"), ("_row", "ascending")])
    pairs = met.toArrow().sort_by([("part", "ascending"), ("other", "ascending")])
    parts, rows, meeting, others = (t.column(c).to_numpy() for t, c in ((table, "part"), (table, "_row"), (pairs, "part"), (pairs, "other")))
    return vectors_of(table, vector), table.column("_id").combine_chunks(), parts, rows, meeting, others


def _places(part: int, parts: np.ndarray, meeting: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Rows of a block with these ``parts`` that ``part`` meets, ascending."""
    met = others[slice(*np.searchsorted(meeting, [part, part + 1]))]
    spans = zip(np.searchsorted(parts, met), np.searchsorted(parts, met + 1), strict=True)
    return np.concatenate([np.arange(0), *(np.arange(x, y) for x, y in spans)])


def _tiles(vectors: np.ndarray, block: np.ndarray, places: np.ndarray, min_score: float) -> Iterator[tuple]:
    """(rows of ``vectors``, rows of ``block``, scores) of pairs with one of ``places`` that reach the score, tile by tile."""
    for top in range(0, len(vectors), TILE_ROWS):
        a = vectors[top : top + TILE_ROWS]
        squares_a = (a**2).sum(axis=1)
        step = TILE_SCORES // len(a)
        for at in range(0, len(places), step):
            picked = places[at : at + step]
            # Rows that stand side by side need no copy.
            whole = picked[-1] - picked[0] + 1 == len(picked)
            b = block[picked[0] : picked[-1] + 1] if whole else block[picked]
            squares_b = (b**2).sum(axis=1)
            products = (a @ b.T).ravel()
            # 1 - (x + y - 2 p) / 2 is a score; with the least squares of the tile no pair that may reach it is left out.
            least = min_score - 1.0 + (np.fmin.reduce(squares_a) + np.fmin.reduce(squares_b)) / 2.0 - _ROUNDING
            near = np.flatnonzero(products >= least)
            x, y = np.divmod(near, len(b))
            scores = 1.0 - np.maximum(squares_a[x] + squares_b[y] - 2.0 * products[near], 0.0) / 2.0
            found = np.flatnonzero(scores >= min_score)
            yield x[found] + top, picked[y[found]], scores[found]


def _pairs_by_blocks(
    placed: DataFrame, parts: DataFrame, near: DataFrame, min_score: float, vector: str, score: str, files: int
) -> DataFrame:
    """Vectors (_id, vector, _cell) of cells that meet, compared block by block: (id_a, id_b, score).

    All rows are stored once more, in ``files`` files by parts, and every block travels to the tasks that read
    them; none is shuffled to the blocks it meets.
    """
    a, b = (parts.select(*[F.col(c).alias(f"{c}_{side}") for c in ("cell", "part")]) for side in "ab")
    met = near.select("cell_a", "cell_b").join(a, "cell_a").join(b, "cell_b")
    # Parts of one cell meet each other once; the higher part is in the block.
    met = met.where((F.col("cell_a") != F.col("cell_b")) | (F.col("part_a") <= F.col("part_b")))
    met = cut_lineage(met.select(F.least("part_a", "part_b").alias("part"), F.greatest("part_a", "part_b").alias("other")))
    # The parts of a cell follow each other.
    firsts = parts.groupBy(F.col("cell").alias("_cell")).agg(F.max("of").alias("of"), F.min("part").alias("from"))
    part = F.col("from") + F.pmod(F.xxhash64("_id", vector), F.col("of")).cast("int")
    known = placed.join(firsts, "_cell").select("_id", vector, part.alias("part"))
    spread = known.repartitionByRange(files, "part", F.xxhash64("_id")).sortWithinPartitions("part")
    stored = cut_lineage(spread.withColumn("_row", F.monotonically_increasing_id()))

    ident = placed.schema["_id"].dataType
    schema = T.StructType([T.StructField("id_a", ident), T.StructField("id_b", ident), T.StructField(score, T.DoubleType())])

    def meet(first: int, last: int) -> DataFrame:
        """Pairs with the parts from ``first`` to ``last``."""
        members, pairs = (df.where(F.col(c).between(first, last)) for df, c in ((stored, "part"), (met, "other")))
        shared = placed.sparkSession.sparkContext.broadcast(_block(members, pairs, vector))

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, block_ids, block_parts, block_rows, meeting, others = shared.value
            for batch in batches:
                ids, own, rows = batch.column("_id"), batch.column("part").to_numpy(), batch.column("_row").to_numpy()
                ends = np.flatnonzero(np.diff(own, append=-1)) + 1
                vectors = vectors_of(batch, vector)
                for start, end in zip([0, *ends], ends, strict=False):
                    places = _places(own[start], block_parts, meeting, others)
                    for x, y, scores in _tiles(vectors[start:end], block, places, min_score):
                        x = x + start
                        if own[start] >= first:
                            # Every two vectors of a part meet once.
                            once = (block_parts[y] != own[start]) | (block_rows[y] > rows[x])
                            x, y, scores = x[once], y[once], scores[once]
                        for k in range(0, len(x), EMITTED_ROWS):
                            at = slice(k, k + EMITTED_ROWS)
                            columns = [ids.take(pa.array(x[at])), block_ids.take(pa.array(y[at])), pa.array(scores[at])]
                            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return stored.where(F.col("part") <= last).mapInArrow(compare, schema)

    spans = parts.groupBy("block").agg(F.min("part").alias("first"), F.max("part").alias("last")).orderBy("block").collect()
    pairs = [meet(s["first"], s["last"]) for s in spans] or [placed.sparkSession.createDataFrame([], schema)]
    found = reduce(DataFrame.unionByName, pairs).where("id_a <> id_b")
    return found.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"), score)


@dataclass(frozen=True)
class BoundedPairs:
    """All pairs that reach the score, and how many pairs of vectors were compared, of how many."""

    pairs: DataFrame
    compared: int
    possible: int


def bounded_pairs(
    df: DataFrame,
    min_score: float,
    *,
    ident: str = "vec_id",
    vector: str = "embedding",
    score: str = "cosine",
    cells: int | None = None,
    piece_rows: int | None = None,
    max_bytes: int = MATRIX_BYTES,
) -> BoundedPairs:
    """Every pair (id_a < id_b) of the table whose cosine reaches ``min_score``, exactly.

    Vectors are put into about sqrt(n) cells around trained centres. Two cells
    meet only if the angle between their centres, less both radii, leaves room for
    such a pair; all others are skipped whole. Cells of more than ``piece_rows``
    vectors are cut, and cells are packed into blocks of 32 MB (or ``max_bytes``, if less) that travel to the tasks one
    by one, so vectors are stored and shuffled a fixed number of times however many they are. Vectors that are NULL
    or empty take no part; ids should be unique and of one type. The tighter the cells, the more is skipped: vectors
    without any clusters may leave nothing to skip.
    """
    rows = cut_lineage(_present(df, vector).select(F.col(ident).alias("_id"), unit(F.col(vector)).alias(vector)))
    placed, around = _cells_of(rows, vector, cells, max_bytes)
    near = cut_lineage(_near_cells(around, min_score, max_bytes))
    work = F.when(F.col("cell_a") == F.col("cell_b"), F.col("size_a") * (F.col("size_a") - 1) / 2).otherwise(F.col("size_a") * F.col("size_b"))
    compared = int(near.agg(F.sum(work)).first()[0] or 0)
    n, width = rows.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()

    each = 8 * (width or 1)
    block_rows = max(1, min(BLOCK_BYTES, max_bytes) // each)
    parts = _parts_of_cells(around, min(piece_rows or block_rows, block_rows), block_rows)
    files = max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(n * each / FILE_BYTES))
    pairs = _pairs_by_blocks(placed, parts, near, min_score, vector, score, files)
    return BoundedPairs(pairs, compared, n * (n - 1) // 2)
