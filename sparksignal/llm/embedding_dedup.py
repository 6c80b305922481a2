"""Near-duplicate embeddings.

Equal vectors are first taken together. Random hyperplanes give each vector a
sign pattern in several tables; vectors that share a pattern are candidates and
their cosine is computed. Each bucket is cut into blocks and compared block by
block, so no task holds more than two blocks; a pair counts in the first table
where its patterns meet. Buckets return, per vector, how many others it links
with, and one tie per vector and block pair that keeps linked vectors together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import column, record_batch
from .components import connected_components

#: A pair at cosine 0.98 shares a pattern of 24 signs in one table with probability 0.2,
#: and in none of 48 tables with probability 2e-5.
BITS = 24
TABLES = 48
#: Vectors of a block; two blocks are compared at a time.
BLOCK = 1_000
SEED = 20240229

_SIGNS = pa.schema(
    [
        ("vec", pa.int64()),
        ("label", pa.int64()),
        ("w", pa.int64()),
        ("least", pa.int64()),
        ("signs", pa.list_(pa.int32())),
        ("packed", pa.binary()),
    ]
)
_FOUND = pa.schema([("vec", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])


def _planes(tables: int, bits: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((width, tables * bits))


def _units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that neither very large nor very small components leave the range of doubles."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled**2).sum(axis=1, keepdims=True))


def _signer(tables, bits, seed):
    """Adds the sign patterns, and vector of length one and patterns packed as bytes: so they travel with each bucket."""
    weights = (1 << np.arange(bits)).astype(np.int32)

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("v"))
            widths, flat = lists.value_lengths().to_numpy(), lists.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(widths) - widths
            signs, packed = [None] * len(widths), [None] * len(widths)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                if width not in planes:
                    planes[width] = _planes(tables, bits, width, seed)
                units = _units(flat[starts[rows, None] + np.arange(width)])
                side = (units @ planes[width] > 0).reshape(len(rows), tables, bits)
                for k, unit, s in zip(rows, units, (side @ weights).astype(np.int32), strict=True):
                    signs[k], packed[k] = s, unit.tobytes() + s.tobytes()
            yield record_batch(_SIGNS, *(batch.column(c) for c in range(4)), signs, packed)

    return run


def _tied(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Roots after tying ``p[k]`` and ``q[k]`` together for all k; a root is the first row of its group."""
    while True:
        a, b = root[p], root[q]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root[root] != root).any():
            root = root[root]


def _links(low: float, tables: int):
    def run(group: pa.Table) -> pa.Table:
        n = group.num_rows
        side = group.column("side").to_numpy()
        same_block = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        a = np.flatnonzero(~side)
        b = a if same_block else np.flatnonzero(side)
        if not len(a) or not len(b) or n < 2:
            return pa.Table.from_batches([], _FOUND)
        ids = group.column("vec").to_numpy()
        weights = group.column("w").to_numpy()
        table = group.column("table")[0].as_py()
        packed = group.column("packed").to_pylist()
        sizes = np.array([len(x) for x in packed])
        links, root = np.zeros(n, np.int64), np.arange(n)
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            raw = np.frombuffer(b"".join([packed[k] for k in at]), np.uint8).reshape(len(at), size)
            vectors = raw[:, : size - 4 * tables].copy().view(np.float64)
            signs = raw[:, size - 4 * tables :].copy().view(np.int32)
            # Places among the rows of this width.
            i_all, j_all = np.flatnonzero(np.isin(at, a)), np.flatnonzero(np.isin(at, b))
            for begin in range(0, len(i_all), 250):
                i, j = i_all[begin : begin + 250], j_all
                near = vectors[i] @ vectors[j].T >= low
                if same_block:
                    near &= i[:, None] < j[None, :]
                p, q = np.nonzero(near)
                # A pair counts in the first table where its patterns meet; few pairs are left to be asked.
                for begin_pair in range(0, len(p), 10_000):
                    x, y = i[p[begin_pair : begin_pair + 10_000]], j[q[begin_pair : begin_pair + 10_000]]
                    first = ~(signs[x, :table] == signs[y, :table]).any(axis=1)
                    x, y = at[x[first]], at[y[first]]
                    np.add.at(links, x, weights[y])
                    np.add.at(links, y, weights[x])
                    root = _tied(root, x, y)
        hit = np.flatnonzero(links)
        return pa.Table.from_arrays([pa.array(ids[hit]), pa.array(links[hit]), pa.array(ids[root[hit]])], schema=_FOUND)

    return run


def _usable(v):
    """Neither NULL nor zero, all components finite numbers."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    tables: int = TABLES,
    bits: int = BITS,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Rows link when their labels are equal and not NULL and their cosine, in
    doubles, is at least ``threshold`` (which should be well above 0.9; lower ones
    need more tables or fewer bits). Vectors that are NULL, empty, zero or hold a
    NULL or non-finite component link with nothing, nor do vectors of different
    lengths. Equal rows link with each other: rows of one id count as several
    vectors. The component is the least id within reach; a NULL id has none of its
    own, and an unlinked row with a NULL id has component NULL. Other columns take
    no part.
    """
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), v.alias("v")
    )
    usable = _usable(F.col("v")) & F.col("label").isNotNull()
    # -0.0 and 0.0 are one number, and so are vectors that differ in them alone.
    content = F.sha2(F.concat_ws(",", F.transform("v", lambda x: (x + 0.0).cast("string"))), 256)
    marked = cut_lineage(
        rows.select("vec_id", "label", F.when(usable, F.col("v")).alias("v"), F.when(usable, content).alias("content"))
    )
    # One representative for all rows of equal content and label: its number is a hash, any id may be NULL or repeated.
    number = F.xxhash64("label", "content")
    grouped = (
        marked.where("v is not null")
        .groupBy(number.alias("vec"), "label")
        .agg(F.count("*").alias("w"), F.min("vec_id").alias("least"), F.any_value("v").alias("v"))
    )
    classes = cut_lineage(
        grouped.mapInArrow(
            _signer(tables, bits, seed), "vec long, label long, w long, least long, signs array<int>, packed binary"
        )
    )
    patterns = classes.select("vec", "label", F.posexplode("signs").alias("table", "sign"))
    bucket = ["label", "table", "sign"]
    crowded = patterns.groupBy(*bucket).agg(F.count("*").alias("size")).where("size > 1")
    crowded = crowded.select(*bucket, F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = patterns.join(crowded, bucket)
    # Each block meets itself and every other once: as the first side of later blocks, as the second of earlier ones.
    own = F.pmod(F.xxhash64("vec", "table"), F.col("blocks")).cast("int")
    spread = members.withColumn("own", own).select(
        "vec", *bucket, "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")
    )
    spread = spread.select(
        "vec",
        *bucket,
        F.least("own", "with").alias("i"),
        F.greatest("own", "with").alias("j"),
        (F.col("own") > F.col("with")).alias("side"),
    )
    full = spread.join(classes.select("vec", "w", "packed"), "vec").select("vec", "w", "packed", *bucket, "i", "j", "side")
    # Each linked vector comes with how many it links with here and with the first vector of its group here.
    found = cut_lineage(
        full.groupBy(*bucket, "i", "j").applyInArrow(_links(threshold, tables), "vec long, links long, other long")
    )
    links = found.groupBy("vec").agg(F.sum("links").alias("links"))
    joined = connected_components(found.select(F.col("vec").alias("a"), F.col("other").alias("b")))
    root = F.coalesce(F.col("component"), F.col("vec"))
    placed = classes.select("vec", "w", "least").join(joined.withColumnRenamed("node", "vec"), "vec", "left")
    placed = placed.join(links, "vec", "left").select("vec", "w", "least", root.alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    placed = cut_lineage(placed)
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    final = placed.join(least, "root").select("vec", (F.col("links") + F.col("w") - 1).alias("links"), "component_id")
    # Few classes hold many rows each: the join is on the class, and skew is left to the adaptive planner.
    out = marked.select("vec_id", F.when(F.col("v").isNotNull(), number).alias("vec")).join(final, "vec", "left")
    component = F.coalesce(F.col("component_id"), F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
