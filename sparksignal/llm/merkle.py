"""Merkle manifest of a dataset: leaves, subroots per group, one root, proofs and their checks.

Each row is a leaf. The leaves of a group, in order, are hashed in runs of
three until one node, the group's subroot, is left; the subroots, in order of
their groups, give the root in the same way.

Every ``BLOCK`` consecutive nodes, a power of three, form an aligned block
whose runs lie inside it. A block keeps each of its levels as one string, the
hex digests of its nodes one after the other: substrings of fixed width are
the runs that parents are hashed from, and the substrings to both sides of a
node in its run are its sibling segment. The one node a block ends in is a
node of the next, smaller table of blocks, and so on to the roots; what was
found there is handed down to the blocks below. No row grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .numbering import numbered
from .skew import join_per_key

#: Children of a node.
ARITY = 3
#: Levels inside a block, and the nodes it starts from.
DEPTH = 5
BLOCK = ARITY**DEPTH
#: Hex digits of a digest.
WIDTH = 64

_STEP = "struct<before: string, after: string>"


def _field(value: Column) -> Column:
    """``-`` for NULL, else UTF-8 byte count, ``:``, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """Digest of a row's values, each told apart from the next and from NULL; integers are taken in decimal."""
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def _cut(level: Column, first: Column, count: Column) -> Column:
    """``count`` characters of a level from the (0-based) ``first`` on. Levels are ASCII and come as bytes, so nothing is scanned."""
    return F.substring(level, first + 1, count).cast("string")


def _parents(level: Column) -> Column:
    """The next level: digests of all runs of ``ARITY`` nodes, the last may have fewer."""
    run = ARITY * WIDTH
    count = F.ceil(F.length(level) / run).cast("int")
    return F.array_join(
        F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.sha2(_cut(level.cast("binary"), i * run, F.lit(run)), 256)), ""
    )


def _levels(total: Column) -> Column:
    """How often nodes are hashed inside a block, for a group of ``total`` nodes."""
    needed = F.lit(DEPTH)
    for k in reversed(range(DEPTH)):
        needed = F.when(total <= ARITY**k, F.lit(k)).otherwise(needed)
    return needed


def _siblings(levels: list[Column], i: Column) -> Column:
    """For the block's node ``i``: what stands before and after it, and after it its parents, in their runs."""

    def step(k: int) -> Column:
        at = F.floor(i / ARITY**k)
        inside = (at % ARITY).cast("int")
        first = ((at - inside) * WIDTH).cast("int")
        return F.struct(
            _cut(levels[k], first, inside * WIDTH).alias("before"),
            _cut(levels[k], first + (inside + 1) * WIDTH, (ARITY - 1 - inside) * WIDTH).alias("after"),
        )

    steps = [F.when(levels[k + 1].isNotNull(), step(k)) for k in range(DEPTH)]
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _blocks(nodes: DataFrame, group: list[str]) -> DataFrame:
    """(group, block, total, nodes, level0.., top): aligned blocks, with each level as one string, and the node they end in."""
    member = F.struct("pos", *[c for c in nodes.columns if c not in (*group, "pos", "total")])
    rows = nodes.groupBy(*group, F.floor(F.col("pos") / BLOCK).alias("block"), "total").agg(
        F.array_sort(F.collect_list(member)).alias("nodes")
    )
    rows = rows.withColumn("level0", F.array_join(F.col("nodes.hash"), ""))
    for k in range(DEPTH):
        rows = rows.withColumn(f"level{k + 1}", F.when(_levels(F.col("total")) > k, _parents(F.col(f"level{k}"))))
    top = F.coalesce(*[F.col(f"level{k}") for k in reversed(range(DEPTH + 1))])
    return cut_lineage(rows.withColumn("top", top))


def prove(nodes: DataFrame, group: list[str], most: int) -> DataFrame:
    """``nodes`` (group, pos, total, hash, others) with steps and subroot.

    ``steps`` are the sibling segments on the way to the subroot of the node's
    group, each as the digests before and after. ``most`` is the largest total.
    """
    blocks = _blocks(nodes, group)
    if most <= BLOCK:
        above = blocks.withColumns({"subroot": F.col("top"), "upper": F.expr(f"cast(array() as array<{_STEP}>)")})
    else:
        # Blocks are the next table's nodes; a group of one block is through with it.
        few = F.col("total") <= BLOCK
        tops = blocks.select(
            *group, F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).alias("total"), F.col("top").alias("hash")
        )
        found = prove(tops.where("total > 1"), group, -(-most // BLOCK)).select(
            *[F.col(g).alias(f"_of_{g}") for g in group], F.col("pos").alias("_pos"), "subroot", F.col("steps").alias("upper")
        )
        same = F.col("block") == F.col("_pos")
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        above = blocks.where(~few).join(found, same).select(*blocks.columns, "subroot", "upper").unionByName(
            blocks.where(few).withColumns({"subroot": F.col("top"), "upper": F.expr(f"cast(array() as array<{_STEP}>)")})
        )
    names = [f"level{k}" for k in range(DEPTH + 1)]
    above = above.withColumns({name: F.col(name).cast("binary") for name in names})
    levels = [F.col(name) for name in names]
    others = [c for c in nodes.columns if c not in (*group, "pos", "total")]
    each = F.transform(
        "nodes",
        lambda n, i: F.struct(n["pos"].alias("pos"), *[n[c].alias(c) for c in others], _siblings(levels, i).alias("own")),
    )
    opened = above.select(*group, "total", "subroot", "upper", F.explode(each).alias("n"))
    return opened.select(
        *group, "total", *[f"n.{c}" for c in ("pos", *others)], "subroot", F.concat("n.own", "upper").alias("steps")
    )


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its sibling segments lead to."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_hash(steps: Column) -> Column:
    """Digest of all sibling segments, level by level."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def _most(rows: DataFrame) -> int:
    return rows.agg(F.max("total")).first()[0] or 0


def merkle_manifest(rows: DataFrame, group_col: str = "source", id_col: str = "doc_id", leaf_col: str = "leaf") -> DataFrame:
    """(all columns of ``rows``, subroot, root, steps): each leaf's way to the root of all.

    ``leaf_col`` holds the leaves' digests. Per group, leaves ascend by id, NULL
    first, those of equal id by digest; rows equal in all of these are leaves of
    their own. Groups ascend by name, a NULL one first. A group of one leaf has it
    as subroot; a table of one group has its subroot as root; an empty table gives
    no rows. Columns named pos, total, hash, subroot, root or steps are refused.
    """
    clash = {"pos", "total", "hash", "subroot", "root", "steps"} & {c.lower() for c in rows.columns}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    nodes = rows.withColumn(group_col, F.col(group_col).cast("string")).withColumn("hash", F.col(leaf_col))
    placed = cut_lineage(numbered(nodes, [group_col], [id_col, leaf_col]))
    proven = cut_lineage(prove(placed, [group_col], _most(placed)))
    subroots = proven.where("pos = 0").select(F.lit(0).alias("all"), F.col(group_col).alias("name"), F.col("subroot").alias("hash"), "total")
    tops = cut_lineage(numbered(subroots.withColumn("leaves", F.col("total")).drop("total"), ["all"], ["name"]))
    # A name and whether it is NULL, as join keys.
    name = {"_name": F.coalesce("name", F.lit("")), "_null": F.col("name").isNull()}
    upper = cut_lineage(prove(tops, ["all"], _most(tops)).withColumns(name)).select(
        "_name", "_null", "leaves", F.col("subroot").alias("root"), F.col("steps").alias("upper")
    )
    keyed = proven.withColumns({k: F.coalesce(F.col(group_col), F.lit("")) if k == "_name" else F.col(group_col).isNull() for k in name})
    rooted = join_per_key(keyed, upper, ["_name", "_null"], "leaves")
    return rooted.withColumn("steps", F.concat("steps", "upper")).select(*rows.columns, "subroot", "root", "steps")
