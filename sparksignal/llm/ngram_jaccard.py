"""Jaccard join of documents on word n-grams, and the groups its links form.

Rare-first prefix filtering: all documents order their n-grams by the same
rule, rarest first, so two sets that overlap enough share one of their first
n-grams. An n-gram that only one document holds cannot be shared; it counts for
positions and lengths, and is never sent on.

1. One pass finds each document's set size and fingerprint, and the n-grams
   that are very common; at most ``COMMON`` of those are broadcast and come last
   in the order.
2. A second pass sends all other n-grams, packed, to buckets of their hash;
   there each is counted over all documents and, where two or more hold it,
   returned to its documents with its rarity.
3. Prefix n-grams are joined. First each document meets one hub of a prefix
   n-gram only, and what links is taken together; then documents of different
   components meet. Candidates pass length, positional and suffix filters, and
   each remaining pair is verified once by the exact size of its intersection.

Documents with equal sets are one class throughout. All links count for the
components; links inside a component that hubs already tied together need no check.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import LOWER, column, record_batch
from .components import joined_components
from .hashing import mixed, word_hashes
from .url_filter import bloom_filter, may_be_listed, not_listed

NGRAM = 5
#: Least similarity, in hundredths.
PERCENT = 75
#: Documents packed together on their way to the counting buckets.
CHUNK = 256
#: Very common n-grams that are broadcast, 8 bytes each.
COMMON = 1 << 16
#: An n-gram may be very common if so many documents of a chunk hold it.
COMMON_IN_CHUNK = 16
#: Rounds in which each document meets one hub before components are compared.
HUB_ROUNDS = 3
#: Parts of the n-gram space whose counts bound an overlap.
PARTS = 8

#: Blocks of the filter over rows to be dropped; 32 bytes each.
BLOOM_BLOCKS = 1 << 16

_HASH_BITS = 56
_RARITY_MOST = 127
_MASK = np.uint64((1 << _HASH_BITS) - 1)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def shingles(text: bytes | None, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; of a shorter text, of its whole sequence."""
    words = text.translate(LOWER).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    hashed = word_hashes(words)
    size = min(n, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        total = total * _STEP + hashed[k : k + len(total)]
    return np.unique(mixed(total + np.uint64(size)) & _MASK)


def _fingerprint(grams: np.ndarray) -> int:
    """One number for a set."""
    total = mixed(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(mixed(np.array([total])).view(np.int64)[0])


def _profile(n):
    schema = pa.schema([(name, pa.int64()) for name in ("doc_id", "row", "n", "set", "gram", "held")])

    def run(batches):
        chunk: list[np.ndarray] = []

        def common():
            grams, held = np.unique(np.concatenate(chunk or [np.zeros(0, np.uint64)]), return_counts=True)
            often = held >= COMMON_IN_CHUNK
            size = int(often.sum())
            chunk.clear()
            none = pa.nulls(size, pa.int64())
            return record_batch(schema, none, none, none, none, grams[often].astype(np.int64), held[often])

        for batch in batches:
            sets = [shingles(t, n) for t in column(batch, "text")]
            size = len(sets)
            none = pa.nulls(size, pa.int64())
            prints = [_fingerprint(s) if len(s) else None for s in sets]
            yield record_batch(schema, batch.column(0), batch.column(1), [len(s) for s in sets], prints, none, none)
            for s in sets:
                chunk.append(s)
                if len(chunk) == CHUNK:
                    yield common()
        yield common()

    return run


_PACKED = pa.schema([("bucket", pa.int32()), ("sets", pa.binary()), ("owners", pa.binary()), ("grams", pa.binary())])


def _planes(values: np.ndarray) -> bytes:
    """Byte planes of sorted numbers' differences; the shuffle's compression removes the empty ones."""
    return np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    count = len(planes) // 8
    return np.cumsum(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, count).T).view("<u8").ravel(), dtype=np.uint64)


def _pack(n, bits, common):
    """Rows for the buckets: n-grams of a chunk of documents, by hash; rows with no owners hold one set's common n-grams."""

    def run(batches):
        known = common.value
        chunk: dict[int, np.ndarray] = {}

        def flush():
            sets = np.fromiter(chunk, np.int64, len(chunk))
            parts = list(chunk.values())
            chunk.clear()
            if not parts:
                return
            grams = np.concatenate(parts)
            owners = np.repeat(np.arange(len(parts)), [len(p) for p in parts]).astype(np.uint8)
            out = [[] for _ in _PACKED]
            if len(known):
                is_common = known[np.minimum(np.searchsorted(known, grams), len(known) - 1)] == grams
                for owner in np.unique(owners[is_common]):
                    own = grams[is_common & (owners == owner)]
                    for values, x in zip(
                        out, (int(sets[owner] % (1 << bits)), sets[owner].tobytes(), None, _planes(own)), strict=True
                    ):
                        values.append(x)
                grams, owners = grams[~is_common], owners[~is_common]
            order = np.argsort(grams, kind="stable")
            grams, owners = grams[order], owners[order]
            edges = np.searchsorted(grams, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(_HASH_BITS - bits))
            for b in np.flatnonzero(np.diff(edges)):
                lo, hi = edges[b], edges[b + 1]
                first = np.uint64(int(b) << (_HASH_BITS - bits))
                for values, x in zip(
                    out, (int(b), sets.tobytes(), owners[lo:hi].tobytes(), _planes(grams[lo:hi] - first)), strict=True
                ):
                    values.append(x)
            yield record_batch(_PACKED, *out)

        for batch in batches:
            for text in column(batch, "text"):
                grams = shingles(text, n)
                if len(grams):
                    chunk[_fingerprint(grams)] = grams
                if len(chunk) == CHUNK:
                    yield from flush()
        yield from flush()

    return run


_SHARED = pa.schema([("set", pa.int64()), ("tokens", pa.list_(pa.int64()))])


def _rarity(held: np.ndarray) -> np.ndarray:
    return np.minimum(4 * np.log2(held), _RARITY_MOST - 1).astype(np.uint64)


def _count(bits):
    """Per set, the bucket's n-grams that other sets hold too: rarity above, hash below, in one number."""

    def run(group: pa.Table) -> pa.Table:
        sets, tokens, grams = [], [], []
        for bucket, some, owners, planes in zip(*(group.column(c).to_pylist() for c in _PACKED.names), strict=True):
            some, values = np.frombuffer(some, np.int64), _values(planes)
            if owners is None:
                sets.append(np.repeat(some, len(values)))
                tokens.append(values | np.uint64(_RARITY_MOST << _HASH_BITS))
            else:
                grams.append((some[np.frombuffer(owners, np.uint8)], values + np.uint64(bucket << (_HASH_BITS - bits))))
        if grams:
            owner, value = (np.concatenate(x) for x in zip(*grams, strict=True))
            order = np.argsort(value, kind="stable")
            owner, value = owner[order], value[order]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            held = np.diff(np.concatenate([first, [len(value)]]))
            held = np.repeat(held, held)
            shared = held > 1
            sets.append(owner[shared])
            tokens.append(value[shared] | (_rarity(held[shared]) << np.uint64(_HASH_BITS)))
        if not sets:
            return pa.Table.from_batches([], _SHARED)
        owner, token = np.concatenate(sets), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        owner, token = owner[order], token[order]
        first = np.flatnonzero(np.diff(owner, prepend=owner[:1] - 1)) if len(owner) else np.zeros(0, np.int64)
        lists = pa.LargeListArray.from_arrays(np.concatenate([first, [len(owner)]]), pa.array(token.astype(np.int64)))
        return pa.Table.from_arrays([pa.array(owner[first]), lists.cast(_SHARED.field(1).type)], schema=_SHARED)

    return run


def _prefix_size(n: Column) -> Column:
    return n - F.expr(f"({PERCENT} * n + 99) div 100") + 1


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by the exact size of the intersection."""
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    common = F.size(F.array_intersect("ta", "tb"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    return both.where((100 + PERCENT) * common >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def _bounds(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Suffix filter: counts of n-grams per part of the hash space bound the overlap from above."""
    left = sets.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("parts").alias("pa"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("parts").alias("pb"))
    most = F.aggregate(
        F.zip_with("pa", "pb", lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x
    )
    both = pairs.join(left, "a").join(right, "b")
    return both.where((100 + PERCENT) * most >= PERCENT * (F.col("na") + F.col("nb"))).select("a", "b")


def _long_enough(n: Column, other: Column) -> Column:
    """Length filter."""
    return (100 * F.least(n, other)) >= (PERCENT * F.greatest(n, other))


def _far_enough(n: Column, at: Column, other: Column, other_at: Column) -> Column:
    """Positional filter at the first shared prefix n-gram: what can still be shared from there on."""
    most = 1 + F.least(n - at, other - other_at)
    return (100 + PERCENT) * most >= PERCENT * (n + other)


def _labelled(entries: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return entries.withColumn("component", F.col("set"))
    named = labels.withColumnRenamed("node", "set")
    return entries.join(named, "set", "left").withColumn("component", F.coalesce("component", "set"))


def _main_components(entries: DataFrame, turn: int) -> DataFrame:
    """For each token that several components hold, the component with the most entries and one of its sets, the hub.

    The fewer n-grams a set has to itself, the more of its copies it can link
    with: the first hub is the set with the fewest, later ones are drawn from more.
    """
    own = F.floor(F.col("unique") / F.lit(1 << (turn - 1)))
    hub = F.struct(own.alias("own"), F.xxhash64(F.lit(turn), "set").alias("order"), "set", "n", "at")
    counted = entries.groupBy("token", "component").agg(F.count("*").alias("size"), F.min(hub).alias("hub"))
    main = counted.groupBy("token").agg(
        F.max(F.struct("size", "component", "hub")).alias("main"), F.count("*").alias("components")
    )
    return main.where("components > 1").select(
        "token", F.col("main.component").alias("main"), *[F.col(f"main.hub.{c}").alias(f"hub_{c}") for c in ("set", "n", "at")]
    )


def _hub_pairs(entries: DataFrame, turn: int) -> DataFrame:
    """Each set outside a token's main component with one hub: of the hubs it may link with, the one it meets most often."""
    # In the first round every set is a component of its own.
    met = entries.join(_main_components(entries, turn), "token").where(
        (F.col("component") != F.col("main"))
        & _long_enough(F.col("n"), F.col("hub_n"))
        & _far_enough(F.col("n"), F.col("at"), F.col("hub_n"), F.col("hub_at"))
    )
    counted = met.groupBy("set", "hub_set").agg(F.count("*").alias("times"))
    return counted.groupBy("set").agg(F.max(F.struct("times", "hub_set")).alias("best")).select(
        F.col("set").alias("a"), F.col("best.hub_set").alias("b")
    )


def _cross_pairs(entries: DataFrame) -> DataFrame:
    """All pairs of different components that share a prefix token and pass the filters, each once.

    One side are the entries outside the token's main component; entries of
    the main component never meet each other.
    """
    several = _main_components(entries, 1).select("token", "main")
    together = entries.join(several, "token")
    minor = together.where("component <> main").select(
        "token", *[F.col(c).alias(f"x_{c}") for c in ("set", "n", "at", "component")]
    )
    met = minor.join(
        together,
        (minor["token"] == together["token"])
        & (F.col("x_component") != F.col("component"))
        & ((F.col("x_set") < F.col("set")) | (F.col("component") == F.col("main")))
        & _long_enough(F.col("x_n"), F.col("n"))
        & _far_enough(F.col("x_n"), F.col("x_at"), F.col("n"), F.col("at")),
    )
    return met.select(F.least("x_set", "set").alias("a"), F.greatest("x_set", "set").alias("b")).distinct()


def _bucket_bits(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions, 128 at least, rounded up to a power of two."""
    return max(7, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def shared_sets(rows: DataFrame, profile: DataFrame, n: int) -> DataFrame:
    """(set, n, tokens, parts) of the sets that may link with another: their shared n-grams, rarest first."""
    spark = rows.sparkSession
    bits = _bucket_bits(spark)
    heavy = profile.where("gram is not null").groupBy("gram").agg(F.sum("held").alias("held"))
    common = [r[0] for r in heavy.orderBy(F.desc("held"), "gram").limit(COMMON).collect()]
    shared = spark.sparkContext.broadcast(np.unique(np.array(common, np.uint64)))
    packed = rows.select("text").mapInArrow(_pack(n, bits, shared), "bucket int, sets binary, owners binary, grams binary")
    found = packed.groupBy("bucket").applyInArrow(_count(bits), "set long, tokens array<long>")
    gathered = found.groupBy("set").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("tokens")))).alias("tokens"))
    sizes = profile.where("set is not null").groupBy("set").agg(F.max("n").alias("n"))
    live = gathered.join(sizes, "set").where(F.size("tokens") > F.col("n") - _prefix_size(F.col("n")))
    parts = F.transform(
        F.sequence(F.lit(0), F.lit(PARTS - 1)),
        lambda p: F.size(F.filter("tokens", lambda t: t.bitwiseAND(F.lit(PARTS - 1)) == p)),
    )
    return live.select("set", "n", "tokens", parts.alias("parts"))


def similar_sets(sets: DataFrame, hub_rounds: int = HUB_ROUNDS) -> DataFrame:
    """(node, component) of the sets that similar pairs connect with others: what a round links is taken together at once."""
    unique = F.col("n") - F.size("tokens")
    entries = cut_lineage(
        sets.select(
            "set", "n", unique.alias("unique"), F.posexplode(F.slice("tokens", F.lit(1), _prefix_size(F.col("n")) - unique))
        ).select("set", "n", "unique", (F.col("unique") + F.col("pos") + 1).alias("at"), F.col("col").alias("token"))
    )
    labels = None
    for turn in range(1, hub_rounds + 1):
        found = cut_lineage(_links(_hub_pairs(_labelled(entries, labels), turn), sets))
        if labels is not None and found.isEmpty():
            break
        labels = joined_components(labels, found)
    pairs = cut_lineage(_cross_pairs(_labelled(entries, labels)))
    found = cut_lineage(_links(_bounds(pairs, sets), sets))
    return labels if found.isEmpty() else joined_components(labels, found)


def _row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows of equal id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def jaccard_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM) -> DataFrame:
    """(doc_id, row, n_shingles, set, root, component_id) for every row of ``docs``.

    Words are runs of bytes that are no ASCII white space, A-Z lower-cased. Two
    rows link when their sets of ``n``-word shingles have a Jaccard similarity of
    0.75 or more; component_id is the least id within reach, ``root`` names the
    component, ``set`` the set of shingles and ``row`` the id and text by a hash. A
    text of fewer words is one shingle; one without words, or NULL, has an empty
    set, links with nothing and has set and root NULL. Rows of equal text link,
    whatever their ids; NULL ids take the component of what they link with, else
    NULL. Other columns take no part.

    ``docs`` is read twice and should be a stored table.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        _row_key(id_col, text_col).alias("row"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    profile = cut_lineage(rows.mapInArrow(_profile(n), "doc_id long, row long, n long, set long, gram long, held long"))
    sets = cut_lineage(shared_sets(rows, profile, n))
    labels = similar_sets(sets).withColumnRenamed("node", "set")
    per_row = profile.where("gram is null").select("doc_id", "row", "n", "set")
    classes = per_row.where("set is not null").groupBy("set").agg(F.min("doc_id").alias("least"))
    placed = cut_lineage(
        classes.join(labels, "set", "left").select("set", "least", F.coalesce("component", "set").alias("root"))
    )
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    roots = placed.join(least, "root").select("set", "root", "component_id")
    return per_row.join(roots, "set", "left").select(
        "doc_id", "row", F.col("n").alias("n_shingles"), "set", "root", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM) -> DataFrame:
    """The rows of ``docs``, columns unchanged, with one of each group of linked rows: the one of least id.

    NULL ids come after all others; at equal ids the row's hash decides, and of
    rows equal in id and text any one stays. Rows without words all stay.

    Rows to be dropped are named in a Bloom filter of fixed size, so that only
    they and few others are shuffled for the exact test.
    """
    groups = cut_lineage(jaccard_groups(docs, id_col, text_col, n).where("root is not null").select("doc_id", "row", "root"))
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first"))
    kept = first.select(F.col("first.row").alias("row"), F.lit(True).alias("stays"))
    rows = groups.groupBy("row").agg(F.count("*").alias("copies")).join(kept, "row", "left")
    listed = cut_lineage(
        rows.where("stays is null or copies > 1").select(F.col("row").alias("key"), F.coalesce("stays", F.lit(False)).alias("stays"))
    )
    keyed = docs.withColumn("_row_key", _row_key(id_col, text_col))
    bloom = bloom_filter(listed, BLOOM_BLOCKS)
    clear = not_listed(keyed, "_row_key", bloom, BLOOM_BLOCKS)
    suspects = may_be_listed(keyed, "_row_key", bloom, BLOOM_BLOCKS).join(
        listed.withColumnRenamed("key", "_row_key"), "_row_key", "left"
    )
    # Suspects that are not listed stay, each for itself; of listed rows that stay, one does.
    alone = F.when(F.col("stays").isNull(), F.monotonically_increasing_id())
    chosen = suspects.where("stays is null or stays").withColumn("_alone", alone).dropDuplicates(["_row_key", "_alone"])
    return clear.select(*docs.columns).unionByName(chosen.select(*docs.columns))
