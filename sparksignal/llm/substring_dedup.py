"""Removal of long passages that a document with a smaller id already has.

De Bruijn compaction over word sequences. The edges of the graph are the
windows of ``WINDOW`` consecutive words; what repeats are edges of equal words.

1. Each text is cut into paths: runs of consecutive edges that share an anchor,
   the word group inside the edge whose hash is least. An edge's anchor follows
   from its words alone, so equal edges have equal anchors, and a path stands
   for some twenty edges. Paths of equal words are taken together with their
   least source (document and place). Anchors of one document are left out.
2. Where an anchor has different paths, the graph branches: these paths, each
   at its source only, are split into single edges, and each edge finds the
   least source over all paths that hold it.
3. Paths that always follow each other do not branch between them. A join of
   sources finds them (their places agree in number and by fingerprint), and
   they become one chain of paths; only the first path of a chain is looked up
   in the documents, and its spans hold for the whole chain.
4. Spans are carried to the documents by joins. The words of each span are
   compared with those at its source's coordinates, by digest, before the
   result counts; what does not agree stays in the text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .common import column, record_batch
from .hashing import Runs, word_hashes
from .skew import join_per_key

#: Words of an edge: passages of so many words count as repeated.
WINDOW = 50
#: Words of an anchor.
ANCHOR = 8
#: Edges of a text that are cut into paths together; longer texts take several turns.
PIECE = 1 << 20

_PLACE_BITS = 24
_PATHS = pa.schema(
    [("doc", pa.int64()), ("row", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("anchor", pa.int64()), ("path", pa.int64())]
)
_EDGES = pa.schema(
    [
        ("doc", pa.int64()),
        ("row", pa.int64()),
        ("start", pa.int64()),
        ("anchor", pa.int64()),
        ("path", pa.int64()),
        ("n", pa.int32()),
        ("off", pa.int64()),
        ("edge", pa.int64()),
    ]
)
_OUT = pa.schema(
    [
        ("row", pa.int64()),
        ("s_row", pa.int64()),
        ("s_at", pa.int64()),
        ("size", pa.int64()),
        ("at", pa.int64()),
        ("digest", pa.binary()),
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept_text", pa.binary()),
    ]
)
_CLASS = ["anchor", "path", "n"]


def _sql(schema: pa.Schema) -> str:
    names = {"int64": "long", "int32": "int", "binary": "binary"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def _least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive keys."""
    least, size = keys, 1
    while size * 2 <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count, rest = len(keys) - width + 1, width - size
    return np.minimum(least[:count], least[rest : rest + count])


def paths(hashed: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR):
    """(start, n, anchor, path) of the paths of one text, as arrays; no path for fewer words than a window."""
    found = []
    for base in range(0, len(hashed) - window + 1, PIECE):
        piece = hashed[base : base + PIECE + window - 1]
        runs = Runs(piece)
        at = np.arange(len(piece) - anchor + 1)
        groups = runs(at, at + anchor)
        # Of equal hashes the leftmost counts: places are the low bits.
        keys = ((groups >> np.uint64(_PLACE_BITS)) << np.uint64(_PLACE_BITS)) | at.astype(np.uint64)
        place = (_least_places(keys, window - anchor + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        n = np.diff(np.append(first, len(place)))
        found.append((first + base, n, groups[place[first]], runs(first, first + n + window - 1)))
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else None


def _cut_paths(window, anchor):
    def run(batches):
        for batch in batches:
            out = [[] for _ in _PATHS]
            for doc, row, text in zip(column(batch, "doc"), column(batch, "row"), column(batch, "text"), strict=True):
                cut = paths(word_hashes(text.split()), window, anchor) if text else None
                if cut:
                    start, n, anchors, ids = cut
                    ones = np.ones(len(start), np.int64)
                    for values, x in zip(
                        out, (ones * doc, ones * row, start, n.astype(np.int32), anchors.view(np.int64), ids.view(np.int64)), strict=True
                    ):
                        values.append(x)
            if out[0]:
                yield record_batch(_PATHS, *[np.concatenate(x) for x in out])

    return run


def _cut_edges(window):
    def run(batches):
        for batch in batches:
            for doc, row, text, asked in zip(*(column(batch, c) for c in ("doc", "row", "text", "asked")), strict=True):
                words = text.split()
                needed = np.zeros(len(words) + 1, np.int64)
                for path in asked:
                    needed[path["start"]] += 1
                    needed[path["start"] + path["n"] + window - 1] -= 1
                at = np.flatnonzero(np.cumsum(needed[:-1]))
                hashed = np.zeros(len(words), np.uint64)
                hashed[at] = word_hashes([words[k] for k in at.tolist()])
                runs = Runs(hashed)
                for path in asked:
                    off = np.arange(path["n"])
                    start = off + path["start"]
                    ones = np.ones(len(off), np.int64)
                    yield record_batch(
                        _EDGES,
                        ones * doc,
                        ones * row,
                        start,
                        ones * path["anchor"],
                        ones * path["path"],
                        np.full(len(off), path["n"], np.int32),
                        off,
                        runs(start, start + window).view(np.int64),
                    )

    return run


def _merged(batches, rows=50_000):
    """Small record batches joined to larger ones."""
    kept, size = [], 0
    for batch in batches:
        kept.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
            kept, size = [], 0
    if size:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def _repeated(found: DataFrame) -> DataFrame:
    """The paths of anchors that documents of different ids have; all others are left out by their counts alone."""
    anchors = found.groupBy("anchor").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("places"))
    anchors = cut_lineage(anchors.where("first < last").select("anchor", "places"))
    return join_per_key(found, anchors, ["anchor"], "places").drop("places")


def _classes(found: DataFrame) -> DataFrame:
    """Paths of equal words with their least source.

    ``occ``, ``heads`` and ``tails`` count and name the places where the path starts
    and ends; ``ways`` is the number of different paths of the anchor.
    """

    def places(at: Column) -> Column:
        h = F.xxhash64("row", at)
        return F.struct(F.bit_xor(h).alias("mix"), F.sum(h.bitwiseAND(F.lit((1 << 24) - 1))).alias("sum"))

    classes = cut_lineage(
        found.groupBy(*_CLASS).agg(
            F.min(F.struct("doc", "row", "start")).alias("src"),
            F.max("doc").alias("last_doc"),
            F.count("*").alias("occ"),
            places(F.col("start")).alias("heads"),
            places(F.col("start") + F.col("n")).alias("tails"),
        )
    )
    ways = cut_lineage(classes.groupBy("anchor").agg(F.count("*").alias("ways")))
    return join_per_key(classes, ways, ["anchor"], "ways")


def _split_edges(texts: DataFrame, classes: DataFrame, window: int) -> DataFrame:
    """Spans of the paths whose anchor has several: (class, off, len, source) for runs of edges with one source."""
    asked = classes.where("ways > 1").groupBy(F.col("src.row").alias("row")).agg(
        F.collect_list(F.struct(F.col("src.start").alias("start"), *_CLASS)).alias("asked")
    )
    cut = _cut_edges(window)
    edges = cut_lineage(texts.join(asked, "row").select("doc", "row", "text", "asked").mapInArrow(lambda b: _merged(cut(b)), _sql(_EDGES)))
    least = cut_lineage(
        edges.groupBy("anchor", "edge").agg(F.min(F.struct("doc", "row", F.col("start").alias("at"))).alias("source"), F.count("*").alias("held"))
    )
    placed = join_per_key(edges.select(*_CLASS, "off", "edge"), least, ["anchor", "edge"], "held").distinct()
    return _joined_spans(placed.select(*_CLASS, "off", F.lit(1).cast("long").alias("len"), "source"), _CLASS)


def _joined_spans(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Spans (off, len, source) of one key that follow each other here and at the source, made one."""
    order = Window.partitionBy(*keys).orderBy("off")
    follows = (
        (F.lag("source.row").over(order) == F.col("source.row"))
        & (F.lag(F.col("source.at") - F.col("off")).over(order) == F.col("source.at") - F.col("off"))
        & (F.lag(F.col("off") + F.col("len")).over(order) == F.col("off"))
    )
    numbered = spans.withColumn("_new", F.when(follows, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(order))
    return numbered.groupBy(*keys, "_run").agg(
        F.min("off").alias("off"), F.sum("len").alias("len"), F.min("source").alias("source")
    ).drop("_run")


def _chains(classes: DataFrame, spans: DataFrame) -> DataFrame:
    """(class of the first path, occ, spans): chains of paths that never branch, with the spans of all their paths."""
    # Only spans that a document after the source's holds can be removed.
    useful = spans.join(classes.select(*_CLASS, "src", "occ", "heads", "tails", "last_doc"), _CLASS).where(
        F.col("source.doc") < F.col("last_doc")
    )
    useful = cut_lineage(useful)
    members = cut_lineage(useful.select(*_CLASS, "src", "occ", "heads", "tails").distinct())
    ends = members.select(
        F.col("src.row").alias("u_row"),
        (F.col("src.start") + F.col("n")).alias("u_end"),
        F.col("occ").alias("u_occ"),
        F.col("tails").alias("u_tails"),
    )
    linked = members.join(
        ends,
        (F.col("src.row") == F.col("u_row"))
        & (F.col("src.start") == F.col("u_end"))
        & (F.col("occ") == F.col("u_occ"))
        & (F.col("heads") == F.col("u_tails")),
        "left",
    )
    along = Window.partitionBy("src.row").orderBy("src.start")
    numbered = linked.withColumn("chain", F.sum(F.when(F.col("u_row").isNull(), 1).otherwise(0)).over(along))
    chain = Window.partitionBy("src.row", "chain").orderBy("src.start")
    placed = numbered.select(
        *_CLASS,
        *[F.first(c).over(chain).alias(f"head_{c}") for c in _CLASS],
        (F.col("src.start") - F.first("src.start").over(chain)).alias("shift"),
    )
    heads = [f"head_{c}" for c in _CLASS]
    moved = useful.join(placed, _CLASS).select(*heads, "occ", (F.col("off") + F.col("shift")).alias("off"), "len", "source")
    whole = _joined_spans(moved, [*heads, "occ"])
    return whole.groupBy(*[F.col(h).alias(c) for h, c in zip(heads, _CLASS, strict=True)], "occ").agg(
        F.collect_list(F.struct("off", "len", "source")).alias("spans")
    )


def _remove(window):
    """Rows of removed words, and a digest for every span and every source of one."""

    def run(batches):
        for batch in batches:
            for row, doc, text, marks in zip(*(column(batch, c) for c in ("row", "doc_id", "text", "marks")), strict=True):
                words = text.split() if text else []
                steps = np.zeros(len(words) + 1, np.int64)
                digests = []
                for m in marks or []:
                    end = m["at"] + m["size"] + window - 1
                    digest = hashlib.blake2b(b" ".join(words[m["at"] : end]), digest_size=16).digest()
                    digests.append((m["s_row"], m["s_at"], m["size"], None if m["is_source"] else m["at"], digest))
                    if not m["is_source"]:
                        steps[m["at"]] += 1
                        steps[end] -= 1
                gone = np.cumsum(steps[:-1]) > 0
                removed = int(gone.sum())
                kept = b" ".join(words if not removed else [w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                size = len(digests)
                rows = [*zip(*digests, strict=True)] if digests else [[]] * 5
                yield record_batch(
                    _OUT,
                    [row] * (size + 1),
                    [*rows[0], None],
                    [*rows[1], None],
                    [*rows[2], None],
                    [*rows[3], None],
                    [*rows[4], None],
                    [*[None] * size, doc],
                    [*[None] * size, len(words)],
                    [*[None] * size, removed],
                    [*[None] * size, kept],
                )

    return run


def _row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows of equal id and text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(row, at, size, s_row, s_at): runs of ``size`` edges from word ``at`` on that also start at word ``s_at`` of a document
    with a smaller id; rows are named by a hash of id and text. Not yet verified."""
    texts = _texts(docs, id_col, text_col)
    found = cut_lineage(
        texts.select("doc", "row", "text").mapInArrow(_cut_paths(window, min(ANCHOR, window)), _sql(_PATHS))
    )
    found = cut_lineage(_repeated(found))
    classes = cut_lineage(_classes(found))
    plain = classes.where("ways = 1").select(
        *_CLASS,
        F.lit(0).cast("long").alias("off"),
        F.col("n").cast("long").alias("len"),
        F.struct(F.col("src.doc").alias("doc"), F.col("src.row").alias("row"), F.col("src.start").alias("at")).alias("source"),
    )
    spans = plain.unionByName(_split_edges(texts, classes, window))
    chains = cut_lineage(_chains(classes, spans))
    placed = join_per_key(found, chains, _CLASS, "occ").select("doc", "row", "start", F.explode("spans").alias("s"))
    return placed.where(F.col("s.source.doc") < F.col("doc")).select(
        "row",
        (F.col("start") + F.col("s.off")).alias("at"),
        F.col("s.len").alias("size"),
        F.col("s.source.row").alias("s_row"),
        F.col("s.source.at").alias("s_at"),
    ).distinct()


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        # Rows without an id come after all others.
        F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("doc"),
        _row_key(id_col, text_col).alias("row"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )


def _cleaned(texts: DataFrame, spans: DataFrame, window: int) -> DataFrame:
    is_source = F.lit(False).alias("is_source")
    sources = spans.select(
        F.col("s_row").alias("row"), F.col("s_at").alias("at"), "size", "s_row", "s_at", F.lit(True).alias("is_source")
    ).distinct()
    marks = spans.select("row", "at", "size", "s_row", "s_at", is_source).unionByName(sources)
    per_row = marks.groupBy("row").agg(F.collect_list(F.struct("at", "size", "s_row", "s_at", "is_source")).alias("marks"))
    remove = _remove(window)
    return texts.join(per_row, "row", "left").select("row", "doc_id", "text", "marks").mapInArrow(remove, _sql(_OUT))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text) for every row of ``docs``.

    Words are runs of bytes that are no ASCII white space, as they stand. A word
    goes if a window of ``window`` words that covers it also starts in a row with
    a smaller id; all windows are judged on the input. ``kept_text`` holds the
    other words, joined by one blank.

    A NULL or empty text has no words and gives an empty text; one of fewer words
    than a window is kept whole. Rows of equal id never remove words from each
    other; NULL ids count as the largest. Every row gives one row, repeated rows
    as often as they occur; an empty table gives none. Other columns take no part.
    ``docs`` is read three times and should be a stored table.
    """
    texts = _texts(docs, id_col, text_col)
    spans = cut_lineage(repeated_spans(docs, id_col, text_col, window))
    done = cut_lineage(_cleaned(texts, spans, window))
    result = done.where("n_words is not null").select("doc_id", "row", "n_words", "n_removed", "kept_text")
    digests = done.where("n_words is null")
    key = ["s_row", "s_at", "size"]
    # A source and all spans that name it must have one digest.
    differ = cut_lineage(digests.groupBy(*key).agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").select(*key))
    if differ.isEmpty():
        return result.drop("row")
    doubted = digests.join(differ, key)
    truth = doubted.where("at is null").select(*key, F.col("digest").alias("true_digest")).distinct()
    wrong = cut_lineage(
        doubted.where("at is not null").join(truth, key).where("digest <> true_digest").select("row", "at", *key).distinct()
    )
    again = wrong.select("row").distinct()
    right = spans.join(wrong, ["row", "at", *key], "left_anti").join(again, "row", "left_semi")
    mended = _cleaned(texts.join(again, "row", "left_semi"), right, window).where("n_words is not null")
    return result.join(again, "row", "left_anti").unionByName(mended.select(*result.columns)).drop("row")
