"""Removal of benchmark passages from training texts.

Benchmark items are cut into windows of consecutive words. A hash set of the
windows is broadcast; tasks slide over the words of each text, look up rolling
hashes, and compare the words of every hit. The set is sent in blocks of at
most ``BLOCK_WORDS`` window words, so its size does not depend on the number of
items: a larger benchmark takes further scans, whose hits add up.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import WORDS, byte_words, column, record_batch

WINDOW = 13
#: Words in all windows of one broadcast block, repeats included.
BLOCK_WORDS = 4_000_000

_WINDOWS = pa.schema([("item_id", pa.int64()), ("words", pa.binary())])
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _cut_items(window):
    def run(batches):
        for batch in batches:
            ids, found = [], []
            for item, text in zip(column(batch, "item_id"), column(batch, "text"), strict=True):
                words = byte_words(text)
                size = min(window, len(words))
                if not size:
                    continue
                for at in range(len(words) - size + 1):
                    ids.append(item)
                    found.append(b" ".join(words[at : at + size]))
            yield record_batch(_WINDOWS, ids, found)

    return run


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, words): the distinct windows of each item, its words joined by blanks.

    An item shorter than a window is one window; one without words has none.
    Items of equal id share their windows; a NULL id marks words but is no item.
    """
    items = benchmark.select(
        F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    return items.mapInArrow(_cut_items(window), "item_id long, words binary").distinct()


class WindowSet:
    """One block of windows, ready for scanning."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        #: item ids of each window, by the ids of its words
        self.items: dict[tuple[int, ...], list[int]] = defaultdict(list)
        self.ids: dict[bytes, int] = {}
        for item, joined in rows:
            words = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in joined.split(b" "))
            found = self.items[words]
            if item is not None:
                found.append(item)
        self.hashes: dict[int, np.ndarray] = {}
        for size in {len(w) for w in self.items}:
            windows = np.array([w for w in self.items if len(w) == size], np.uint64)
            self.hashes[size] = np.unique(self._hash(windows.T))

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = np.zeros(len(columns[0]), np.uint64)
        for c in columns:
            total = total * _BASE + c
        return total ^ (total >> np.uint64(29))

    def scan(self, ids: np.ndarray) -> tuple[np.ndarray, set[int]]:
        """Which of a text's words lie in an occurring window, and the items of those windows.

        ``ids`` holds 0 for words that no window of the block contains.
        """
        steps = np.zeros(len(ids) + 1, np.int64)
        items: set[int] = set()
        run = np.concatenate([[0], np.cumsum(ids == 0)])
        for size, known in self.hashes.items():
            n = len(ids) - size + 1
            if n <= 0:
                continue
            starts = np.flatnonzero(run[size:] == run[: n])  # no unknown word inside
            if not len(starts):
                continue
            hashed = self._hash([ids[starts + k] for k in range(size)])
            at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            for start in starts[known[at] == hashed].tolist():
                found = self.items.get(tuple(ids[start : start + size].tolist()))
                if found is not None:
                    steps[start] += 1
                    steps[start + size] -= 1
                    items.update(found)
        return np.cumsum(steps[:-1]) > 0, items


def _runs(hit: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    return [{"first": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _scanner(block, schema):
    def run(batches):
        windows: WindowSet = block.value
        get = windows.ids.get
        for batch in batches:
            counts, spans, items = [], [], []
            for text, old_spans, old_items in zip(
                column(batch, "_scan_text"), column(batch, "hit_spans"), column(batch, "item_ids"), strict=True
            ):
                words = byte_words(text)
                ids = np.array([get(w, 0) for w in words], np.uint64)
                hit, found = windows.scan(ids) if len(words) else (np.zeros(0, bool), set())
                for s in old_spans:
                    hit[s["first"] : s["end"]] = True
                counts.append(len(words))
                spans.append(_runs(hit))
                items.append(sorted(found.union(old_items)))
            fresh = {"n_words": (counts, pa.int64()), "hit_spans": (spans, _SPANS), "item_ids": (items, pa.list_(pa.int64()))}
            yield pa.RecordBatch.from_arrays(
                [pa.array(*fresh[f]) if f in fresh else batch.column(i) for i, f in enumerate(batch.schema.names)],
                names=batch.schema.names,
            )

    return run


def scan_texts(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words, hit_spans (runs of hit words: first, end) and item_ids (sorted, distinct) appended.

    Words are runs of ASCII digits and letters (A-Z lower-cased) and characters
    beyond ASCII. A NULL text has no words. Every input row and column is kept;
    columns named like the new ones are refused, as is ``_scan_text``.
    """
    added = {"n_words", "hit_spans", "item_ids", "_scan_text"}
    clash = added & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    spark = docs.sparkSession
    windows = cut_lineage(benchmark_windows(benchmark, window, item_id_col, item_text_col))
    size = F.size(F.split(F.col("words").cast("string"), " "))
    total = windows.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    rows = docs.withColumns(
        {
            "_scan_text": F.col(text_col).cast("string").cast("binary"),
            "n_words": F.lit(0).cast("long"),
            "hit_spans": F.expr("cast(array() as array<struct<first: bigint, end: bigint>>)"),
            "item_ids": F.expr("cast(array() as array<bigint>)"),
        }
    )
    for b in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b) if blocks > 1 else windows
        block = WindowSet([(r[0], bytes(r[1])) for r in part.collect()])
        rows = rows.mapInArrow(_scanner(spark.sparkContext.broadcast(block), rows.schema), rows.schema)
        if b + 1 < blocks:
            rows = cut_lineage(rows)
    return rows.drop("_scan_text")


def with_hit_counts(scanned: DataFrame) -> DataFrame:
    """Adds n_hit and contaminated (at least one hit, and a twentieth of all words or more)."""
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda t, s: t + s["end"] - s["first"])
    return scanned.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns unchanged."""
    kept = with_hit_counts(scan_texts(docs, benchmark, text_col, **options))
    return kept.where(~F.col("contaminated")).select(*docs.columns)


_WORD_BYTE = np.frombuffer(WORDS, np.uint8) != 0x20


def _cut_spans(text: bytes, spans: list[dict]) -> bytes:
    inside = np.concatenate([[False], _WORD_BYTE[np.frombuffer(text, np.uint8)], [False]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for s in spans:
        out.append(text[at : starts[s["first"]]])
        at = int(ends[s["end"] - 1])
    return b"".join([*out, text[at:]])


def _span_remover(text_at, spans_at):
    def run(batches):
        for batch in batches:
            texts, spans = batch.column(text_at).cast(pa.binary()).to_pylist(), batch.column(spans_at).to_pylist()
            new = [t if t is None or not s else _cut_spans(t, s) for t, s in zip(texts, spans, strict=True)]
            arrays = batch.columns
            arrays[text_at] = pa.array(new, pa.binary()).cast(batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return run


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows of ``docs``; of their texts, everything from the first to the last word of each hit run is cut out."""
    scanned = scan_texts(docs, benchmark, text_col, **options)
    cut = _span_remover(scanned.columns.index(text_col), scanned.columns.index("hit_spans"))
    return scanned.mapInArrow(cut, scanned.schema).select(*docs.columns)
