"""Token counts without ids.

Every distinct pre-token is encoded once and only its number of tokens kept.
Documents bring how often they hold each pre-token; the two sides meet in a
join and the products are summed per document.

Frequent pre-tokens, which would make hot join keys, are looked up inside the
tasks: at most ``HEAD_PIECES`` of at most ``HEAD_BYTES`` each, whatever the
input's size. All others take the shuffle join.
"""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .bpe_text import loaded, read_spec
from .common import column, record_batch

HEAD_PIECES = 1 << 18
HEAD_BYTES = 64
#: Distinct pre-tokens a task gathers before it passes partial counts on.
GATHERED = 600_000

_VOCABULARY = pa.schema([("piece", pa.string()), ("n", pa.int64())])
_COUNTED = pa.schema([("piece", pa.string()), ("n", pa.int64()), ("tokens", pa.int32())])
_FREQUENCY = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("print", pa.int64()),
        ("n_bytes", pa.int64()),
        ("row", pa.int64()),
        ("piece", pa.string()),
        ("n", pa.int64()),
    ]
)


def _vocabulary(spec):
    def run(batches):
        bpe, total = loaded(spec.value), Counter()

        def flush():
            keys, values = list(total), list(total.values())
            total.clear()
            for at in range(0, len(keys), 20_000):
                yield record_batch(_VOCABULARY, keys[at : at + 20_000], values[at : at + 20_000])

        for batch in batches:
            for text in column(batch, "text"):
                if text:
                    total.update(bpe.pre_tokens(text))
            if len(total) > GATHERED:
                yield from flush()
        yield from flush()

    return run


def _count_tokens(spec):
    def run(batches):
        bpe = loaded(spec.value)
        for batch in batches:
            yield record_batch(_COUNTED, batch.column(0), batch.column(1), bpe.counts(batch.column(0).to_pylist()))

    return run


def _frequencies(spec, head):
    def run(batches):
        bpe, known = loaded(spec.value), head.value
        get = known.get
        for batch in batches:
            out = [[] for _ in _FREQUENCY]
            for doc, mark, size, text in zip(
                column(batch, "doc_id"), column(batch, "print"), column(batch, "n_bytes"), column(batch, "text"), strict=True
            ):
                tokens, others = 0, []
                for part, n in Counter(bpe.pre_tokens(text)).items():
                    one = get(part)
                    if one is None:
                        others.append((part, n))
                    else:
                        tokens += n * one
                # The document's own row: no pre-token holds NUL and digits together.
                rows = [(doc, mark, size, 1, f"\0{mark}", tokens)]
                rows += [(doc, mark, size, 0, part, n) for part, n in others]
                for values, got in zip(out, zip(*rows, strict=True), strict=True):
                    values.extend(got)
            yield record_batch(_FREQUENCY, *out)

    return run


def piece_table(docs: DataFrame, tokenizer_path: str, text_col: str = "text") -> DataFrame:
    """(piece, n, tokens): every distinct pre-token of all texts, its places, and its tokens, counted once."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    found = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_vocabulary(spec), "piece string, n long")
    distinct = found.groupBy("piece").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(_count_tokens(spec), "piece string, n long, tokens int")


def _head(pieces: DataFrame, most: int) -> dict[str, int]:
    """The most frequent pieces, never more than ``most``: chosen by a threshold from a histogram of places."""
    short = pieces.where(F.octet_length("piece") <= HEAD_BYTES)
    level = F.floor(F.log2("n") * 8).cast("int")
    histogram = sorted(((r[0], r[1]) for r in short.groupBy(level.alias("level")).count().collect()), reverse=True)
    least, held = math.inf, 0
    for at, n in histogram:
        if held + n > most:
            break
        least, held = at, held + n
    if not held:
        return {}
    return {r[0]: r[1] for r in short.where(level >= F.lit(int(least))).select("piece", "tokens").collect()}


def token_counts(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", head_pieces: int = HEAD_PIECES
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for every row of ``docs``.

    A NULL text counts as empty: no bytes, no tokens. Special strings in a text
    are one token each. A row given twice comes back twice; NULL ids are kept.
    Columns other than the id and the text take no part.
    """
    context = docs.sparkSession.sparkContext
    spec = context.broadcast(read_spec(tokenizer_path))
    pieces = cut_lineage(piece_table(docs, tokenizer_path, text_col))
    head = context.broadcast(_head(pieces, head_pieces))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("print"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("text"),
    )
    frequencies = rows.mapInArrow(
        _frequencies(spec, head), "doc_id long, print long, n_bytes long, row long, piece string, n long"
    )
    joined = frequencies.join(pieces.select("piece", "tokens"), "piece", "left")
    summed = joined.groupBy("doc_id", "print").agg(
        F.max("n_bytes").alias("n_bytes"),
        F.sum("row").alias("copies"),
        F.sum(F.col("n") * F.coalesce(F.col("tokens"), F.lit(1))).alias("n_tokens"),
    )
    # Equal rows were summed together; each gets its share back.
    return summed.select(
        "doc_id",
        "n_bytes",
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.explode(F.expr("array_repeat(true, cast(copies as int))")).alias("one"),
    ).drop("one")
