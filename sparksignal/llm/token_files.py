"""Token ids as Parquet files.

Documents are put in id order by range partitions, encoded inside the tasks
and written as list columns: ids dictionary-encoded and bit-packed, in row
groups of a set size, with page indexes. Each row knows its file part and its
place in it, so the place in the whole follows from one total per part, and
readers fetch single documents or columns without touching the rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe_text import loaded, read_spec
from .common import column, record_batch

ROW_GROUP_BYTES = 16 * 1024 * 1024
PAGE_BYTES = 128 * 1024
PAGE_ROWS = 2_000

_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, ids array<int>"
_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("part", pa.int32()),
        ("local_start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.list_(pa.int32())),
    ]
)


def _encode(spec, end_id):
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches):
        bpe, part, start = loaded(spec.value), TaskContext.get().partitionId(), 0
        for batch in batches:
            encoded = [ids + end for ids in bpe.encode([t or "" for t in column(batch, "text")])]
            sizes = np.array([len(ids) // 4 for ids in encoded], np.int64)
            ends = start + np.cumsum(sizes)
            flat = np.frombuffer(b"".join(encoded), "<i4")
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat, pa.int32())
            )
            yield record_batch(
                _ROWS, batch.column(0), np.full(len(sizes), part, np.int32), ends - sizes, sizes, lists
            )
            start = int(ends[-1]) if len(ends) else start

    return run


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Encode every text and write the ids in ascending id order.

    NULL texts are empty and get the end id alone; NULL ids come first. Rows of
    equal id are ordered by their text's hash; all rows are written.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows of one id may spread over several parts: the hash and the source partition break ties.
    order = ["doc_id", F.xxhash64("text"), F.spark_partition_id()]
    placed = rows.repartitionByRange(*order).sortWithinPartitions("doc_id", F.xxhash64("text"))
    (
        placed.mapInArrow(_encode(spec, end_id), _SCHEMA)
        .write.option("compression", "zstd")
        .option("parquet.block.size", str(row_group_bytes))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("parquet.page.row.count.limit", str(PAGE_ROWS))
        .option("parquet.enable.dictionary", "true")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, local_start, n_tokens, ids) as stored. Conditions on ``doc_id`` reach row groups and pages."""
    return spark.read.schema(_SCHEMA).parquet(path)


def part_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): ids in all parts before. One row per part; only the counts are read."""
    totals = read_token_files(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _checksums(batches):
    out = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("part", pa.int32()),
            ("local_start", pa.int64()),
            ("n_tokens", pa.int64()),
            ("ids_crc32", pa.int64()),
        ]
    )
    for batch in batches:
        lists = batch.column(3)
        flat = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), "<u4")
        ends = np.cumsum(np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
        yield record_batch(out, batch.column(0), batch.column(1), batch.column(2), ends - starts, sums)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored document, counted and summed from the stored ids."""
    stored = read_token_files(spark, path).select("doc_id", "part", "local_start", "ids")
    sums = stored.mapInArrow(_checksums, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    return sums.join(part_starts(spark, path), "part").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
