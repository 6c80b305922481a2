"""What the operators of this package share: table access, byte words, batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import configure

#: Rows of one Arrow batch; texts may be long, so batches hold few of them.
BATCH_ROWS = 256

_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"

#: Lower-cases A-Z and leaves every other byte.
LOWER = bytes.maketrans(_UPPER, _LOWER)

#: Lower-cases A-Z and turns all ASCII bytes but digits and letters into blanks.
#: Bytes of other characters are 0x80 and above, so words may be cut on bytes.
WORDS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in LOWER)


def small_batches(spark: SparkSession) -> SparkSession:
    """Hand few rows at a time to Python: single texts may be long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def byte_words(text: bytes | None) -> list[bytes]:
    """Lower-cased runs of digits, letters and characters beyond ASCII."""
    return text.translate(WORDS).split() if text else []


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )


def slices(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
