"""Table and file sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    """Parquet between stages; returns the stored table."""
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headed CSV with doubled quotes, NULL as an empty field."""
    df.write.mode(mode).options(header=True, quote='"', escape='"', emptyValue="").csv(path)


def write_sorted_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """CSV files whose rows are in order, file by file."""
    write_csv(df.orderBy(*order), path)


def write_taxonomy_json(categories: DataFrame, path: str, generated_at: str, version: str = "2.0") -> None:
    """Flat taxonomy inside an envelope with version, time and count.

    A taxonomy is a small document, so it is one row and one file.
    """
    # The envelope's field names.
    envelope = categories.agg(
        F.to_json(
            F.struct(
                F.lit(version).alias("version"),
                F.lit(generated_at).alias("fecha_generacion"),
                F.count(F.lit(1)).alias("total_categorias"),
                F.sort_array(F.collect_list(F.struct(*sorted(categories.columns)))).alias("categorias"),
            )
        ).alias("value")
    )
    envelope.coalesce(1).write.mode("overwrite").text(path)


def replace_table(df: DataFrame, table: str) -> None:
    """Drop and rewrite a table."""
    df.write.mode("overwrite").saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def publish(df: DataFrame, path: str, fmt: str = "parquet", **options: str) -> None:
    """All or nothing: write beside the target, then swap the folders.

    Readers see the old or the new output, never a part of it. Between the two
    renames there is, for a moment, no output under ``path``; if the second one
    fails, the old output is put back.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    fresh, old = f"{path}.tmp-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.format(fmt).options(**options).save(fresh)
    to_path = jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    replaced = files.exists(to_path(path))
    if replaced and not files.rename(to_path(path), to_path(old)):
        raise OSError(f"cannot replace {path}")
    if not files.rename(to_path(fresh), to_path(path)):
        if replaced:
            files.rename(to_path(old), to_path(path))
        raise OSError(f"cannot publish {path}")
    if replaced:
        files.delete(to_path(old), True)
