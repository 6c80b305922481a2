"""Models over batches that may fail: what cannot be scored is set aside with its reason, and counted."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sentiment import label_scores
from ..session import cut_lineage
from .scoring import ModelFactory

_RESULT, _REASON = "_result", "_reason"


@dataclass(frozen=True)
class Scored:
    """Rows with their result, rows without one and why, and the counts of both from the job that scored them."""

    kept: DataFrame
    quarantined: DataFrame
    counts: dict[str, int]


def _rows_of(model, texts: list[str]) -> np.ndarray:
    found = np.asarray(model(texts), dtype=np.float64)
    if found.ndim != 2 or len(found) != len(texts):
        raise ValueError(f"{len(texts)} texts gave a result of shape {found.shape}")
    return found


def _attempt(model, texts: list[str]) -> tuple[list, list]:
    """(results, reasons): the batch at once, or, if that fails, row by row."""
    try:
        return list(_rows_of(model, texts)), [None] * len(texts)
    except Exception:  # any fault of the model, found again row by row
        results, reasons = [], []
        for text in texts:
            try:
                results.append(_rows_of(model, [text])[0])
                reasons.append(None)
            except Exception as fault:
                results.append(None)
                reasons.append(f"{type(fault).__name__}: {fault}")
        return results, reasons


def apply_model(df: DataFrame, text: str, factory: ModelFactory, *, out: str = "result", batch_rows: int = 32) -> Scored:
    """One array of doubles per row of ``df``, from a model that may fail on some texts.

    A batch that fails is tried again row by row. Rows the model fails on go to
    ``quarantined`` with a ``reason``, all others to ``kept`` with ``out``; each
    input row is in exactly one of them. A NULL text is empty text. The rows are
    scored once and stored; the counts come from that job. A factory that fails
    fails the job: then no row can be scored.
    """
    clash = {out, "reason", _RESULT, _REASON} & set(df.columns)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    schema = T.StructType(
        [*df.schema, T.StructField(_RESULT, T.ArrayType(T.DoubleType())), T.StructField(_REASON, T.StringType())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                results, reasons = _attempt(model, [t or "" for t in part.column(text).to_pylist()])
                added = [pa.array(results, pa.list_(pa.float64())), pa.array(reasons, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, _RESULT, _REASON])

    seen = Observation()
    failed = F.col(_REASON).isNotNull()
    counts = [F.count(F.lit(1)).alias("total"), F.count(F.when(~failed, 1)).alias("kept"), F.count(F.when(failed, 1)).alias("quarantined")]
    rows = cut_lineage(df.mapInArrow(score, schema).observe(seen, *counts))
    return Scored(
        rows.where(~failed).select(*df.columns, F.col(_RESULT).alias(out)),
        rows.where(failed).select(*df.columns, F.col(_REASON).alias("reason")),
        {name: seen.get[name] for name in ("total", "kept", "quarantined")},
    )


def score_with_quarantine(df: DataFrame, text: str, scorer_factory: ModelFactory, *, batch_rows: int = 32) -> Scored:
    """``apply_model`` for a sentiment scorer; kept rows have the sentiment columns instead of the model's numbers."""
    scored = apply_model(df, text, scorer_factory, out="_logits", batch_rows=batch_rows)
    values = scored.kept.withColumn("_s", label_scores(F.col("_logits"))).select(*df.columns, "_s.*")
    return Scored(values, scored.quarantined, scored.counts)
