"""Models applied to batches of text.

A model is given as a factory. It is called once per task, on the executor,
and returns a function from a list of texts to an array.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.sentiment import label_scores
from .dedupe import first_by_key

#: Words whose bucket a task of the hashing encoder remembers.
REMEMBERED_WORDS = 100_000

Encoder = Callable[[Sequence[str]], np.ndarray]
ModelFactory = Callable[[], Encoder]

# A short list of finance words for the shipped lexicon scorer.
POSITIVE_WORDS = ["beat", "gain", "gains", "growth", "profit", "rally", "record", "surge", "upgrade", "win"]
NEGATIVE_WORDS = ["cut", "decline", "default", "drop", "fall", "lawsuit", "loss", "miss", "recall", "downgrade"]

SCORE_COLUMNS = ["sentiment", "score_positive", "score_negative", "score_neutral", "sentiment_value"]


def embed_text(
    df: DataFrame, text: str, encoder_factory: ModelFactory, *, out: str = "embedding", batch_rows: int = 128
) -> DataFrame:
    """Add one float vector per row; a NULL text is encoded as empty text."""
    schema = T.StructType([*df.schema, T.StructField(out, T.ArrayType(T.FloatType()))])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_factory()
        for batch in batches:
            for start in range(0, len(batch), batch_rows):
                part = batch.iloc[start : start + batch_rows]
                vectors = np.asarray(encoder(part[text].fillna("").tolist()), dtype=np.float32)
                yield part.assign(**{out: list(vectors)})

    return df.mapInPandas(encode, schema)


def join_vectors(df: DataFrame, vectors: DataFrame, key: str) -> DataFrame:
    """Precomputed vectors instead of an encoder; a row without one is an error, not a loss."""
    known = vectors.select(key, F.col("embedding").alias("_known"))
    missing = F.raise_error(F.lit("an article has no vector")).cast(vectors.schema["embedding"].dataType)
    joined = df.join(known, key, "left")
    return joined.withColumn("embedding", F.coalesce("_known", missing)).drop("_known")


def hashing_encoder(dimension: int = 64) -> ModelFactory:
    """Word counts hashed into ``dimension`` buckets; needs no trained model."""

    def factory() -> Encoder:
        buckets: dict[str, int] = {}

        def bucket(word: str) -> int:
            if word not in buckets:
                if len(buckets) >= REMEMBERED_WORDS:
                    buckets.clear()
                buckets[word] = int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % dimension
            return buckets[word]

        def encode(texts: Sequence[str]) -> np.ndarray:
            out = np.zeros((len(texts), dimension), dtype=np.float32)
            for row, text in enumerate(texts):
                hits = [bucket(word) for word in text.lower().split()]
                if hits:
                    out[row] = np.bincount(hits, minlength=dimension)
            return out

        return encode

    return factory


def add_logits(df: DataFrame, text: str, scorer_factory: ModelFactory, *, batch_rows: int = 32) -> DataFrame:
    """Add ``logits`` in positive, negative, neutral order; all other columns pass through as they are."""
    schema = T.StructType([*df.schema, T.StructField("logits", T.ArrayType(T.DoubleType()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = scorer_factory()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_rows):
                part = batch.slice(start, batch_rows)
                texts = [t or "" for t in part.column(text).to_pylist()]
                logits = np.asarray(scorer(texts), dtype=np.float64)
                arrays = [*part.columns, pa.array(list(logits), pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=[*part.schema.names, "logits"])

    return df.mapInArrow(score, schema)


def lexicon_scorer(
    weights: Mapping[str, float] | None = None, neutral: float = 1.0
) -> ModelFactory:
    """Batch scorer: summed positive and negative word weights as logits."""
    words = dict(weights) if weights is not None else _default_weights()

    def factory() -> Encoder:
        token = re.compile(r"\w+")

        def score(texts: Sequence[str]) -> np.ndarray:
            out = np.empty((len(texts), 3))
            for row, text in enumerate(texts):
                found = [words[w] for w in token.findall(text.lower()) if w in words]
                out[row] = (sum(v for v in found if v > 0), -sum(v for v in found if v < 0), neutral)
            return out

        return score

    return factory


def lexicon_logits(text: Column, weights: Mapping[str, float] | None = None, neutral: float = 1.0) -> Column:
    """The lexicon scorer as a plain expression, without Python workers."""
    words = dict(weights) if weights is not None else _default_weights()
    lowered = F.lower(F.coalesce(text, F.lit("")))

    def total(sign: int) -> Column:
        out = F.lit(0.0)
        for weight in sorted({v for v in words.values() if v * sign > 0}):
            group = "|".join(sorted(re.escape(w) for w, v in words.items() if v == weight))
            out = out + F.regexp_count(lowered, F.lit(rf"(?U)\b(?:{group})\b")) * F.lit(abs(float(weight)))
        return out

    return F.array(total(1), total(-1), F.lit(float(neutral)))


def _default_weights() -> dict[str, float]:
    return {**dict.fromkeys(POSITIVE_WORDS, 1.0), **dict.fromkeys(NEGATIVE_WORDS, -1.0)}


def score_articles(
    news: DataFrame,
    scorer_factory: ModelFactory | None = None,
    *,
    key: str = "article_id",
    text: str = "headline",
    logits: Column | None = None,
    batch_rows: int = 32,
    unique: bool = False,
) -> DataFrame:
    """Add sentiment columns; each article is scored once, however many labels it has.

    Give either a batch scorer or a ``logits`` expression over the text column.
    With ``unique`` every row is an article of its own and is scored in place;
    otherwise the texts of repeated keys are taken once, scored and joined back.
    """
    if scorer_factory is None and logits is None:
        raise ValueError("give a scorer factory or a logits expression")
    articles = news if unique else first_by_key(news.select(key, text), [key], [text])
    if scorer_factory is not None:
        scored = add_logits(articles, text, scorer_factory, batch_rows=batch_rows)
    else:
        scored = articles.withColumn("logits", logits)
    kept = news.columns if unique else [key]
    values = scored.select(*kept, label_scores(F.col("logits")).alias("_s")).select(*kept, "_s.*")
    return values if unique else news.join(values, key, "left").select(*news.columns, *SCORE_COLUMNS)
