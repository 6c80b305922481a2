"""Sentiment labels, scores and values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fail_if

# Label order of the scoring model, and the value of each label.
SENTIMENT_LABELS = ["positive", "negative", "neutral"]
VALUE_OF_LABEL = {"positive": 1.0, "neutral": 0.0, "negative": -1.0}


def label_value(label: Column) -> Column:
    """positive, neutral, negative (exact case) as 1, 0, -1; anything else is NULL."""
    mapping = F.create_map(*[F.lit(x) for pair in VALUE_OF_LABEL.items() for x in pair])
    return F.try_element_at(mapping, label)


def sentiment_value(df: DataFrame, sentiment_column: str = "sentiment_value") -> Column:
    """One sentiment number per row, by fixed precedence of the columns present.

    A missing value or an unknown label is an error.
    """
    columns = set(df.columns)
    fault = F.lit("a sentiment value is missing")
    if sentiment_column in columns:
        value = F.col(sentiment_column).cast("double")
    elif {"score_positive", "score_negative"} <= columns:
        value = F.col("score_positive").cast("double") - F.col("score_negative").cast("double")
    elif "sentiment" in columns:
        # Unknown labels have no value and fail below.
        value = label_value(F.col("sentiment"))
        unknown = F.concat(F.lit("unknown sentiment label: "), F.col("sentiment"))
        fault = F.coalesce(unknown, fault)
    else:
        raise ValueError("no sentiment: expected sentiment_value, positive and negative scores, or labels")
    # The value is evaluated once; the message only where there is none.
    return F.coalesce(F.nanvl(value, F.lit(None).cast("double")), F.raise_error(fault).cast("double"))


def softmax(scores: Column, temperature: float = 1.0) -> Column:
    """Softmax over an ARRAY<DOUBLE>, shifted by its maximum."""
    top = F.array_max(scores)
    powers = F.transform(scores, lambda s: F.exp((s - top) / F.lit(float(temperature))))
    total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
    return F.transform(powers, lambda p: p / total)


def label_scores(logits: Column) -> Column:
    """STRUCT<sentiment, score_positive, score_negative, score_neutral, sentiment_value>.

    ``logits`` is ARRAY<DOUBLE> in ``SENTIMENT_LABELS`` order; the first maximum wins.
    """
    probs = softmax(logits)
    labels = F.array(*[F.lit(x) for x in SENTIMENT_LABELS])
    best = F.array_position(logits, F.array_max(logits)).cast("int")
    positive, negative, neutral = (F.get(probs, i) for i in range(3))
    return F.struct(
        F.get(labels, best - 1).alias("sentiment"),
        positive.alias("score_positive"),
        negative.alias("score_negative"),
        neutral.alias("score_neutral"),
        (positive - negative).alias("sentiment_value"),
    )
