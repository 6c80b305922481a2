"""News to daily sentiment, end to end."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp, day_and_time, in_day_range, prune_days, time_column_of
from ..functions.sentiment import label_scores
from ..functions.text import compose_headline
from ..operators.dedupe import sequential_id
from ..operators.filters import DEFAULT_THRESHOLD
from ..operators.joins import attach_page_text, attach_url_text
from ..operators.scoring import ModelFactory, add_logits
from ..operators.similarity import label_lists
from .daily import DEFAULT_END_DATE, DEFAULT_START_DATE, daily_sentiment
from .days import fingerprint, stored_stage


def extract_text(news: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """Article text from landed pages where there are any, else from the URL itself."""
    return attach_url_text(news) if pages is None else attach_page_text(news, pages)


def prepare_news(
    news: DataFrame,
    start_date: str = DEFAULT_START_DATE,
    end_date: str = DEFAULT_END_DATE,
    *,
    order: Sequence[str] = ("published_at", "headline"),
    number: bool = True,
) -> DataFrame:
    """Add published_at, headline and article_id to the rows of the day range.

    Day and time texts take precedence over an existing published_at. The ids
    count from 0 in the given order.
    """
    if "day" in news.columns and "hour_minute" in news.columns:
        when = day_and_time(news, "day", "hour_minute")
    elif "published_at" in news.columns:
        when = as_timestamp(news, "published_at")
    elif "timestamp" in news.columns:
        when = as_timestamp(news, "timestamp")
    else:
        raise ValueError("no publication time: expected day with hour_minute, published_at, or timestamp")
    if "day" not in news.columns or "hour_minute" not in news.columns:
        news = prune_days(news, time_column_of(news, "published_at"), start_date, end_date)
    dated = news.withColumn("published_at", when)
    inside = dated.filter(in_day_range(F.col("published_at"), start_date, end_date))
    order = list(order)
    # Numbering reads its input twice, so the texts are composed after it where the order allows.
    early = number and set(order) <= set(inside.columns)
    rows = sequential_id(inside, order) if early else inside
    prepared = rows.withColumn("headline", compose_headline(inside))
    return sequential_id(prepared, order) if number and not early else prepared


def classify_news(
    prepared: DataFrame,
    categories: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    threshold: float = DEFAULT_THRESHOLD,
    **options,
) -> DataFrame:
    """Articles with at least one label, all labels of an article in ``labels``.

    ``encode`` adds an ``embedding`` column; ``categories`` has industria_id,
    subindustria_id, subindustria_nombre and embedding. Only the columns needed
    further on pass through Python.
    """
    articles = encode(prepared.select("article_id", "published_at", "headline"))
    sides = categories.select("industria_id", "subindustria_id", "subindustria_nombre", "embedding")
    return label_lists(
        articles, sides, threshold, article_id="article_id", category_id="subindustria_id", **options
    )


def score_news(
    labelled: DataFrame,
    scorer_factory: ModelFactory | None = None,
    logits: Column | None = None,
    batch_rows: int = 32,
) -> DataFrame:
    """Sentiment per labelled article, then one row per (article, label)."""
    if scorer_factory is not None:
        scored = add_logits(labelled, "headline", scorer_factory, batch_rows=batch_rows)
    elif logits is not None:
        scored = labelled.withColumn("logits", logits)
    else:
        raise ValueError("give a scorer factory or a logits expression")
    return scored.select(
        "article_id", "published_at", "headline", "labels", label_scores(F.col("logits")).alias("_s")
    ).select("article_id", "published_at", "headline", "_s.*", F.inline("labels"))


def daily_pipeline(
    news: DataFrame,
    categories: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    *,
    pages: DataFrame | None = None,
    scorer_factory: ModelFactory | None = None,
    logits: Column | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    start_date: str = DEFAULT_START_DATE,
    end_date: str = DEFAULT_END_DATE,
    stage_dir: str | None = None,
    resume: bool = False,
    version: str = "",
) -> DataFrame:
    """Raw news to one row per (day, sub-industry).

    The news are one lazy plan unless ``stage_dir`` is given (the categories are
    gathered while it is built); then every stage is stored with a fingerprint of its input and parameters, and
    ``resume`` picks up the stages whose fingerprint is still the same. ``version`` names the models, which a
    fingerprint cannot look into. Articles are named by a hash of time and headline: nothing needs them in a sequence, so
    no texts are sorted.
    """

    made_from = ""

    def stage(name: str, build: Callable[[], DataFrame], *inputs: DataFrame, **parameters: object) -> DataFrame:
        nonlocal made_from
        if stage_dir is None:
            return build()
        # A stage is made from the one before, so its fingerprint holds that of the first input, too.
        made_from = fingerprint(made_from, *inputs, name=name, **parameters)
        return stored_stage(news.sparkSession, f"{stage_dir.rstrip('/')}/{name}", made_from, build, resume)

    landed = [news] if pages is None else [news, pages]
    extracted = stage("extracted", lambda: extract_text(news, pages), *landed)

    def prepare() -> DataFrame:
        rows = prepare_news(extracted, start_date, end_date, number=False)
        return rows.withColumn("article_id", F.xxhash64("published_at", "headline"))

    prepared = stage("prepared", prepare, start=start_date, end=end_date)
    labelled = stage(
        "classified", lambda: classify_news(prepared, categories, encode, threshold), categories, threshold=threshold, version=version
    )
    scored = stage("scored", lambda: score_news(labelled, scorer_factory, logits), version=version, logits=str(logits))
    return daily_sentiment(
        scored.select("published_at", "subindustria_id", "sentiment_value"),
        categories,
        start_date=start_date,
        end_date=end_date,
    )
