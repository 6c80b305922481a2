import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparksignal.operators import recurrence
from sparksignal.operators.grid import forward_fill_blocks
from sparksignal.operators.indicators import number_series, series_indicators
from sparksignal.operators.recurrence import recursive_smoothing, span_ratio
from sparksignal.plans.daily import daily_sentiment
from sparksignal.plans.intraday import sentiment_series
from sparksignal.plans.market import bar_indicators, market_indicators

TAXONOMY = [("industry-1", "sub-1", "First"), ("industry-1", "sub-2", "Second")]
TAXONOMY_SCHEMA = "industria_id string, subindustria_id string, subindustria_nombre string"
NEWS = [
    ("2022-01-01T10:00:00Z", "sub-1", 1.0),
    ("2022-01-01T11:00:00Z", "sub-1", -1.0),
    ("2022-01-03T10:00:00Z", "sub-2", 0.5),
]
NEWS_SCHEMA = "published_at string, subindustria_id string, sentiment_value double"


def taxonomy(spark):
    return spark.createDataFrame(TAXONOMY, TAXONOMY_SCHEMA)


def daily(spark, rows, schema=NEWS_SCHEMA, end="2022-01-03", **options):
    news = spark.createDataFrame(rows, schema)
    return daily_sentiment(news, taxonomy(spark), start_date="2022-01-01", end_date=end, **options).collect()


def test_daily_means_and_fill_are_per_subindustry(spark):
    rows = daily(spark, NEWS)
    assert len(rows) == 6
    assert [r["subindustria_id"] for r in rows] == ["sub-1", "sub-2"] * 3
    first = [r for r in rows if r["subindustria_id"] == "sub-1"]
    second = [r for r in rows if r["subindustria_id"] == "sub-2"]
    assert [r["news_count"] for r in first] == [2, 0, 0]
    assert [r["sentiment"] for r in first] == [0.0, 0.0, 0.0]
    assert [r["sentiment_mean"] for r in first] == [0.0, None, None]
    assert [r["sentiment"] for r in second] == [None, None, 0.5]


def test_daily_without_news_keeps_all_subindustries(spark):
    rows = daily(spark, [], end="2022-01-02")
    assert len(rows) == 4
    assert {r["subindustria_id"] for r in rows} == {"sub-1", "sub-2"}
    assert all(r["sentiment"] is None and r["news_count"] == 0 for r in rows)


def test_daily_rejects_bad_input(spark):
    with pytest.raises(ValueError):
        daily(spark, NEWS, end="2021-12-31")
    with pytest.raises(PySparkException, match="cannot be read"):
        daily(spark, [("yesterday", "sub-1", 1.0)])
    with pytest.raises(PySparkException, match="value is missing"):
        daily(spark, [("2022-01-01", "sub-1", float("nan"))])
    labels = "published_at string, subindustria_id string, sentiment string"
    with pytest.raises(PySparkException, match="unknown sentiment label"):
        daily(spark, [("2022-01-01", "sub-1", "Positive")], labels)
    with pytest.raises(ValueError):
        daily(spark, [("2022-01-01", "sub-1")], "published_at string, subindustria_id string")


def test_daily_strict_checks_values_outside_the_range(spark):
    rows = [*NEWS, ("2030-01-01", "sub-1", None)]
    assert len(daily(spark, rows)) == 6
    with pytest.raises(PySparkException, match="value is missing"):
        daily(spark, rows, strict=True)


def test_daily_drops_missing_times_and_unknown_keys(spark):
    rows = daily(spark, [*NEWS, (None, "sub-1", 1.0), ("2022-01-01", None, 1.0), ("2022-01-01", "other", 1.0)])
    assert len(rows) == 6
    assert sum(r["news_count"] for r in rows) == 3


def test_time_column_precedence(spark):
    schema = "timestamp string, published_at string, date string, subindustria_id string, sentiment_value double"
    rows = daily(spark, [("2022-01-02", "2022-01-01", "2022-01-03", "sub-1", 1.0)], schema)
    assert [str(r["date"]) for r in rows if r["news_count"]] == ["2022-01-02"]
    rows = daily(spark, [("2022-01-03", "sub-1", 1.0)], "date string, subindustria_id string, sentiment_value double")
    assert [str(r["date"]) for r in rows if r["news_count"]] == ["2022-01-03"]


def test_series_fills_gaps_and_carries_influence(spark):
    rows = [("2026-08-30T10:00:00Z", 1.0), ("2026-08-30T10:00:00Z", -1.0), ("2026-08-30T10:30:00Z", 1.0)]
    news = spark.createDataFrame(rows, "timestamp string, sentiment_value double")
    out = sentiment_series(news).orderBy("timestamp").collect()
    assert [r["news_count"] for r in out] == [2, 0, 1]
    assert [r["sentiment_mean"] for r in out] == [0.0, None, 1.0]
    assert [r["sentiment"] for r in out] == [0.0, 0.0, 1.0]
    assert [r["sentiment_influenced"] for r in out] == pytest.approx([0.0, 0.0, 0.2], abs=1e-9)
    assert [str(r["timestamp"]) for r in out] == [
        "2026-08-30 10:00:00",
        "2026-08-30 10:15:00",
        "2026-08-30 10:30:00",
    ]


def test_series_accepts_split_time_and_scores(spark):
    rows = [("2026-08-30", "10:00", 0.8, 0.1), ("2026-08-30", " 10:15", 0.1, 0.1)]
    schema = "day string, hour_minute string, score_positive double, score_negative double"
    out = sentiment_series(spark.createDataFrame(rows, schema)).orderBy("timestamp").collect()
    assert [r["sentiment_mean"] for r in out] == pytest.approx([0.7, 0.0], abs=1e-9)
    assert [r["sentiment_influenced"] for r in out] == pytest.approx([0.7, 0.56], abs=1e-9)


def test_series_edge_cases(spark):
    empty = spark.createDataFrame([], "timestamp timestamp, sentiment_value double")
    assert sentiment_series(empty).count() == 0
    with pytest.raises(ValueError):
        sentiment_series(empty, previous_window_weight=1.5)
    rows = [("2026-08-30T10:00:00Z", 1.0), ("2026-08-30T11:00:00Z", -1.0)]
    news = spark.createDataFrame(rows, "timestamp string, sentiment_value double")
    last = lambda w: sentiment_series(news, previous_window_weight=w).orderBy("timestamp").collect()[-1]
    assert last(0.0)["sentiment_influenced"] == -1.0
    assert last(1.0)["sentiment_influenced"] == 1.0


def plain_loop(values, ratio):
    out = []
    for value in values:
        out.append(value if not out else ratio * out[-1] + (1 - ratio) * value)
    return out


def smoothed(spark, values, ratio):
    df = spark.createDataFrame(list(enumerate(values)), "i long, x double")
    return [r["e"] for r in recursive_smoothing(df, "x", "e", ratio, "i").orderBy("i").collect()]


@pytest.mark.parametrize("ratio", [0.0, 1e-40, 0.05, 0.5, 0.8, span_ratio(26), 0.985, 0.9999, 1.0])
def test_smoothing_equals_a_plain_loop(spark, ratio):
    random.seed(7)
    values = [random.uniform(-1, 1) * 10 ** random.randint(-3, 3) for _ in range(7000)]
    expected = plain_loop(values, ratio)
    found = smoothed(spark, values, ratio)
    assert len(found) == len(expected)
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(found, expected))


def test_smoothing_scans_block_ends_recursively(spark, monkeypatch):
    monkeypatch.setattr(recurrence, "MAX_BLOCK", 16)
    monkeypatch.setattr(recurrence, "MAX_LAGS", 30)
    values = [math.sin(i) for i in range(1000)]
    expected = plain_loop(values, 0.995)
    assert smoothed(spark, values, 0.995) == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_blocks_keep_powers_finite():
    for ratio in (1e-300, 1e-9, 0.1, 0.8, 0.99, 0.9999999):
        assert ratio ** recurrence.block_size([ratio]) > 0 or ratio < 1e-50


@pytest.mark.parametrize("ratio", [1e-60, 0.1, 0.8, span_ratio(12), span_ratio(26), span_ratio(200)])
def test_no_history_is_cut(spark, ratio):
    """A tail that decays through the whole range of doubles, and one that starts very large."""
    for start in (1.0, 1e300):
        values = [start] + [0.0] * 5000
        expected = plain_loop(values, ratio)
        found = smoothed(spark, values, ratio)
        for e, f in zip(expected, found, strict=True):
            assert f == pytest.approx(e, rel=1e-9, abs=1e-300)


def test_long_spans(spark):
    rng = np.random.default_rng(2)
    closes = (100 + rng.normal(size=3000).cumsum()).tolist()
    df = spark.createDataFrame([("a", i, c) for i, c in enumerate(closes)], "k string, i long, close double")
    for fast, slow in ((12, 200), (1, 400), (150, 160)):
        rows = series_indicators(df, "close", "i", ["k"], fast=fast, slow=slow).orderBy("i").collect()
        assert [r["ema_fast"] for r in rows] == pytest.approx(plain_loop(closes, span_ratio(fast)), rel=1e-9)
        assert [r["ema_slow"] for r in rows] == pytest.approx(plain_loop(closes, span_ratio(slow)), rel=1e-9)


def test_block_fill_crosses_blocks(spark):
    values = [None, None, 1.0, None, None, None, None, None, None, 2.0, None]
    df = spark.createDataFrame(list(enumerate(values)), "i long, x double")
    out = forward_fill_blocks(df, "x", "y", "i", block=3).orderBy("i").collect()
    assert [r["y"] for r in out] == [None, None, *[1.0] * 7, 2.0, 2.0]
    again = forward_fill_blocks(forward_fill_blocks(df, "x", "y", "i", block=3), "y", "z", "i", block=4)
    assert all(r["y"] == r["z"] for r in again.collect())


def test_number_series_counts_over_chunks(spark):
    df = spark.range(0, 400).select(
        (F.col("id") % 2).alias("k"), F.timestamp_seconds(F.col("id") * 86400 * 3).alias("ts"), "id"
    )
    rows = number_series(df, ["k"], ["ts"], "n").orderBy("k", "ts").collect()
    for key in (0, 1):
        assert [r["n"] for r in rows if r["k"] == key] == list(range(200))


def bars(spark, series):
    rows = [
        (ticker, day, close) for ticker, closes in series.items() for day, close in enumerate(closes)
    ]
    df = spark.createDataFrame(rows, "ticker string, day int, close double")
    price = F.col("close")
    return df.select(
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("day")).cast("timestamp").alias("timestamp"),
        "ticker",
        price.alias("open"),
        price.alias("high"),
        price.alias("low"),
        "close",
        F.lit(1.0).alias("volume"),
    )


def plain_rsi(closes, period=14):
    gains, losses = [0.0], [0.0]
    for before, after in zip(closes, closes[1:]):
        gains.append(max(after - before, 0.0))
        losses.append(max(before - after, 0.0))
    out = []
    for i in range(len(closes)):
        if i < period - 1:
            out.append(None)
            continue
        gain, loss = sum(gains[i - period + 1 : i + 1]), sum(losses[i - period + 1 : i + 1])
        out.append(100 - 100 / (1 + gain / loss) if loss else (100.0 if gain else None))
    return out


def test_market_indicators(spark):
    random.seed(3)
    series = {
        "UP": [float(i) for i in range(1, 21)],
        "FLAT": [5.0] * 20,
        "MIX.B": [10 + random.uniform(-1, 1) for _ in range(1300)],
    }
    rows = market_indicators(bars(spark, series)).orderBy("ticker", "timestamp").collect()
    by_ticker = {}
    for row in rows:
        by_ticker.setdefault(row["ticker"], []).append(row)
    assert set(by_ticker) == {"UP", "MIX-B"}
    assert [r["rsi"] for r in by_ticker["UP"]] == [100.0] * 7
    mixed = series["MIX.B"]
    expected = [x for x in plain_rsi(mixed) if x is not None]
    assert [r["rsi"] for r in by_ticker["MIX-B"]] == pytest.approx(expected, rel=1e-9)
    fast, slow = plain_loop(mixed, span_ratio(12)), plain_loop(mixed, span_ratio(26))
    macd = [a - b for a, b in zip(fast, slow)][13:]
    assert [r["macd"] for r in by_ticker["MIX-B"]] == pytest.approx(macd, rel=1e-9, abs=1e-12)


def test_market_crosses_blocks(spark):
    random.seed(5)
    closes = [10 + random.uniform(-1, 1) for _ in range(3500)]
    rows = bar_indicators(bars(spark, {"LONG": closes})).orderBy("_position").collect()
    assert [r["_position"] for r in rows] == list(range(3500))
    assert [r["rsi"] for r in rows][:13] == [None] * 13
    assert [r["rsi"] for r in rows][13:] == pytest.approx(plain_rsi(closes)[13:], rel=1e-9)
    assert [r["ema_slow"] for r in rows] == pytest.approx(plain_loop(closes, span_ratio(26)), rel=1e-12)


def test_market_drops_missing_closes_before_and_gaps_after(spark):
    df = bars(spark, {"A": [float(i % 5 + i) for i in range(1, 31)]})
    holed = df.withColumn("close", F.when(F.dayofmonth("timestamp") == 3, None).otherwise(F.col("close"))).withColumn(
        "open", F.when(F.dayofmonth("timestamp") == 25, None).otherwise(F.col("open"))
    )
    rows = market_indicators(holed).collect()
    assert len(rows) == 30 - 1 - 13 - 1
