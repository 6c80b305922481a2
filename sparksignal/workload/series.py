"""Calendars, series and market indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import floor_minutes, publication_time
from ..functions.sentiment import sentiment_value
from ..functions.text import normalize_symbol
from ..operators.filters import day_range_filter
from ..operators.grid import day_calendar, forward_fill, interval_calendar, reindex
from ..operators.joins import dimension_join
from ..operators.recurrence import recursive_smoothing
from ..plans.daily import daily_means, daily_sentiment as daily_job
from ..plans.days import build_days, read_days, update_days
from ..plans.intraday import interval_means, scored_times, sentiment_series
from ..plans.market import bar_indicators, market_indicators as market_job, numbered_bars
from ..sources.bars import bars_to_long
from ..session import work_path
from .tables import SQL_BARS, SQL_VALUE, event_news, landed_bars, nation_taxonomy, rounded, stamp, supplier_bars, table, unit_price

START, END = "2023-12-30", "2024-02-02"


def daily_sentiment(spark, sf):
    result = daily_job(event_news(spark, sf), nation_taxonomy(spark, sf), start_date=START, end_date=END)
    return result.select(
        F.col("date").cast("string").alias("date"),
        "subindustria_id",
        "news_count",
        rounded("sentiment_mean").alias("sentiment_mean"),
        rounded("sentiment").alias("sentiment"),
        "industria_id",
        "subindustria_nombre",
    )


def daily_sentiment_by_days(spark, sf):
    """The daily series built for its first days with half of one day's news, then corrected for that day and carried on."""
    path = work_path(spark, "days")
    news, taxonomy = event_news(spark, sf), nation_taxonomy(spark, sf)
    day = F.to_date("published_at")
    partial = news.where((day != "2024-01-12") | (F.hour("published_at") < 12))
    build_days(partial.where(day <= "2024-01-20"), taxonomy, path, START, "2024-01-20")
    update_days(news, taxonomy, path, "2024-01-12", "2024-01-12")
    update_days(news, taxonomy, path, "2024-01-21", "2024-01-25", end_date=END)
    update_days(news, taxonomy, path, "2024-01-26", END)
    return read_days(spark, path).select(
        F.col("date").cast("string").alias("date"),
        "subindustria_id",
        "news_count",
        rounded("sentiment_mean").alias("sentiment_mean"),
        rounded("sentiment").alias("sentiment"),
        "industria_id",
        "subindustria_nombre",
    )


def daily_news_means(spark, sf):
    return daily_means(event_news(spark, sf), START, END).select(
        F.col("date").cast("string").alias("date"),
        "subindustria_id",
        "news_count",
        rounded("sentiment_mean").alias("sentiment_mean"),
    )


def calendar_grid(spark, sf):
    grid = day_calendar(nation_taxonomy(spark, sf), START, END)
    counts = event_news(spark, sf).groupBy("subindustria_id").agg(F.count(F.lit(1)).alias("total_news"))
    return dimension_join(grid, counts, "subindustria_id").select(
        F.col("date").cast("string").alias("date"), "industria_id", "subindustria_id", "total_news"
    )


def reindexed_counts(spark, sf):
    grid = day_calendar(nation_taxonomy(spark, sf).select("subindustria_id"), START, END)
    means = daily_means(event_news(spark, sf), START, END)
    return reindex(grid, means, ["date", "subindustria_id"], ["news_count"]).select(
        F.col("date").cast("string").alias("date"),
        "subindustria_id",
        "news_count",
        rounded("sentiment_mean").alias("sentiment_mean"),
    )


def supplier_price_fill(spark, sf):
    """Monthly mean price per nation of the suppliers, carried over months without one."""
    months = (
        table(spark, sf, "orders")
        .filter("o_orderstatus = 'F'")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_mktsegment", F.to_date("o_orderdate").alias("date"))
        .agg(F.avg("o_totalprice").alias("price"))
    )
    keys = table(spark, sf, "customer").select("c_mktsegment").distinct()
    grid = day_calendar(keys, "1994-12-25", "1995-06-30")
    filled = forward_fill(grid.join(months, ["c_mktsegment", "date"], "left"), "price", "carried", ["c_mktsegment"], "date")
    return filled.select(
        "c_mktsegment",
        F.col("date").cast("string").alias("date"),
        rounded("price").alias("price"),
        rounded("carried").alias("carried"),
    )


def sentiment_15m(spark, sf):
    return sentiment_series(event_news(spark, sf)).select(
        stamp("timestamp").alias("timestamp"),
        "news_count",
        rounded("sentiment_mean").alias("sentiment_mean"),
        rounded("sentiment").alias("sentiment"),
        rounded("sentiment_influenced").alias("sentiment_influenced"),
    )


def sentiment_15m_by_industry(spark, sf):
    news = event_news(spark, sf).join(nation_taxonomy(spark, sf), "subindustria_id")
    return sentiment_series(news, keys=["industria_id"], previous_window_weight=0.5).select(
        "industria_id",
        stamp("timestamp").alias("timestamp"),
        "news_count",
        rounded("sentiment").alias("sentiment"),
        rounded("sentiment_influenced").alias("sentiment_influenced"),
    )


def interval_news_means(spark, sf):
    return interval_means(scored_times(event_news(spark, sf))).select(
        stamp("timestamp").alias("timestamp"), "news_count", rounded("sentiment_mean").alias("sentiment_mean")
    )


def dense_15m_calendar(spark, sf):
    rows = scored_times(event_news(spark, sf), ["subindustria_id"])
    return interval_calendar(rows, "_ts", ["subindustria_id"]).select(
        "subindustria_id", "position", stamp("timestamp").alias("timestamp")
    )


def floored_events(spark, sf):
    news = event_news(spark, sf, "event_id")
    return day_range_filter(news, "2024-01-05", "2024-01-20").select(
        "event_id",
        stamp(floor_minutes(publication_time(news))).alias("window_start"),
        F.to_date("published_at").cast("string").alias("day"),
        sentiment_value(news).alias("value"),
    )


def long_memory_smoothing(spark, sf):
    """Event values smoothed per user group with a weight near one."""
    series = sentiment_series(event_news(spark, sf), previous_window_weight=0.0)
    first = series.agg(F.min("timestamp").alias("_first")).withColumn("_one", F.lit(1))
    numbered = series.withColumn("_one", F.lit(1)).join(first, "_one").withColumn(
        "position", ((F.unix_timestamp("timestamp") - F.unix_timestamp("_first")) / 900).cast("long")
    )
    return recursive_smoothing(numbered, "sentiment", "smooth", 0.9995, "position").select(
        stamp("timestamp").alias("timestamp"), rounded("smooth").alias("smooth")
    )


def normalized_symbols(spark, sf):
    return supplier_bars(spark, sf).select(normalize_symbol(F.col("ticker")).alias("ticker")).distinct()


def bars_wide_to_long(spark, sf):
    """Daily bars per return flag, first one column per flag and price, then long again."""
    price = unit_price()
    flags = ["A", "N", "R"]

    def of(flag, value):
        return F.when(F.col("l_returnflag") == flag, value)

    columns = []
    for flag in flags:
        columns += [
            F.min(of(flag, price)).alias(f"{flag}|Low"),
            F.max(of(flag, price)).alias(f"{flag}|High"),
            F.max(of(flag, price)).alias(f"{flag}|Close"),
            F.sum(of(flag, F.col("l_quantity"))).alias(f"{flag}|Volume"),
        ]
    wide = table(spark, sf, "lineitem").groupBy(F.col("l_shipdate").alias("Date")).agg(*columns)
    return bars_to_long(wide, [*flags, "X"]).select(
        stamp("timestamp").alias("timestamp"),
        "ticker",
        "open",
        rounded("high").alias("high"),
        rounded("low").alias("low"),
        rounded("close").alias("close"),
        rounded("volume").alias("volume"),
    )


def bar_positions(spark, sf):
    return numbered_bars(landed_bars(spark, sf)).select(
        "ticker", stamp("timestamp").alias("timestamp"), F.col("_position").alias("position")
    )


def _indicators(spark, sf, *columns):
    rows = bar_indicators(landed_bars(spark, sf).select("timestamp", "ticker", "close"))
    return rows.select("ticker", stamp("timestamp").alias("timestamp"), *[rounded(c, 4).alias(c) for c in columns])


def price_difference(spark, sf):
    return _indicators(spark, sf, "diff")


def market_rsi(spark, sf):
    return _indicators(spark, sf, "rsi")


def exponential_means(spark, sf):
    return _indicators(spark, sf, "ema_fast", "ema_slow")


def market_macd(spark, sf):
    return _indicators(spark, sf, "macd")


def market_indicators(spark, sf):
    rows = market_job(landed_bars(spark, sf))
    numbers = ["open", "high", "low", "close", "volume", "rsi", "macd"]
    return rows.select("ticker", stamp("timestamp").alias("timestamp"), *[rounded(c, 4).alias(c) for c in numbers])


QUERIES = {
    f.__name__: f
    for f in (
        daily_sentiment,
        daily_sentiment_by_days,
        daily_news_means,
        calendar_grid,
        reindexed_counts,
        supplier_price_fill,
        sentiment_15m,
        sentiment_15m_by_industry,
        interval_news_means,
        dense_15m_calendar,
        floored_events,
        long_memory_smoothing,
        normalized_symbols,
        bars_wide_to_long,
        bar_positions,
        price_difference,
        market_rsi,
        exponential_means,
        market_macd,
        market_indicators,
    )
}

_DAILY = f"""
news AS (SELECT CAST(ts AS DATE) AS d, CAST(user_id % 25 AS VARCHAR) AS k, {SQL_VALUE} AS v FROM events),
agg AS (SELECT d, k, count(*) AS n, avg(v) AS m FROM news
        WHERE d BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1, 2),
grid AS (SELECT CAST(r AS DATE) AS d, CAST(n_nationkey AS VARCHAR) AS k, n_name, r_name
         FROM nation JOIN region ON n_regionkey = r_regionkey,
              range(TIMESTAMP '{START}', TIMESTAMP '{END}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(r))
"""

_WINDOWS = f"""
news AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS w, {SQL_VALUE} AS v FROM events),
agg AS (SELECT w, count(*) AS n, avg(v) AS m FROM news GROUP BY 1),
grid AS (SELECT unnest(generate_series(min(w), max(w), INTERVAL 15 MINUTE)) AS w FROM agg),
filled AS (SELECT w, coalesce(n, 0) AS n, m, last_value(m IGNORE NULLS) OVER (ORDER BY w) AS s,
                  row_number() OVER (ORDER BY w) AS i
           FROM grid LEFT JOIN agg USING (w)),
series AS (SELECT list(s ORDER BY w) AS xs FROM filled)
"""

_SERIES = f"""
{SQL_BARS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY t) AS i,
                    c - lag(c) OVER (PARTITION BY ticker ORDER BY t) AS d FROM bars),
lists AS (SELECT ticker, list(c ORDER BY t) AS xs FROM bars GROUP BY 1),
means AS (
  SELECT ticker, t, o, h, l, c, v, i, d,
         list_reduce(xs[1:i], lambda a, x: (1 - 2.0::DOUBLE / 13) * a + 2.0::DOUBLE / 13 * x) AS fast,
         list_reduce(xs[1:i], lambda a, x: (1 - 2.0::DOUBLE / 27) * a + 2.0::DOUBLE / 27 * x) AS slow,
         avg(greatest(coalesce(d, 0), 0)) OVER w AS up, avg(greatest(-coalesce(d, 0), 0)) OVER w AS down
  FROM numbered JOIN lists USING (ticker)
  WINDOW w AS (PARTITION BY ticker ORDER BY t ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
done AS (
  SELECT *, CASE WHEN i < 14 THEN NULL WHEN down > 0 THEN 100 - 100 / (1 + up / down)
                 WHEN up > 0 THEN 100.0 END AS rsi FROM means)
"""
_KEY = "ticker, strftime(t, '%Y-%m-%d %H:%M:%S') AS timestamp"

ORACLES = {
    "daily_sentiment": f"""
WITH {_DAILY}
SELECT CAST(d AS VARCHAR) AS date, k AS subindustria_id, coalesce(n, 0) AS news_count,
       round(m, 6) AS sentiment_mean,
       round(last_value(m IGNORE NULLS) OVER (PARTITION BY k ORDER BY d
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS sentiment,
       r_name AS industria_id, n_name AS subindustria_nombre
FROM grid LEFT JOIN agg USING (d, k)""",
    "daily_news_means": f"""
WITH {_DAILY}
SELECT CAST(d AS VARCHAR) AS date, k AS subindustria_id, n AS news_count, round(m, 6) AS sentiment_mean FROM agg""",
    "calendar_grid": f"""
WITH {_DAILY}, totals AS (SELECT k, count(*) AS total_news FROM news GROUP BY 1)
SELECT CAST(d AS VARCHAR) AS date, r_name AS industria_id, k AS subindustria_id, total_news
FROM grid LEFT JOIN totals USING (k)""",
    "reindexed_counts": f"""
WITH {_DAILY}
SELECT CAST(d AS VARCHAR) AS date, k AS subindustria_id, coalesce(n, 0) AS news_count, round(m, 6) AS sentiment_mean
FROM grid LEFT JOIN agg USING (d, k)""",
    "supplier_price_fill": """
WITH months AS (
  SELECT c_mktsegment, CAST(o_orderdate AS DATE) AS d, avg(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2),
grid AS (
  SELECT c_mktsegment, CAST(r AS DATE) AS d FROM (SELECT DISTINCT c_mktsegment FROM customer),
         range(TIMESTAMP '1994-12-25', TIMESTAMP '1995-07-01', INTERVAL 1 DAY) t(r))
SELECT c_mktsegment, CAST(d AS VARCHAR) AS date, round(price, 6) AS price,
       round(last_value(price IGNORE NULLS) OVER (PARTITION BY c_mktsegment ORDER BY d
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS carried
FROM grid LEFT JOIN months USING (c_mktsegment, d)""",
    "sentiment_15m": f"""
WITH {_WINDOWS}
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp, n AS news_count, round(m, 6) AS sentiment_mean,
       round(s, 6) AS sentiment,
       round(list_reduce(xs[1:i], lambda a, x: 0.8::DOUBLE * a + 0.2::DOUBLE * x), 6) + 0.0 AS sentiment_influenced
FROM filled, series""",
    "sentiment_15m_by_industry": f"""
WITH news AS (
  SELECT r_name AS k, time_bucket(INTERVAL 15 MINUTE, ts) AS w, {SQL_VALUE} AS v
  FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey),
agg AS (SELECT k, w, count(*) AS n, avg(v) AS m FROM news GROUP BY 1, 2),
grid AS (SELECT k, unnest(generate_series(min(w), max(w), INTERVAL 15 MINUTE)) AS w FROM agg GROUP BY 1),
filled AS (SELECT k, w, coalesce(n, 0) AS n,
                  last_value(m IGNORE NULLS) OVER (PARTITION BY k ORDER BY w) AS s,
                  row_number() OVER (PARTITION BY k ORDER BY w) AS i
           FROM grid LEFT JOIN agg USING (k, w)),
series AS (SELECT k, list(s ORDER BY w) AS xs FROM filled GROUP BY 1)
SELECT k AS industria_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp, n AS news_count, round(s, 6) AS sentiment,
       round(list_reduce(xs[1:i], lambda a, x: 0.5::DOUBLE * a + 0.5::DOUBLE * x), 6) + 0.0 AS sentiment_influenced
FROM filled JOIN series USING (k)""",
    "interval_news_means": f"""
WITH {_WINDOWS}
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp, n AS news_count, round(m, 6) AS sentiment_mean FROM agg""",
    "dense_15m_calendar": """
WITH bounds AS (
  SELECT CAST(user_id % 25 AS VARCHAR) AS k, time_bucket(INTERVAL 15 MINUTE, min(ts)) AS a,
         time_bucket(INTERVAL 15 MINUTE, max(ts)) AS b FROM events GROUP BY 1),
steps AS (SELECT k, a, unnest(generate_series(a, b, INTERVAL 15 MINUTE)) AS w FROM bounds)
SELECT k AS subindustria_id, CAST(epoch(w - a) / 900 AS BIGINT) AS position,
       strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp FROM steps""",
    "floored_events": f"""
SELECT event_id, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST({SQL_VALUE} AS DOUBLE) AS value
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21'""",
    "long_memory_smoothing": f"""
WITH {_WINDOWS}
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp,
       round(list_reduce(xs[1:i], lambda a, x: 0.9995::DOUBLE * a + (1 - 0.9995::DOUBLE) * x), 6) + 0.0 AS smooth
FROM filled, series""",
    "normalized_symbols": "SELECT DISTINCT 'S-' || l_suppkey AS ticker FROM lineitem",
    "bars_wide_to_long": f"""
WITH {SQL_BARS}, days AS (SELECT DISTINCT t FROM items), flags AS (SELECT unnest(['A', 'N', 'R']) AS f)
SELECT strftime(d.t, '%Y-%m-%d %H:%M:%S') AS timestamp, f AS ticker, CAST(NULL AS DOUBLE) AS open,
       round(max(p), 6) AS high, round(min(p), 6) AS low, round(max(p), 6) AS close, round(sum(q), 6) AS volume
FROM days d CROSS JOIN flags LEFT JOIN items x ON x.t = d.t AND x.flag = f
GROUP BY d.t, f""",
    "bar_positions": f"WITH {_SERIES} SELECT {_KEY}, i - 1 AS position FROM numbered",
    "price_difference": f"WITH {_SERIES} SELECT {_KEY}, round(d, 4) AS diff FROM numbered",
    "market_rsi": f"WITH {_SERIES} SELECT {_KEY}, round(rsi, 4) AS rsi FROM done",
    "exponential_means": f"""
WITH {_SERIES} SELECT {_KEY}, round(fast, 4) AS ema_fast, round(slow, 4) AS ema_slow FROM done""",
    "market_macd": f"WITH {_SERIES} SELECT {_KEY}, round(fast - slow, 4) AS macd FROM done",
    "market_indicators": f"""
WITH {_SERIES}
SELECT {_KEY}, round(o, 4) AS open, round(h, 4) AS high, round(l, 4) AS low, round(c, 4) AS close,
       round(v, 4) AS volume, round(rsi, 4) AS rsi, round(fast - slow, 4) AS macd
FROM done WHERE rsi IS NOT NULL""",
}
ORACLES["daily_sentiment_by_days"] = ORACLES["daily_sentiment"]
