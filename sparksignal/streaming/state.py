"""Streams with state per key: collection without repeats, and the live sentiment series.

State lives in the state store of the query's checkpoint (RocksDB), one entry
per key. A cycle reads and writes the entries of its own keys only, so its cost
follows the rows that landed, not what was collected before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.dedupe import with_article_key
from ..plans.intraday import CARRIED_SHARE
from .collect import DEFAULT_INTERVAL, append_stream

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """Keys are kept in RocksDB, so state may outgrow an executor's memory. Holds for queries started later."""
    spark.conf.set(_PROVIDER, _ROCKS)


def _first(rows: pd.DataFrame, order: list[str]) -> pd.DataFrame:
    """The first row by ``order``; NULLs come last. One column of whole numbers is not sorted for it."""
    if len(rows) == 1:
        return rows
    if len(order) == 1 and rows[order[0]].dtype.kind == "i":
        at = int(rows[order[0]].to_numpy().argmin())
        return rows.iloc[at : at + 1]
    return rows.sort_values(order, kind="stable").head(1)


def first_of_each_key(
    stream: DataFrame, order: Sequence[str], key: str = "dedupe_key", time: str | None = None, forget_after: str | None = None
) -> DataFrame:
    """Rows whose key no earlier cycle had; of a cycle's rows of one key, the first by ``order``.

    Rows of a NULL key are taken as one key. With ``forget_after`` (such as
    ``30 days``) a key is forgotten once the latest ``time`` of all rows is so far
    ahead of the key's own; rows that come later than that are left out.
    """
    if (time is None) != (forget_after is None):
        raise ValueError("forgetting keys takes a time column and a duration")
    order, columns = list(order), stream.columns

    def pick(_, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        best, latest = None, state.get[0] if state.exists else -1
        # Parts are bounded batches, so a key may have any number of rows.
        for part in parts:
            if time is not None:
                latest = max(latest, int(part["_millis"].max()))
            if not state.exists:
                found = _first(part, order)
                best = found if best is None else _first(pd.concat([best, found]), order)
        state.update((latest,))
        if time is not None:
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + 1)
        if best is not None:
            yield best if best.columns.tolist() == columns else best[columns]

    timeout = GroupStateTimeout.NoTimeout
    rows = stream
    if time is not None:
        rows = stream.where(F.col(time).isNotNull()).withWatermark(time, forget_after).withColumn("_millis", F.unix_millis(time))
        timeout = GroupStateTimeout.EventTimeTimeout
    return rows.groupBy(key).applyInPandasWithState(pick, stream.schema, "latest long", "append", timeout)


def collect_new(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    order: Sequence[str],
    *,
    interval: str | None = DEFAULT_INTERVAL,
    time: str | None = None,
    forget_after: str | None = None,
) -> StreamingQuery:
    """Append articles no cycle of this checkpoint has seen; the first by ``order`` wins.

    What is stored is never read again, unlike in ``collect_once_each``, which
    also knows what other checkpoints stored. See ``first_of_each_key``.
    """
    keep_state_on_disk(stream.sparkSession)
    fresh = first_of_each_key(with_article_key(stream), order, time=time, forget_after=forget_after)
    return append_stream(fresh, path, checkpoint, interval=interval)


_SERIES = "timestamp timestamp, news_count long, sentiment_mean double, sentiment double, sentiment_influenced double"
_STATE = "windows array<long>, sums array<double>, counts array<long>, next long, carried double, smooth double"


class _Series:
    """One key's open windows, and what closed ones left behind."""

    def __init__(self, stored: tuple | None, weight: float):
        windows, sums, counts, self.next, self.carried, self.smooth = stored or ([], [], [], None, None, None)
        self.open = {w: (s, n) for w, s, n in zip(windows, sums, counts, strict=True)}
        self.weight = weight

    def stored(self) -> tuple:
        windows = sorted(self.open)
        return (
            windows,
            [self.open[w][0] for w in windows],
            [self.open[w][1] for w in windows],
            self.next,
            self.carried,
            self.smooth,
        )

    def add(self, windows: pd.Series, values: pd.Series) -> None:
        found = values.groupby(windows).agg(["sum", "size"])
        for window, total, count in zip(found.index.tolist(), found["sum"].tolist(), found["size"].tolist(), strict=True):
            if self.next is None or window >= self.next:  # a closed window stays as it is
                before = self.open.get(window, (0.0, 0))
                self.open[window] = (before[0] + total, before[1] + count)

    def close(self, until: int) -> list[tuple]:
        """Rows of all windows before ``until``, those without news included."""
        if self.next is None:
            # The series starts with the first window that has news.
            starts = [w for w in self.open if w < until]
            if not starts:
                return []
            self.next = min(starts)
        rows = []
        for window in range(self.next, until):
            total, count = self.open.pop(window, (0.0, 0))
            mean = total / count if count else None
            self.carried = self.carried if mean is None else mean
            if self.smooth is None:
                self.smooth = self.carried
            else:
                self.smooth = self.weight * self.smooth + (1.0 - self.weight) * self.carried
            rows.append((window, count, mean, self.carried, self.smooth))
        self.next = max(self.next, until)
        return rows


def live_sentiment_series(
    stream: DataFrame,
    *,
    keys: Sequence[str] = (),
    time: str = "timestamp",
    value: str = "sentiment_value",
    minutes: int = 15,
    delay: str = "10 minutes",
    previous_window_weight: float = CARRIED_SHARE,
) -> DataFrame:
    """The live form of ``sentiment_series``: every window of every key, as soon as it is closed.

    A window is closed once the watermark (``delay`` behind the latest time) has
    passed its end. A timer per key closes windows without news, too: they carry
    the last mean on, and the smoothed value goes on from where it stood. A key's
    series starts with its first window with news. Rows behind the watermark,
    without a time or without a value are left out; closed windows never change.
    """
    if not 0.0 <= previous_window_weight <= 1.0:
        raise ValueError("previous_window_weight lies outside 0..1")
    keys, step = list(keys), minutes * 60_000
    given = T.StructType([stream.schema[k] for k in keys])
    schema = T.StructType([*given.fields, *T._parse_datatype_string(_SERIES).fields])
    rows = (
        stream.withColumn("_value", F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double")))
        .where(F.col(time).isNotNull() & F.col("_value").isNotNull())
        .withWatermark(time, delay)
        .select(*keys, F.lit(0).alias("_all"), time, F.floor(F.unix_millis(time) / step).alias("_window"), "_value")
    )

    def advance(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        series = _Series(state.get if state.exists else None, previous_window_weight)
        if not state.hasTimedOut:
            for part in parts:
                series.add(part["_window"], part["_value"])
        mark = state.getCurrentWatermarkMs()
        found = series.close(math.floor(mark / step)) if mark > 0 else []
        state.update(series.stored())
        # The next window to close, with or without news.
        upcoming = series.next if series.next is not None else min(series.open)
        state.setTimeoutTimestamp(max((upcoming + 1) * step, mark + 1))
        if found:
            window, count, mean, carried, smooth = zip(*found, strict=True)
            yield pd.DataFrame(
                {
                    **{name: [k] * len(found) for name, k in zip(keys, key, strict=False)},
                    "timestamp": pd.to_datetime([w * step for w in window], unit="ms"),
                    "news_count": count,
                    "sentiment_mean": pd.Series(mean, dtype="float64"),
                    "sentiment": carried,
                    "sentiment_influenced": smooth,
                }
            )

    grouped = rows.groupBy(*(keys or ["_all"]))
    return grouped.applyInPandasWithState(advance, schema, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
