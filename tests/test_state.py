"""Streams with state per key against their batch forms."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparksignal.operators.dedupe import dedupe_incremental, first_by_key, with_article_key
from sparksignal.plans.intraday import sentiment_series
from sparksignal.streaming.collect import append_stream, landed_stream
from sparksignal.streaming.state import _first, collect_new, live_sentiment_series

NEWS = "id long, title string, source string"


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_second_cycle_reads_its_own_rows_only(spark, tmp_path):
    landed, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    first = [(i, f"t{i % 40}", "s") for i in range(100)] + [(200, None, "s"), (201, None, "s")]
    second = [(1000 + i, f"t{i}", "s") for i in range(35, 45)] + [(1, "t0", "s"), (300, "t0", "other")]
    progress = []
    for rows in (first, second, [(5000, "t0", "s")]):
        land(spark, landed, rows, NEWS)
        query = collect_new(landed_stream(spark, landed, NEWS), out, log, ["id"], interval=None)
        query.awaitTermination(120)
        progress.append([p for p in query.recentProgress if p["numInputRows"]][-1])
    stored = spark.read.parquet(out)
    keyed = [with_article_key(spark.createDataFrame(rows, NEWS)) for rows in (first, second)]
    expected = first_by_key(keyed[0], ["dedupe_key"], ["id"])
    expected = expected.unionByName(dedupe_incremental(keyed[1], expected.select("dedupe_key"), ["id"]).select(*expected.columns))
    assert sorted(map(tuple, stored.select(*expected.columns).collect())) == sorted(map(tuple, expected.collect()))
    # A cycle's cost: the rows that landed, and one state entry for each of their keys.
    assert [p["numInputRows"] for p in progress] == [102, 12, 1]
    state = [p["stateOperators"][0] for p in progress]
    assert [s["numRowsUpdated"] for s in state] == [41, 12, 1]
    assert [s["numRowsTotal"] for s in state] == [41, 47, 47]
    assert "RocksDB" in str(state[0]["customMetrics"]) or any("rocksdb" in k.lower() for k in state[0]["customMetrics"])
    plan = query._jsq.explainInternal(False)
    scans = [line for line in plan.splitlines() if "Scan" in line]
    assert "FlatMapGroupsInPandasWithState" in plan and scans and not any(out in line for line in scans)


def test_forgotten_keys_are_new_again(spark, tmp_path):
    landed, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = NEWS + ", at timestamp"
    for day, ids in ((1, (0, 1)), (2, (2,)), (20, (3,)), (21, (4, 5))):
        when = datetime.datetime(2026, 1, day)
        land(spark, landed, [(i, "t" if i != 3 else "other", "s", when) for i in ids], schema)
        stream = landed_stream(spark, landed, schema)
        collect_new(stream, out, log, ["id"], interval=None, time="at", forget_after="7 days").awaitTermination(120)
    # Day 20 is more than a week after the key was last seen.
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 3, 4]
    with pytest.raises(ValueError):
        collect_new(stream, out, log, ["id"], forget_after="7 days")


SCORED = "key string, timestamp timestamp, sentiment_value double"
START = datetime.datetime(2026, 1, 1, 10, 0)


def at(minutes):
    return START + datetime.timedelta(minutes=minutes)


def stream_series(spark, tmp_path, landings, **options):
    landed, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for rows in landings:
        land(spark, landed, rows, SCORED)
        series = live_sentiment_series(landed_stream(spark, landed, SCORED), **options)
        append_stream(series, out, log, interval=None).awaitTermination(120)
    return spark.read.parquet(out)


def test_live_series_equals_the_batch_series(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for minute in range(0, 3500, 7):
        key = rng.choice(["a", "a", "b", None]) if minute % 700 < 500 else "a"
        rows.append((key, at(minute + rng.random() * 5), rng.choice([1.0, 0.0, -1.0, 0.25])))
    rows += [("b", None, 1.0), ("b", at(1), None), ("b", at(1), float("nan"))]
    landings = [rows[:150] + rows[-3:], rows[150:151], rows[151:300], rows[300:-3]]
    found = stream_series(spark, tmp_path, landings, keys=["key"], previous_window_weight=0.5).collect()
    whole = spark.createDataFrame(rows[:-3], SCORED)
    expected = sentiment_series(whole, keys=["key"], previous_window_weight=0.5).collect()
    last = max(r["timestamp"] for r in found)
    expected = {(r["key"], r["timestamp"]): tuple(r)[2:] for r in expected if r["timestamp"] <= last and r["key"] is not None}
    live = {(r["key"], r["timestamp"]): tuple(r)[2:] for r in found if r["key"] is not None}
    assert len(found) == len({(r["key"], r["timestamp"]) for r in found})
    assert {k: pytest.approx(v) if None not in v else v for k, v in live.items() if k in expected} == expected
    # Beyond a key's last news its series goes on, empty, to the last closed window.
    tail = [v for k, v in live.items() if k not in expected]
    assert tail and all(v[0] == 0 and v[1] is None for v in tail)
    assert {k for k, _ in live} == {"a", "b"} and any(r["key"] is None for r in found)


def test_live_series_without_keys_and_with_late_rows(spark, tmp_path):
    landings = [
        [("x", at(0), 1.0), ("x", at(1), -1.0), ("x", at(32), 1.0)],
        [("x", at(80), 0.0)],
        [("x", at(2), 1.0), ("x", at(200), 1.0)],  # the first is late: its window is closed
    ]
    found = stream_series(spark, tmp_path, landings, delay="0 minutes").orderBy("timestamp").collect()
    # 13 closed windows: 10:00 to 13:00.
    assert [r["news_count"] for r in found] == [2, 0, 1, 0, 0, 1] + [0] * 7
    assert [r["sentiment"] for r in found[:6]] == [0.0, 0.0, 1.0, 1.0, 1.0, 0.0]
    assert [r["sentiment_influenced"] for r in found[:4]] == pytest.approx([0.0, 0.0, 0.2, 0.36])
    with pytest.raises(ValueError):
        live_sentiment_series(spark.createDataFrame([], SCORED), previous_window_weight=1.5)


def test_the_first_row_of_a_key_needs_no_sorting(monkeypatch):
    rows = pd.DataFrame({"id": [7, 3, 3, 9], "at": [2.0, None, 1.0, 0.5], "title": list("abcd")}, index=[4, 4, 0, 1])
    expected = {tuple(o): rows.sort_values(list(o), kind="stable").head(1)["title"].item() for o in (("id",), ("at",), ("id", "at"))}
    assert {o: _first(rows, list(o))["title"].item() for o in expected} == expected
    monkeypatch.setattr(pd.DataFrame, "sort_values", None)
    assert _first(rows, ["id"])["title"].item() == "b"
    assert _first(rows[1:2], ["at", "id"])["title"].item() == "b"
