"""The stored daily series and stages with fingerprints."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from sparksignal.operators.scoring import lexicon_logits
from sparksignal.plans.daily import daily_sentiment
from sparksignal.plans.days import build_days, clear_mark, fingerprint, read_days, update_days
from sparksignal.plans.pipeline import daily_pipeline

NEWS = "published_at string, subindustria_id string, sentiment_value double"
TAXONOMY = "industria_id string, subindustria_id string, subindustria_nombre string"


def some_news(seed, days):
    rng = random.Random(seed)
    return [(f"2024-01-{d:02d}T{rng.randint(0, 23):02d}:00:00Z", rng.choice("abc"), rng.choice([1.0, 0.0, -1.0, 0.5])) for d in days for _ in range(2)]


@pytest.fixture(scope="module")
def taxonomy(spark):
    return spark.createDataFrame([("i", "a", "A"), ("i", "b", "B"), ("j", "c", "C"), ("j", "d", "D")], TAXONOMY)


def rows_of(df):
    return sorted(map(str, df.collect()))


def full(spark, news, taxonomy, end):
    return rows_of(daily_sentiment(spark.createDataFrame(news, NEWS), taxonomy, start_date="2024-01-01", end_date=end))


def test_days_added_and_corrected_equal_a_full_run(spark, taxonomy, tmp_path):
    path = str(tmp_path / "days")
    first = some_news(1, range(1, 11))
    build_days(spark.createDataFrame(first, NEWS), taxonomy, path, "2024-01-01", "2024-01-10", weight=1)
    assert rows_of(read_days(spark, path)) == full(spark, first, taxonomy, "2024-01-10")
    before = {p: p.stat().st_mtime_ns for p in pathlib.Path(path).glob("date=*/part*")}
    # One day in the middle has other news now: it and the days after it are written again.
    fixed = [n for n in first if not n[0].startswith("2024-01-06")] + some_news(7, [6]) + some_news(8, [6])
    update_days(spark.createDataFrame(fixed, NEWS), taxonomy, path, "2024-01-06", "2024-01-06", weight=1)
    assert rows_of(read_days(spark, path)) == full(spark, fixed, taxonomy, "2024-01-10")
    kept = {p for p, t in before.items() if p.exists() and p.stat().st_mtime_ns == t}
    assert {p.parent.name for p in kept} == {f"date=2024-01-{d:02d}" for d in range(1, 6)}
    # New days, the last of them without news.
    grown = fixed + some_news(9, [11, 12])
    update_days(spark.createDataFrame(grown, NEWS), taxonomy, path, "2024-01-11", "2024-01-12", "2024-01-14", weight=1)
    assert rows_of(read_days(spark, path)) == full(spark, grown, taxonomy, "2024-01-14")
    # A day that lost all its news.
    empty = [n for n in grown if not n[0].startswith("2024-01-01")]
    update_days(spark.createDataFrame(empty, NEWS), taxonomy, path, "2024-01-01", "2024-01-01", weight=1)
    assert rows_of(read_days(spark, path)) == full(spark, empty, taxonomy, "2024-01-14")


def test_days_that_do_not_fit_are_refused(spark, taxonomy, tmp_path):
    path = str(tmp_path / "days")
    news = spark.createDataFrame(some_news(1, range(1, 4)), NEWS)
    build_days(news, taxonomy, path, "2024-01-01", "2024-01-03", weight=1)
    for bad in ({"weight": 2}, {}):
        with pytest.raises(ValueError, match="other parameters"):
            update_days(news, taxonomy, path, "2024-01-03", "2024-01-03", **bad)
    with pytest.raises(ValueError, match="another taxonomy"):
        update_days(news, taxonomy.limit(2), path, "2024-01-03", "2024-01-03", weight=1)
    with pytest.raises(ValueError, match="missing"):
        update_days(news, taxonomy, path, "2024-01-06", "2024-01-06", weight=1)
    with pytest.raises(ValueError, match="in order"):
        update_days(news, taxonomy, path, "2024-01-03", "2024-01-02", weight=1)
    clear_mark(spark, path)
    with pytest.raises(ValueError, match="unfinished"):
        update_days(news, taxonomy, path, "2024-01-03", "2024-01-03", weight=1)


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, "a", {"x": 1}), (2, None, None), (2, None, None)], "i int, t string, m map<string,int>")
    same = fingerprint(df, weight=0.5)
    assert fingerprint(df.repartition(3), weight=0.5) == same
    others = [fingerprint(df, weight=0.6), fingerprint(df.dropDuplicates(["i"]), weight=0.5), fingerprint(df, weight=0.5, x=1)]
    others += [fingerprint(df.withColumn("t", F.lit("b")), weight=0.5), fingerprint(df.limit(0), weight=0.5), fingerprint("a", weight=0.5)]
    assert len({same, *others}) == 7


def test_changed_inputs_and_parameters_are_not_served_old_stages(spark, tmp_path):
    raw = [("2024-01-01", "10:00", "gain gain", "s"), ("2024-01-02", "10:00", "loss", "s")]
    schema = "day string, hour_minute string, title string, news_summary string"
    categories = spark.createDataFrame([("i", "x", "X", [1.0, 0.0]), ("i", "y", "Y", [0.6, 0.8])], TAXONOMY + ", embedding array<float>")
    encoded = spark.sparkContext.accumulator(0)

    def encode(df):
        @F.udf("array<float>")
        def vector(_):
            encoded.add(1)
            return [1.0, 0.0]

        return df.withColumn("embedding", vector("headline"))

    def run(rows, stages, threshold=0.9, version="1"):
        before = encoded.value
        out = daily_pipeline(
            spark.createDataFrame(rows, schema), categories, encode, logits=lexicon_logits(F.col("headline")), threshold=threshold,
            start_date="2024-01-01", end_date="2024-01-03", stage_dir=stages, resume=True, version=version,
        )
        return rows_of(out), encoded.value - before

    path = str(tmp_path / "stages")
    first, work = run(raw, path)
    assert work > 0
    assert run(raw, path) == (first, 0)
    more = [*raw, ("2024-01-03", "10:00", "profit", "s")]
    for k, change in enumerate(({"rows": more}, {"rows": raw, "threshold": 0.5}, {"rows": raw, "version": "2"})):
        fresh, _ = run(stages=str(tmp_path / f"fresh{k}"), **change)
        found, work = run(stages=path, **change)
        assert found == fresh and work > 0
