"""Published versions, quarantined rows, counters of the writing job and pruned scans."""

import threading
import time

import pytest
from pyspark.errors import AnalysisException, PythonException
from pyspark.sql import functions as F

from sparksignal.operators.quality import backfill_estimate, land_by_file_time, observe_run, stream_counters, write_counted
from sparksignal.operators.quarantine import apply_model, score_with_quarantine
from sparksignal.operators.scoring import lexicon_scorer
from sparksignal.sources.versions import publish_version, published_versions, read_published
from sparksignal.streaming.collect import append_stream, landed_stream


def test_readers_see_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(AnalysisException):
        read_published(spark, path)
    rows = spark.range(100).repartition(4)
    publish_version(rows.withColumn("v", F.lit(0)), path)
    seen, faults, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                seen.append(tuple(read_published(spark, path).agg(F.count("*"), F.min("v"), F.max("v")).first()))
            except Exception as fault:  # the test names it
                faults.append(fault)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 11):
        publish_version(rows.withColumn("v", F.lit(v)), path, keep=3)
        time.sleep(0.05)
    stop.set()
    reader.join()
    assert not faults and seen
    assert all(n == 100 and low == high for n, low, high in seen)
    assert [v for _, v, _ in seen] == sorted(v for _, v, _ in seen)
    assert published_versions(spark, path) == [9, 10, 11]
    assert read_published(spark, path, version=9).first()["v"] == 8
    with pytest.raises(AnalysisException):
        read_published(spark, path, version=1)


def test_failed_and_unfinished_publications_change_nothing(spark, tmp_path):
    path = str(tmp_path / "table")
    publish_version(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        publish_version(spark.range(3).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), path)
    (tmp_path / "table" / "manifests" / f"{2:012d}").write_text("data/half")  # no line end: still being written
    assert read_published(spark, path).count() == 3
    # The number is taken, so the next publisher has the one after it.
    assert publish_version(spark.range(5), path) == 3
    assert read_published(spark, path).count() == 5
    with pytest.raises(ValueError):
        publish_version(spark.range(1), path, keep=0)


def fragile():
    calls = []

    def model(texts):
        calls.append(len(texts))
        if any("bad" in t for t in texts):
            raise ValueError("cannot read " + next(t for t in texts if "bad" in t))
        return [[float(len(t)), 1.0] for t in texts] if "odd" not in texts else [[1.0]]

    return model


def test_kept_and_quarantined_are_the_input(spark):
    rows = [(i, "bad" * (i % 7 == 0) + "x" * (i % 3), {"k": i}) for i in range(200)] + [(500, None, None), (500, None, None), (501, "odd", None)]
    df = spark.createDataFrame(rows, "i int, text string, m map<string,int>").repartition(3)
    scored = apply_model(df, "text", fragile, batch_rows=8)
    assert scored.counts == {"total": 203, "kept": 174, "quarantined": 29}
    kept = {r["i"]: r["result"] for r in scored.kept.collect()}
    # The odd one spoils its batch only: alone it is as the model wants it.
    assert kept == {i: [1.0] if t == "odd" else [float(len(t or "")), 1.0] for i, t, _ in rows if "bad" not in (t or "")}
    reasons = {r["i"]: r["reason"] for r in scored.quarantined.collect()}
    assert reasons == {i: f"ValueError: cannot read {t}" for i, t, _ in rows if "bad" in (t or "")}
    assert scored.kept.where("i = 500").count() == 2


def test_quarantine_of_nothing_and_of_everything(spark):
    df = spark.createDataFrame([], "text string")
    assert apply_model(df, "text", fragile).counts == {"total": 0, "kept": 0, "quarantined": 0}
    bad = spark.createDataFrame([("bad",)] * 5, "text string")
    assert apply_model(bad, "text", fragile).counts == {"total": 5, "kept": 0, "quarantined": 5}
    good = score_with_quarantine(spark.createDataFrame([("record profit",)], "text string"), "text", lexicon_scorer())
    assert good.kept.first()["sentiment"] == "positive"
    with pytest.raises(ValueError, match="rename"):
        apply_model(spark.createDataFrame([("a", 1)], "text string, reason int"), "text", fragile)

    def broken():
        raise OSError("no weights")

    with pytest.raises(PythonException, match="no weights"):
        apply_model(bad, "text", broken)


def test_counters_come_from_the_writing_job(spark, tmp_path):
    path, passes = str(tmp_path / "out"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passes.add(batch.num_rows)
            yield batch

    df = spark.range(50).mapInArrow(count, "id long")
    counters = write_counted(df, path, even=F.col("id") % 2 == 0, none=F.lit(None).cast("boolean"))
    assert counters.first().asDict() == {"total": 50, "even": 25, "none": 0, "even_pct": 50.0, "none_pct": 0.0}
    assert passes.value == 50 and spark.read.parquet(path).count() == 50
    assert "Scan parquet" not in counters._jdf.queryExecution().toString()
    empty = write_counted(spark.range(0), str(tmp_path / "empty"), even=F.col("id") % 2 == 0).first()
    assert tuple(empty) == (0, 0, 0.0)


def test_counters_of_a_stream(spark, tmp_path):
    landed, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    spark.range(30).write.parquet(landed)
    watched = landed_stream(spark, landed, "id long").observe("run", F.count(F.lit(1)).alias("total"), F.max("id").alias("top"))
    query = append_stream(watched, out, log, interval=None)
    query.awaitTermination(120)
    assert stream_counters(query, "run")[0] == {"total": 30, "top": 29}
    assert stream_counters(query, "other") == []
    assert observe_run(spark.range(1), "x")[1] is not None


def test_only_sampled_partitions_are_read(spark, tmp_path):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 900)
    files = spark.range(60).select(at.alias("file_ts"), F.concat(F.lit("u"), "id").alias("url"), F.lit(10).cast("long").alias("size_bytes"))
    contents = files.select("file_ts", "url", F.explode(F.array(F.lit("a keyword"), F.lit("b"), F.lit(" "))).alias("value"))
    stored = land_by_file_time(contents, str(tmp_path / "landed"))
    estimate = backfill_estimate(files, stored, ["keyword"], sample_files=6, partition="file_time")
    expected = backfill_estimate(files, contents.drop("file_ts"), ["keyword"], sample_files=6)
    assert estimate.collect() == expected.collect()
    plan = estimate._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan
    scans, todo = [], [estimate._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            todo.append(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            todo.append(node.plan())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
        if "file_time" in node.toString().split("\n")[0] and "Scan parquet" in node.nodeName():
            scans.append(node.metrics().apply("numPartitions").value())
    assert scans == [6]


def test_landed_partitions_do_not_grow_with_the_files(spark, tmp_path):
    path = tmp_path / "landed"
    # Times at even distances but for the first and the last, which lie decades away; one file has none.
    seconds = F.when(F.col("id") == 0, 0).when(F.col("id") == 1499, 4000000000).otherwise(1704067200 + F.col("id") * 900)
    files = spark.range(1500).select(
        F.timestamp_seconds(seconds).alias("file_ts"), F.concat(F.lit("u"), "id").alias("url"), F.lit(10).cast("long").alias("size_bytes")
    )
    lines = F.array(F.lit("a keyword"), F.lit("b"), F.concat(F.lit("c"), "url"))
    timeless = spark.createDataFrame([("u7", "never read")], "url string, value string").withColumn("file_ts", F.lit(None).cast("timestamp"))
    contents = files.select("file_ts", "url", F.explode(lines).alias("value"))
    stored = land_by_file_time(contents.unionByName(timeless), str(path))
    assert len(list(path.glob("file_time=*"))) <= 1026 and len(list(path.rglob("*.parquet"))) <= 1100
    assert stored.count() == 4501
    for asked in (1, 20):
        estimate = backfill_estimate(files, stored, ["keyword"], sample_files=asked, partition="file_time")
        assert estimate.collect() == backfill_estimate(files, contents.drop("file_ts"), ["keyword"], sample_files=asked).collect()


@pytest.mark.parametrize("partitions", [1, 2, 7])
def test_few_landed_partitions_hold_every_file(spark, tmp_path, partitions):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * F.col("id"))
    files = spark.range(40).select(at.alias("file_ts"), F.concat(F.lit("u"), "id").alias("url"), F.lit(10).cast("long").alias("size_bytes"))
    contents = files.select("file_ts", "url", F.explode(F.array_repeat(F.lit("a keyword"), 3)).alias("value"))
    # Records that came with another time than their file's do not count, wherever they are stored.
    strays = files.select(F.expr("file_ts + interval 1 second").alias("file_ts"), "url", F.lit("a stray").alias("value"))
    stored = land_by_file_time(contents.unionByName(strays), str(tmp_path / "landed"), partitions=partitions)
    assert len(list((tmp_path / "landed").glob("file_time=*"))) <= partitions + 1
    estimate = backfill_estimate(files, stored, ["keyword"], sample_files=9, partition="file_time")
    assert estimate.collect() == backfill_estimate(files, contents.drop("file_ts"), ["keyword"], sample_files=9).collect()
    none = land_by_file_time(contents.limit(0), str(tmp_path / "none"), partitions=partitions)
    assert backfill_estimate(files, none, sample_files=9, partition="file_time").first()["total_rows"] == 0
