import csv
import io
import json
import zipfile

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sparksignal.operators import quality, scoring
from sparksignal.operators.dedupe import (
    article_key,
    dedupe_first_wins,
    dedupe_incremental,
    sequential_id,
    union_batches,
)
from sparksignal.operators.joins import attach_page_text, attach_url_text, enrich_articles, many_to_one, urls_without_text
from sparksignal.operators.scoring import (
    embed_text,
    hashing_encoder,
    join_vectors,
    lexicon_logits,
    lexicon_scorer,
    score_articles,
)
from sparksignal.plans.pipeline import daily_pipeline, prepare_news
from sparksignal.session import configure
from sparksignal.sources import news as news_source
from sparksignal.sources.bars import bars_to_long
from sparksignal.sources.filings import read_main_documents
from sparksignal.sources.news import (
    api_articles,
    event_records,
    feed_rows,
    file_manifest,
    ragged_headlines,
    read_api_json,
    read_event_lines,
    read_event_zips,
    read_feed_xml,
    read_news_csv,
    read_ragged_csv,
)
from sparksignal.sources.sinks import (
    append_table,
    publish,
    replace_table,
    write_csv,
    write_sorted_csv,
    write_stage,
    write_taxonomy_json,
)
from sparksignal.sources.taxonomy import flatten_raw_taxonomy, read_raw_taxonomy, read_taxonomy, taxonomy_entries
from sparksignal.streaming.collect import (
    append_stream,
    collect_once_each,
    dedupe_all,
    dedupe_within,
    landed_stream,
    live_interval_means,
)

NOW = "2024-03-01 12:00:00"


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_news_csv_keeps_quotes_and_line_breaks(spark, tmp_path):
    rows = [(1, 'say "hi"\nand, bye', "src"), (2, "None", None), (3, "back\\slash", "x")]
    df = spark.createDataFrame(rows, "id int, title string, source string")
    write_csv(df, str(tmp_path / "csv"))
    back = read_news_csv(spark, str(tmp_path / "csv"), "id int, title string, source string")
    assert sorted(tuples(back)) == rows
    assert read_news_csv(spark, str(tmp_path / "csv")).columns == ["id", "title", "source"]
    write_sorted_csv(df, str(tmp_path / "sorted"), ["id"])
    assert read_news_csv(spark, str(tmp_path / "sorted")).count() == 3


RECORDS = "\n".join(
    [
        "\t".join(["1", "20240131090500", "x", "s", "https://a.org/one", "", "", "", "", "", "Tesla;Ford", "t"]),
        "\t".join(["2", "bad", "x", "s", "https://a.org/two"]),
        "\t".join(["3", "20240131090500", "x", "s", "", "y"]),
        "short\tline",
        "",
    ]
)


def test_event_records(spark, tmp_path):
    (tmp_path / "a.csv").write_text(RECORDS)
    expected = [
        ("2024-01-31", "09:05", "https://a.org/one", "Tesla;Ford", "GDELT"),
        ("2024-03-02", "00:00", "https://a.org/two", "", "GDELT"),
    ]
    assert tuples(event_records(read_event_lines(spark, str(tmp_path / "a.csv")), NOW)) == expected
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("first.csv", RECORDS.encode() + b"\xff\xfe")
        archive.writestr("second.csv", "ignored")
    (tmp_path / "b.zip").write_bytes(packed.getvalue())
    lines = read_event_zips(spark, str(tmp_path / "b.zip"))
    assert tuples(event_records(lines, NOW)) == expected
    assert tuples(event_records(lines, NOW, keywords=["tesla"])) == expected[:1]


def test_manifest_includes_the_end_day(spark):
    name = "http://f.org/gdeltv2/{}.gkg.csv.zip"
    lines = [f"10 h {name.format(s)}" for s in ("20240102234500", "20240101000000", "20240103000000", "20231231234500")]
    lines += ["10 h http://f.org/20240101000000.export.CSV.zip", "bad", f"- h {name.format('20240102000000')}", f"1 h {name.format('latest')}"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows = file_manifest(df, "2024-01-01", "2024-01-02").orderBy("file_ts").collect()
    assert [str(r["file_ts"]) for r in rows] == ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-02 23:45:00"]
    assert [r["size_bytes"] for r in rows] == [10, None, 10]
    assert file_manifest(df, "2024-01-01", "2024-01-02", max_files=1).count() == 1


def test_feeds_and_apis(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        "<rss><channel><item><title> A &amp; B </title><description>d</description>"
        "<pubDate>Wed, 31 Jan 2024 09:05:00 GMT</pubDate></item>"
        "<item><title> </title></item><item><title>C</title><updated>2024-01-31</updated></item></channel></rss>"
    )
    rows = tuples(feed_rows(read_feed_xml(spark, str(tmp_path / "feed.xml"), "FT"), NOW))
    assert rows == [("2024-01-31", "09:05", "A & B", "d", "FT"), ("2024-02-01", "00:00", "C", "", "FT")]
    articles = [
        {"title": " T ", "description": None, "publishedAt": "2024-01-31T09:05:00Z", "source": {"id": None, "name": "N"}},
        {"title": None, "description": "x", "publishedAt": "2024-01-31T09:05:00Z", "source": {"name": "N"}},
        {"title": "U", "description": "x", "publishedAt": "", "source": {"id": "i"}},
        {"title": "V", "description": "x", "publishedAt": "2024-01-31", "source": None},
        {"title": "W", "description": "x", "publishedAt": "2024-01-31", "source": {"name": None}},
    ]
    (tmp_path / "api.json").write_text(json.dumps({"articles": articles}, indent=1))
    rows = tuples(api_articles(read_api_json(spark, str(tmp_path / "api.json")), NOW))
    assert rows == [
        ("2024-01-31", "09:05", "T", "", "N"),
        ("2024-03-02", "00:00", "U", "x", "NewsAPI"),
        ("2024-02-01", "00:00", "V", "x", "NewsAPI"),
        ("2024-02-01", "00:00", "W", "x", None),
    ]


def test_ragged_csv(spark, tmp_path):
    text = '1,two\n2,plain, WSJ \n3,"a, b",c ,d,WSJ\n4,"line\nbreak",ft\n5,,\n'
    (tmp_path / "r.csv").write_text(text)
    rows = tuples(ragged_headlines(read_ragged_csv(spark, str(tmp_path / "r.csv"))))
    assert rows == [
        ("2", "plain", "WSJ"),
        ("3", "a, b c d", "WSJ"),
        ("4", "line break", "ft"),
        ("5", "", ""),
    ]
    lines = tuples(ragged_headlines(read_ragged_csv(spark, str(tmp_path / "r.csv"), multi_line=False)))
    assert rows[0] in lines and rows[1] in lines


def test_ragged_csv_reaches_python_in_pieces(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(news_source, "PIECE_BYTES", 7)
    monkeypatch.setattr(news_source, "ROWS_BYTES", 500)
    texts = {
        "a.csv": '1,"línea\r\nuno, ""dos""\n\ntres",ft\n2,äöü€😀,b\r\n\n3,"open\nto the end',
        "b.csv": "",
        "c.csv": "".join(f'{i},"{chr(233) * (i % 40)}\n{i}",x\n' for i in range(200)),
        "d.csv": "1,two",
    }
    wanted = []
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
        wanted += csv.reader(io.StringIO(text, newline=""))
    rows = read_ragged_csv(spark, str(tmp_path))
    assert sorted(r["fields"] for r in rows.collect()) == sorted(wanted)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "substring(content" in plan


def test_python_workers_get_texts_in_batches_of_a_few_megabytes(spark):
    rows = configure(spark).range(0, 3000, 1, 1).select(F.repeat(F.lit("x"), 10_000).alias("html"))

    def size(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

    assert rows.mapInArrow(size, "bytes long").agg(F.max("bytes")).first()[0] < 10 * 1024 * 1024


def test_the_hashing_encoder_remembers_a_bounded_number_of_words(monkeypatch):
    text = " ".join(f"w{i % 70}" for i in range(500))
    plain = hashing_encoder(16)()([text, "w1 w2"])
    monkeypatch.setattr(scoring, "REMEMBERED_WORDS", 10)
    encode = hashing_encoder(16)()
    assert encode([text, "w1 w2"]).tolist() == plain.tolist()
    bucket = dict(zip(encode.__code__.co_freevars, encode.__closure__, strict=True))["bucket"].cell_contents
    buckets = dict(zip(bucket.__code__.co_freevars, bucket.__closure__, strict=True))["buckets"].cell_contents
    assert 0 < len(buckets) <= 10


def test_bars_wide_to_long(spark):
    wide = spark.createDataFrame([("2024-01-01", 1.0, 2.0)], "`Date` string, `A|Close` double, `B|Close` double")
    rows = bars_to_long(wide, ["A", "B", "Z"]).select("ticker", "close", "open").collect()
    assert [tuple(r) for r in rows] == [("A", 1.0, None), ("B", 2.0, None)]
    with pytest.raises(ValueError):
        bars_to_long(wide, ["Z"])


def test_main_documents(spark, tmp_path):
    for filing, name, size in [("f1", "R1.htm", 90), ("f1", "a.htm", 10), ("f1", "b.htm", 20), ("f2", "c.htm", 5), ("f2", "x.txt", 50)]:
        (tmp_path / filing).mkdir(exist_ok=True)
        (tmp_path / filing / name).write_text("h" * size)
    rows = read_main_documents(spark, str(tmp_path)).orderBy("filing").collect()
    assert [(r["filing"], r["path"].rsplit("/", 1)[1], len(r["html"])) for r in rows] == [("f1", "b.htm", 20), ("f2", "c.htm", 5)]


def test_taxonomies(spark, tmp_path):
    nested = {"industrias": [{"id": "i", "nombre": "I", "subindustrias": [{"id": "s", "nombre": "S"}]}, {"id": "j", "nombre": "J"}]}
    flat = {"categorias": [{"id": "s", "sector": "x", "categoria": "S"}, {"id": "t", "categoria": "T"}]}
    for name, document, expected in [
        ("n", nested, [("i", "s", "S")]),
        ("f", flat, [("sin_sector", "t", "T"), ("x", "s", "S")]),
    ]:
        (tmp_path / f"{name}.json").write_text(json.dumps(document))
        assert sorted(tuples(read_taxonomy(spark, str(tmp_path / f"{name}.json")))) == expected
    twice = {"categorias": [{"id": "s", "categoria": "S"}, {"id": "s", "categoria": "T"}]}
    (tmp_path / "twice.json").write_text(json.dumps(twice))
    with pytest.raises(PySparkException, match="repeats in the taxonomy"):
        read_taxonomy(spark, str(tmp_path / "twice.json")).collect()
    (tmp_path / "unnamed.json").write_text(json.dumps({"categorias": [{"id": "s"}]}))
    with pytest.raises(PySparkException, match="lacks its id"):
        read_taxonomy(spark, str(tmp_path / "unnamed.json")).collect()
    (tmp_path / "empty.json").write_text("{}")
    with pytest.raises(ValueError, match="no sub-industries"):
        read_taxonomy(spark, str(tmp_path / "empty.json"))


def test_raw_taxonomy(spark, tmp_path):
    raw = {
        "_note": {"x": {"description": "no"}},
        "Real Estate": {
            "_note": {"description": "no"},
            "text": "not an object",
            "Office Parks": {"description": "d", "keywords": ["a", "b"], "avoid_confusion_with": ["z"]},
            "Bare": {},
        },
    }
    (tmp_path / "raw.json").write_text(json.dumps(raw))
    flat = read_raw_taxonomy(spark, str(tmp_path / "raw.json"))
    rows = {r["id"]: r for r in flat.collect()}
    assert set(rows) == {"real_estate:office_parks", "real_estate:bare"}
    assert rows["real_estate:office_parks"]["keywords_count"] == 2
    assert rows["real_estate:bare"]["keywords"] == []
    assert rows["real_estate:bare"]["texto_para_embedding"].startswith("[Real Estate]\nBare")
    write_taxonomy_json(flat, str(tmp_path / "out"), "2024-01-01T00:00:00")
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    envelope = json.loads(text)
    assert envelope["version"] == "2.0" and envelope["total_categorias"] == 2
    again = taxonomy_entries(spark.createDataFrame([(text,)], "json string"))
    assert again.count() == 2
    report = quality.taxonomy_report(flatten_raw_taxonomy(spark.createDataFrame([(json.dumps(raw),)], "json string"))).first()
    assert (report["categories"], report["sectors"], report["keywords"], report["max_keywords"]) == (2, 1, 2, 2)


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "t")
    publish(spark.range(3), path)
    publish(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    with pytest.raises(Exception):
        publish(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    staged = write_stage(spark.range(4).withColumn("d", F.col("id") % 2), str(tmp_path / "s"), ["d"])
    assert staged.filter("d = 1").count() == 2


def test_tables_are_replaced_and_appended(spark):
    spark.sql("DROP TABLE IF EXISTS market_data_test")
    replace_table(spark.range(2), "market_data_test")
    append_table(spark.range(3), "market_data_test")
    assert spark.table("market_data_test").count() == 5
    spark.sql("DROP TABLE market_data_test")


def news(spark, rows):
    return spark.createDataFrame(rows, "n int, title string, source string")


def test_dedupe(spark):
    rows = [(1, "t", "a"), (2, "t", "a"), (3, "t", "b"), (4, None, "a"), (5, "a|b", "c"), (6, "a", "b|c")]
    kept = dedupe_first_wins(news(spark, rows), ["n"])
    assert sorted(r["n"] for r in kept.collect()) == [1, 3, 4, 5]
    assert kept.transform(lambda d: dedupe_first_wins(d, ["n"])).count() == 4
    fresh = dedupe_incremental(news(spark, [(7, "t", "a"), (8, "new", "a"), (9, "new", "a")]), kept, ["n"])
    assert [r["n"] for r in fresh.collect()] == [8]
    # A rewritten title does not bring the article back.
    rewritten = kept.withColumn("title", F.lit("other"))
    assert dedupe_incremental(news(spark, rows), rewritten, ["n"]).count() == 0
    key = news(spark, rows[:1]).select(article_key(F.col("title"), F.col("source")).alias("k")).first()["k"]
    assert key == __import__("hashlib").md5(b"t|a").hexdigest()


def test_sequential_ids(spark):
    df = spark.range(1000, numPartitions=7).select(F.xxhash64("id").alias("x"), "id")
    rows = sequential_id(df, ["x"], "n").orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(1000))
    assert [r["x"] for r in rows] == sorted(r["x"] for r in rows)
    assert sequential_id(df.limit(0), ["x"], "n").count() == 0
    assert union_batches(df, df, df).count() == 3000


def test_many_to_one(spark):
    left = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    right = spark.createDataFrame([(1, 0.5)], "k int, s double")
    assert sorted(tuples(many_to_one(left, right, ["k"]))) == [(1, "x", 0.5), (1, "y", 0.5), (2, "z", None)]
    with pytest.raises(PySparkException, match="many-to-one"):
        many_to_one(left, right.union(right), ["k"]).collect()


def test_text_attachment(spark):
    df = spark.createDataFrame([("https://a.org/x-y",), ("http://b.org/z-w",), ("plain",), (None,), ("http://c.org",)], "title string")
    texts = spark.createDataFrame([("https://a.org/x-y", "page"), ("http://b.org/z-w", "")], "url string, text string")
    rows = {r["title"]: (r["article_text"], r["article_text_source"]) for r in attach_page_text(df, texts).collect()}
    assert rows == {
        "https://a.org/x-y": ("page", "web"),
        "http://b.org/z-w": ("z w", "url"),
        "plain": ("", "none"),
        None: ("", "none"),
        "http://c.org": ("", "url"),
    }
    counts = urls_without_text(attach_url_text(df)).first()
    assert (counts["processed"], counts["failed"]) == (5, 1)


def test_enrichment(spark):
    pending = spark.createDataFrame([("http://a", "s", "GDELT"), ("http://b", "s", "GDELT")], "title string, news_summary string, source string")
    pages = spark.createDataFrame([("http://a", "Title", "x\n" * 400)], "url string, page_title string, page_body string")
    rows = sorted(tuples(enrich_articles(pending, pages)))
    assert rows[0] == ("Title", ("x " * 250), "GDELT|http://a")
    assert rows[1] == ("http://b", "s", "GDELT")


def test_scorers_agree(spark):
    rows = [(1, "A record gain, no loss"), (2, None), (3, "Recall and lawsuit; RECALL"), (1, "A record gain, no loss")]
    df = spark.createDataFrame(rows, "article_id long, headline string")
    batch = score_articles(df, lexicon_scorer()).orderBy("article_id").collect()
    native = score_articles(df, logits=lexicon_logits(F.col("headline"))).orderBy("article_id").collect()
    assert [tuple(r) for r in batch] == [tuple(r) for r in native]
    assert [r["sentiment"] for r in batch] == ["positive", "positive", "neutral", "negative"]
    with pytest.raises(ValueError):
        score_articles(df)


def test_articles_are_scored_in_place_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        scorer = lexicon_scorer()()

        def score(texts):
            calls.add(len(texts))
            return scorer(texts)

        return score

    rows = [(i, "gain" if i % 2 else "loss", [i]) for i in range(50)]
    df = spark.createDataFrame(rows, "article_id long, headline string, tags array<int>")
    scored = score_articles(df, factory, unique=True).collect()
    assert calls.value == len(scored) == 50
    assert all(r["tags"] == [r["article_id"]] for r in scored)
    assert {r["sentiment"] for r in scored if r["article_id"] % 2} == {"positive"}


def test_articles_without_a_vector_are_an_error(spark):
    df = spark.createDataFrame([(1,), (2,)], "article_id long")
    known = spark.createDataFrame([(1, [1.0]), (2, [2.0])], "article_id long, embedding array<double>")
    assert join_vectors(df, known, "article_id").count() == 2
    with pytest.raises(Exception, match="has no vector"):
        join_vectors(df, known.where("article_id = 1"), "article_id").collect()


def test_embedding_batches(spark):
    df = spark.createDataFrame([(i, "a b a" if i % 2 else None) for i in range(300)], "id long, text string")
    rows = embed_text(df, "text", hashing_encoder(8), batch_rows=7).collect()
    assert len(rows) == 300
    assert {sum(r["embedding"]) for r in rows if r["id"] % 2} == {3.0}
    assert {sum(r["embedding"]) for r in rows if not r["id"] % 2} == {0.0}


def test_prepared_news(spark):
    df = spark.createDataFrame(
        [("2024-01-31", "23:59", "b"), ("2024-01-01", "00:00", "a"), ("2024-02-01", "00:00", "late")],
        "day string, hour_minute string, title string",
    )
    rows = prepare_news(df, "2024-01-01", "2024-01-31").orderBy("article_id").collect()
    assert [(r["article_id"], r["headline"]) for r in rows] == [(0, "a."), (1, "b.")]
    with pytest.raises(ValueError):
        prepare_news(spark.range(1).select(F.lit("x").alias("title")))


def test_pipeline_stages_resume(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2024-01-01", "10:00", "gain gain", "s"), ("2024-01-02", "10:00", "loss", "s")],
        "day string, hour_minute string, title string, news_summary string",
    )
    categories = spark.createDataFrame(
        [("i", "x", "X", [1.0, 0.0]), ("i", "y", "Y", [0.0, 1.0])],
        "industria_id string, subindustria_id string, subindustria_nombre string, embedding array<float>",
    )

    def encode(df):
        return df.withColumn("embedding", F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")))

    def run(**options):
        out = daily_pipeline(
            raw,
            categories,
            encode,
            logits=lexicon_logits(F.col("headline")),
            start_date="2024-01-01",
            end_date="2024-01-03",
            **options,
        )
        return [(str(r["date"]), r["subindustria_id"], r["news_count"], r["sentiment"]) for r in out.collect()]

    lazy = run()
    assert len(lazy) == 6
    assert [row[2] for row in lazy] == [1, 0, 1, 0, 0, 0]
    assert lazy[0][3] > 0 and lazy[2][3] == pytest.approx(lazy[4][3]) and lazy[1][3] is None
    assert run(stage_dir=str(tmp_path)) == lazy
    assert run(stage_dir=str(tmp_path), resume=True) == lazy
    assert sorted(p.name for p in tmp_path.iterdir()) == ["classified", "extracted", "prepared", "scored"]


def test_exact_median_narrows_by_histogram(spark, monkeypatch):
    monkeypatch.setattr(quality, "EXACT_ROWS", 5)
    monkeypatch.setattr(quality, "HISTOGRAM_BINS", 8)
    values = [((i * 7919) % 1000) / 7.0 for i in range(1000)] + [3.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    assert quality.order_statistics(df, "v", [0, 400, 749, 1499]) == [ordered[i] for i in (0, 400, 749, 1499)]
    assert quality.exact_median(df, "v") == (ordered[749] + ordered[750]) / 2
    assert quality.exact_median(df.limit(0), "v") is None


def test_quality_reports(spark):
    df = spark.createDataFrame([("d", "h", "o"), (None, " ", "o"), ("d", None, "p")], "date string, headline string, outlet string")
    row = quality.dataset_profile(df).first()
    assert (row["date_nulls"], row["headline_nulls"], row["blank_headlines"], row["outlets"], row["total_rows"]) == (1, 1, 1, 2, 3)
    part = quality.dataset_profile(df, first=2).first()
    assert (part["profiled_rows"], part["total_rows"]) == (2, 3)
    with pytest.raises(ValueError, match="missing columns"):
        quality.dataset_profile(df.drop("outlet"))
    good = spark.createDataFrame([("i", "I", [("s", "S")])], "id string, nombre string, subindustrias array<struct<id:string,nombre:string>>")
    assert quality.require_valid_taxonomy(good) is good
    with pytest.raises(ValueError, match="repeated industry id"):
        quality.require_valid_taxonomy(good.union(good))
    watched, metrics = quality.observe_run(df, "run", named=F.col("date").isNotNull())
    watched.collect()
    assert metrics.get == {"total": 3, "named": 2}
    assert quality.run_counters(df.limit(0), named=F.col("date").isNotNull()).first()["named_pct"] == 0.0


def test_backfill_estimate(spark):
    files = [(f"2024-01-01 {h:02d}:00:00", f"u{h}", 100) for h in range(10)]
    manifest = spark.createDataFrame(files, "t string, url string, size_bytes long").select(F.col("t").cast("timestamp").alias("file_ts"), "url", "size_bytes")
    contents = spark.createDataFrame([(f"u{h}", x) for h in range(10) for x in ("Tesla", "other", " ")], "url string, value string")
    row = quality.backfill_estimate(manifest, contents, ["tesla"], sample_files=5).first()
    assert (row["files"], row["sampled_files"], row["total_rows"], row["matched_rows"]) == (10, 5, 10, 5)
    assert (row["match_rate"], row["estimated_rows"], row["estimated_output_bytes"], row["estimated_seconds"]) == (0.5, 10, 4000, 5.0)
    assert row["zip_bytes"] == 1000.0
    empty = quality.backfill_estimate(manifest.limit(0), contents).first()
    assert empty["files"] == 0 and empty["match_rate"] is None


def test_streams(spark, tmp_path):
    landed, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    schema = "n int, title string, source string, ts timestamp, v double"

    def land(rows):
        df = spark.createDataFrame(rows, "n int, title string, source string, ts string, v double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(landed)

    land([(1, "t", "a", "2024-01-01 10:00:00", 1.0), (2, "t", "a", "2024-01-01 10:05:00", 0.0)])

    def cycle():
        # ``log`` is looked up at each call.
        collect_once_each(landed_stream(spark, landed, schema), out, log, ["n"], interval=None).awaitTermination()
        return sorted(r["n"] for r in spark.read.parquet(out).collect())

    assert cycle() == [1]
    land([(3, "t", "a", "2024-01-01 12:00:00", 1.0), (4, "u", "a", "2024-01-01 12:01:00", 1.0)])
    assert cycle() == [1, 4]
    assert cycle() == [1, 4]
    # A new checkpoint reads everything again and adds nothing.
    log = str(tmp_path / "log2")
    assert cycle() == [1, 4]

    stream = landed_stream(spark, landed, schema, max_files=1)
    means = live_interval_means(stream, time="ts", value="v")
    append_stream(means, str(tmp_path / "m"), str(tmp_path / "ml"), interval=None).awaitTermination()
    rows = tuples(spark.read.parquet(str(tmp_path / "m")))
    assert [(str(t), n, v) for t, n, v in rows] == [("2024-01-01 10:00:00", 2, 0.5)]
    for name, deduped in [("w", dedupe_within(stream, "ts", "1 hour", ["title"])), ("a", dedupe_all(stream, ["title"]))]:
        append_stream(deduped, str(tmp_path / name), str(tmp_path / f"{name}l"), interval=None).awaitTermination()
        titles = sorted(r["title"] for r in spark.read.parquet(str(tmp_path / name)).collect())
        assert titles == ["t", "u"]


def test_hot_groups_stay_whole(spark):
    """One key holds most of the rows in every grouping step."""
    rows = spark.range(0, 30_000, numPartitions=8).select(
        F.col("id").cast("int").alias("n"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("title"),
        F.lit("s").alias("source"),
    )
    kept = dedupe_first_wins(rows, ["n"])
    assert kept.count() == 10_001
    assert kept.filter("title = 'hot'").first()["n"] == 1
    pages = spark.createDataFrame([("http://hot", "page")], "url string, text string")
    linked = rows.select(F.when(F.col("title") == "hot", "http://hot").otherwise(F.col("title")).alias("title"))
    counts = {r["article_text_source"]: r["count"] for r in attach_page_text(linked, pages).groupBy("article_text_source").count().collect()}
    assert counts == {"web": 20_000, "none": 10_000}
