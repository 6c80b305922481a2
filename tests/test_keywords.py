import random

import pytest
from pyspark.sql import functions as F

from sparksignal.operators.filters import FEW_KEYWORDS, keyword_filter, raw_keyword_filter
from sparksignal.operators.keywords import keyword_table, with_keywords


def plain(texts, words, trim):
    words = {w.strip().lower() if trim else w.lower() for w in words if w is not None}
    words -= {""} if trim else set()
    return [sorted(w for w in words if w in (t or "").lower()) for t in texts]


@pytest.mark.parametrize("trim", [True, False])
@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_all_keywords_of_a_text(spark, trim, block_bytes):
    rng = random.Random(5)
    words = ["".join(rng.choice("ab c") for _ in range(rng.randint(1, 6))) for _ in range(200)] + [" ", "", "É", "ABBA", None, "ab", "ab"]
    texts = ["".join(rng.choice("ab cé") for _ in range(rng.randint(0, 60))) for _ in range(100)] + [None, "", "abba É", "x" * 100_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])]
    df = spark.createDataFrame(rows, "i int, title string").withColumn("matched", F.lit("replaced"))
    table = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    found = with_keywords(df, F.col("title"), table, trim=trim, block_bytes=block_bytes).orderBy("i").collect()
    expected = plain(texts, words, trim)
    assert [r["matched"] for r in found] == [expected[0], *expected]


def test_no_keywords_and_no_rows(spark):
    df = spark.createDataFrame([("a",)], "title string")
    none = spark.createDataFrame([], "keyword string")
    assert with_keywords(df, F.col("title"), none).collect()[0]["matched"] == []
    assert with_keywords(df.limit(0), F.col("title"), ["a"]).collect() == []
    assert keyword_table(spark, ["A ", "a", " "]).collect()[0][0] == "a"


def test_filters_take_lists_of_any_length(spark):
    rows = [("Tesla up", None), ("x", "about Word77"), (None, None), ("word", "7")]
    df = spark.createDataFrame(rows, "title string, news_summary string")
    many = [f" word{i} " for i in range(FEW_KEYWORDS * 3)] + [" "]
    few = many[77:78]
    for words in (few, many, spark.createDataFrame([(w,) for w in many], "k string")):
        assert [r["title"] for r in keyword_filter(df, words).collect()] == ["x"]
    assert keyword_filter(df, many, match_summary=False).count() == 0
    lines = df.select(F.concat_ws(" ", "title", "news_summary").alias("value"))
    assert raw_keyword_filter(lines, many[:-1]).count() == 0  # the blanks around stay
    assert raw_keyword_filter(lines, [*many[:-1], ""]).count() == 4
    assert raw_keyword_filter(lines, []).count() == 4
    assert raw_keyword_filter(lines, spark.createDataFrame([], "k string")).count() == 0
