"""Quality reports, estimates and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sentiment import sentiment_value
from ..operators.dedupe import with_article_key
from ..operators.joins import attach_url_text, urls_without_text
from ..operators.quality import (
    backfill_estimate,
    categories_per_sector,
    classification_quality,
    dataset_profile,
    industry_distribution,
    land_by_file_time,
    similarity_statistics,
    taxonomy_report,
    taxonomy_violations,
    write_counted,
)
from ..operators.quarantine import score_with_quarantine
from ..operators.scoring import NEGATIVE_WORDS, POSITIVE_WORDS, lexicon_scorer
from ..operators.similarity import threshold_join, top_k_join
from ..session import cut_lineage, work_path
from ..sources.news import file_manifest
from ..sources.taxonomy import flatten_raw_taxonomy
from ..streaming.collect import append_stream, collect_once_each, landed_stream, live_interval_means
from ..streaming.state import collect_new, keep_state_on_disk, live_sentiment_series
from .news import _RAW_TAXONOMY, _linked_news, raw_taxonomy
from .similarity import _PAIRS
from .tables import (
    EVENT_LABELS,
    SQL_GROUPS,
    SQL_VALUE,
    event_news,
    group_centers,
    nation_taxonomy,
    rounded,
    stamp,
    table,
    vectors,
)


def _mirror_scores(spark, sf):
    """Best score of every vector read backwards."""
    articles = vectors(spark, sf, "article_id").withColumn("embedding", F.reverse("embedding"))
    return top_k_join(articles, group_centers(spark, sf), 1, article_id="article_id", category_id="category_id")


def similarity_stats(spark, sf):
    stats = similarity_statistics(_mirror_scores(spark, sf))
    return stats.select("n", *[rounded(c).alias(c) for c in stats.columns if c != "n"])


def _classified(spark, sf):
    hits = threshold_join(
        vectors(spark, sf, "article_id"),
        group_centers(spark, sf),
        0.5,
        article_id="article_id",
        category_id="category_id",
    )
    return hits.select(
        F.concat_ws("-", "article_id", "category_id").alias("hit"),
        F.col("sector").alias("industria_id"),
        F.col("category_id").alias("subindustria_id"),
        "confidence_score",
    )


def classification_check(spark, sf):
    report = classification_quality(_classified(spark, sf), key="hit")
    numbers = ["mean_score", "min_score", "max_score", "std_score"]
    return report.select("sampled", *[rounded(c).alias(c) for c in numbers], "industries", "subindustries")


def classification_industries(spark, sf):
    return industry_distribution(_classified(spark, sf), key="hit")


def taxonomy_summary(spark, sf):
    report = taxonomy_report(flatten_raw_taxonomy(raw_taxonomy(spark, sf)))
    return report.withColumn("mean_keywords", rounded("mean_keywords"))


def taxonomy_sector_sizes(spark, sf):
    return categories_per_sector(flatten_raw_taxonomy(raw_taxonomy(spark, sf)))


def taxonomy_problems(spark, sf):
    """Suppliers as a taxonomy with repeated and missing names."""
    supplier = table(spark, sf, "supplier")
    subs = F.array(
        F.struct(
            F.col("s_nationkey").cast("string").alias("id"),
            F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("nombre"),
        )
    )
    industries = supplier.select(
        F.when(F.col("s_acctbal") > -500, F.concat(F.lit("s"), F.pmod("s_suppkey", F.lit(4)))).alias("id"),
        F.col("s_name").alias("nombre"),
        subs.alias("subindustrias"),
    )
    return taxonomy_violations(industries)


def headline_profile(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    news = docs.select(
        F.col("quality").cast("string").alias("date"),
        F.when(F.col("toxic") == 1, " ").otherwise(F.col("text")).alias("headline"),
        F.col("source").alias("outlet"),
    )
    profile = dataset_profile(news)
    numbers = ["date_null_pct", "headline_null_pct", "outlet_null_pct", "mean_headline_length"]
    return profile.withColumns({c: rounded(c) for c in numbers})


def collection_counters(spark, sf):
    """Counted by the job that stores the rows."""
    news = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    toxic = F.coalesce(F.col("toxic"), F.lit(0)) == 1
    counters = write_counted(news, work_path(spark, "collected"), labelled=F.col("quality").isNotNull(), toxic=toxic)
    return counters.withColumns({c: rounded(c) for c in ("labelled_pct", "toxic_pct")})


def extraction_counters(spark, sf):
    return urls_without_text(attach_url_text(_linked_news(spark, sf)))


def _page_files(spark, sf):
    """Pages as listed files, their records cut at paragraph ends."""
    pages = table(spark, sf, "pages").withColumn("file_ts", F.timestamp_seconds(F.lit(1704067200) + F.col("page_id") * 900))
    url = F.concat(F.lit("http://files.example.org/"), F.date_format("file_ts", "yyyyMMddHHmmss"), F.lit(".gkg.csv.zip"))
    lines = pages.select(F.concat(F.length("html"), F.lit(" h "), url).alias("value"))
    contents = pages.select("file_ts", url.alias("url"), F.explode(F.split("html", "</p>")).alias("value"))
    return file_manifest(lines, "2024-01-01", "2024-12-31"), contents


def _estimate(manifest, contents, **options):
    estimate = backfill_estimate(manifest, contents, ["nicht", "the and"], sample_files=20, **options)
    numbers = ["match_rate", "listed_bytes", "zip_bytes", "text_bytes", "estimated_seconds"]
    return estimate.withColumns({c: rounded(F.col(c).cast("double")) for c in numbers})


def backfill_volume(spark, sf):
    manifest, contents = _page_files(spark, sf)
    return _estimate(manifest, contents.drop("file_ts"))


def backfill_volume_by_time(spark, sf):
    """The same from records that are stored by file time: only the sampled files' partitions are read."""
    manifest, contents = _page_files(spark, sf)
    return _estimate(manifest, land_by_file_time(contents, work_path(spark, "landed")), partition="file_time")


def quarantined_scores(spark, sf):
    """Sentiment of whole documents by a scorer that fails on some of them; what it fails on is kept apart with the reason."""

    def factory():
        score = lexicon_scorer()()

        def checked(texts):
            for text in texts:
                if "@" in text or len(text) > 9000:
                    raise ValueError("mail address" if "@" in text else "too long")
            return score(texts)

        return checked

    docs = table(spark, sf, "documents").select("doc_id", "text")
    scored = score_with_quarantine(docs, "text", factory)
    total = F.lit(scored.counts["total"] - scored.counts["kept"] - scored.counts["quarantined"]).alias("lost")
    kept = scored.kept.select("doc_id", F.lit(None).cast("string").alias("reason"), "sentiment", total)
    return kept.unionByName(scored.quarantined.select("doc_id", "reason", F.lit(None).cast("string").alias("sentiment"), total))


def _event_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    stream = landed_stream(spark, sf, schema, name_filter="events.parquet")
    labels = F.create_map(*[F.lit(x) for pair in EVENT_LABELS.items() for x in pair])
    values = F.create_map(*[F.lit(x) for p in (("positive", 1.0), ("neutral", 0.0), ("negative", -1.0)) for x in p])
    return stream.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("u"), F.col("user_id")).alias("title"),
        F.col("event_type").alias("source"),
        F.try_element_at(values, F.try_element_at(labels, F.col("event_type"))).alias("sentiment_value"),
    )


def live_15m_means(spark, sf):
    """The streamed form of the 15-minute means; only closed windows are stored."""
    out, log = work_path(spark, "live-means"), work_path(spark, "live-log")
    append_stream(live_interval_means(_event_stream(spark, sf)), out, log, interval=None).awaitTermination()
    return spark.read.parquet(out).select(
        stamp("timestamp").alias("timestamp"), "news_count", rounded("sentiment_mean").alias("sentiment_mean")
    )


def live_collection(spark, sf):
    """Collected twice from one folder; the second cycle finds nothing new."""
    out, log = work_path(spark, "live-news"), work_path(spark, "live-log")
    stream = with_article_key(_event_stream(spark, sf).drop("sentiment_value"))
    for _ in range(2):
        collect_once_each(stream, out, log, ["event_id"], interval=None).awaitTermination()
    return spark.read.parquet(out).select("event_id", "title", "source", "dedupe_key")


def keyed_collection(spark, sf):
    """Two landings, the second with all of the first again: only its new articles are stored."""
    landed = work_path(spark, "landed-news")
    out, log = work_path(spark, "live-news"), work_path(spark, "live-log")
    events = table(spark, sf, "events").select(
        "event_id", F.concat(F.lit("u"), F.col("user_id")).alias("title"), F.col("event_type").alias("source")
    )
    for part in (F.col("source") != "error", F.lit(True)):
        events.where(part).write.mode("append").parquet(landed)
        stream = landed_stream(spark, landed, events.schema)
        collect_new(stream, out, log, ["event_id"], interval=None).awaitTermination()
    return spark.read.parquet(out).select("event_id", "title", "source", "dedupe_key")


def live_sentiment_by_industry(spark, sf):
    """The streamed form of the smoothed series per industry, from three landings that follow each other in time."""
    landed = work_path(spark, "landed-news")
    out, log = work_path(spark, "live-series"), work_path(spark, "live-log")
    news = event_news(spark, sf).join(nation_taxonomy(spark, sf), "subindustria_id")
    rows = cut_lineage(
        news.select(
            "industria_id", F.col("published_at").cast("timestamp").alias("timestamp"), sentiment_value(news).alias("sentiment_value")
        )
    )
    keep_state_on_disk(spark)
    for first, end in (("2000-01-01", "2024-01-11"), ("2024-01-11", "2024-01-20"), ("2024-01-20", "2100-01-01")):
        rows.where(F.col("timestamp").between(first, end) & (F.col("timestamp") < end)).write.mode("append").parquet(landed)
        stream = landed_stream(spark, landed, rows.schema)
        series = live_sentiment_series(stream, keys=["industria_id"], previous_window_weight=0.5)
        append_stream(series, out, log, interval=None).awaitTermination()
    return spark.read.parquet(out).select(
        "industria_id",
        stamp("timestamp").alias("timestamp"),
        "news_count",
        rounded("sentiment").alias("sentiment"),
        rounded("sentiment_influenced").alias("sentiment_influenced"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        similarity_stats,
        classification_check,
        classification_industries,
        taxonomy_summary,
        taxonomy_sector_sizes,
        taxonomy_problems,
        headline_profile,
        collection_counters,
        extraction_counters,
        backfill_volume,
        backfill_volume_by_time,
        quarantined_scores,
        live_15m_means,
        live_collection,
        keyed_collection,
        live_sentiment_by_industry,
    )
}

_SAMPLE = f"""
{_PAIRS}, hits AS (
  SELECT article_id || '-' || category_id AS hit, sector, category_id, s FROM pairs WHERE s >= 0.5
  ORDER BY md5(article_id || '-' || category_id || '|42'), hit LIMIT 100)
"""

ORACLES = {
    "similarity_stats": f"""
WITH vecs AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings), {SQL_GROUPS},
best AS (SELECT a.id, max(1 - pow(list_distance(list_reverse(a.v), b.v), 2) / 2) AS s FROM vecs a, cats b GROUP BY 1)
SELECT count(*) AS n, round(min(s), 6) AS min_score, round(max(s), 6) AS max_score, round(avg(s), 6) AS mean_score,
       round(median(s), 6) AS median_score, round(stddev_pop(s), 6) AS std_score FROM best""",
    "classification_check": f"""
WITH {_SAMPLE}
SELECT count(*) AS sampled, round(avg(s), 6) AS mean_score, round(min(s), 6) AS min_score,
       round(max(s), 6) AS max_score, round(stddev_samp(s), 6) AS std_score, count(DISTINCT sector) AS industries,
       count(DISTINCT category_id) AS subindustries FROM hits""",
    "classification_industries": f"""
WITH {_SAMPLE} SELECT sector AS industria_id, count(*) AS rows FROM hits GROUP BY 1""",
    "taxonomy_summary": f"""
WITH {_RAW_TAXONOMY}
SELECT count(*) AS categories, count(DISTINCT sector) AS sectors, CAST(sum(keywords_count) AS BIGINT) AS keywords,
       round(avg(keywords_count), 6) AS mean_keywords, min(keywords_count) AS min_keywords,
       max(keywords_count) AS max_keywords FROM flat""",
    "taxonomy_sector_sizes": f"""
WITH {_RAW_TAXONOMY} SELECT sector, count(*) AS categories FROM flat GROUP BY 1""",
    "taxonomy_problems": """
WITH s AS (
  SELECT CASE WHEN s_acctbal > -500 THEN 's' || (s_suppkey % 4) END AS id, s_name AS nombre,
         CAST(s_nationkey AS VARCHAR) AS sub_id, CASE WHEN s_acctbal > 0 THEN s_name END AS sub_name FROM supplier)
SELECT 'industry without id or name' AS "check", coalesce(id, nombre) AS item FROM s WHERE id IS NULL OR nombre IS NULL
UNION ALL SELECT 'sub-industry without id or name', coalesce(sub_id, sub_name) FROM s WHERE sub_name IS NULL
UNION ALL SELECT 'repeated industry id', id FROM s WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'repeated sub-industry id', sub_id FROM s GROUP BY sub_id HAVING count(*) > 1""",
    "headline_profile": r"""
WITH n AS (
  SELECT quality, CASE WHEN toxic = 1 THEN ' ' ELSE text END AS headline, source
  FROM documents LEFT JOIN labels USING (doc_id))
SELECT count(*) AS profiled_rows, count(*) FILTER (quality IS NULL) AS date_nulls,
       round(avg(CASE WHEN quality IS NULL THEN 100.0::DOUBLE ELSE 0 END), 6) AS date_null_pct,
       0::BIGINT AS headline_nulls, 0.0::DOUBLE AS headline_null_pct, 0::BIGINT AS outlet_nulls,
       0.0::DOUBLE AS outlet_null_pct, count(*) FILTER (NOT regexp_matches(headline, '\S')) AS blank_headlines,
       round(avg(length(headline)), 6) AS mean_headline_length, count(DISTINCT source) AS outlets,
       count(*) AS total_rows FROM n""",
    "collection_counters": """
SELECT count(*) AS total, count(quality) AS labelled, count(*) FILTER (toxic = 1) AS toxic,
       round(100.0::DOUBLE * count(quality) / count(*), 6) AS labelled_pct,
       round(100.0::DOUBLE * count(*) FILTER (toxic = 1) / count(*), 6) AS toxic_pct
FROM documents LEFT JOIN labels USING (doc_id)""",
    "extraction_counters": "SELECT count(*) AS processed, 0::BIGINT AS failed FROM documents",
    "backfill_volume": r"""
WITH files AS (SELECT page_id, html, length(html) AS size, row_number() OVER (ORDER BY page_id) - 1 AS i,
                      count(*) OVER () AS files FROM pages),
sample AS (SELECT * FROM files WHERE i % greatest(1, files // 20) = 0 AND i < greatest(1, files // 20) * 20),
records AS (SELECT unnest(string_split(html, '</p>')) AS line FROM sample),
c AS (SELECT count(*) AS total_rows,
             count(*) FILTER (contains(lower(line), 'nicht') OR contains(lower(line), 'the and')) AS matched_rows,
             sum(strlen(line) + 1) AS bytes FROM records WHERE regexp_matches(line, '\S')),
s AS (SELECT count(*) AS n, sum(size) AS zip, any_value(files) AS files FROM sample),
l AS (SELECT avg(size) * count(*) AS listed FROM files WHERE size > 0),
e AS (SELECT *, CAST(floor(total_rows::DOUBLE / n * files * (matched_rows::DOUBLE / total_rows)) AS BIGINT) AS est FROM c, s, l)
SELECT files, n AS sampled_files, total_rows, matched_rows, round(matched_rows::DOUBLE / total_rows, 6) AS match_rate,
       round(listed::DOUBLE, 6) AS listed_bytes, round(zip::DOUBLE / n * files, 6) AS zip_bytes,
       round(bytes::DOUBLE / n * files, 6) AS text_bytes, est AS estimated_rows, est * 400 AS estimated_output_bytes,
       round(files * 0.5::DOUBLE, 6) AS estimated_seconds FROM e""",
    "quarantined_scores": f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, lower(coalesce(text, '')) AS low FROM documents),
n AS (SELECT *, len(regexp_extract_all(low, '\\b(?:{"|".join(POSITIVE_WORDS)})\\b')) AS p,
             len(regexp_extract_all(low, '\\b(?:{"|".join(NEGATIVE_WORDS)})\\b')) AS q FROM docs)
SELECT doc_id, CASE WHEN contains(t, '@') THEN 'ValueError: mail address' WHEN length(t) > 9000 THEN 'ValueError: too long' END AS reason,
       CASE WHEN contains(t, '@') OR length(t) > 9000 THEN NULL WHEN p >= q AND p >= 1 THEN 'positive' WHEN q >= 1 THEN 'negative'
            ELSE 'neutral' END AS sentiment,
       0 AS lost FROM n""",
    "live_15m_means": f"""
WITH news AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS w, {SQL_VALUE} AS v FROM events),
closed AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE AS mark FROM events)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp, count(*) AS news_count, round(avg(v), 6) AS sentiment_mean
FROM news, closed WHERE w + INTERVAL 15 MINUTE <= mark GROUP BY w""",
    "live_collection": """
SELECT min(event_id) AS event_id, 'u' || user_id AS title, event_type AS source,
       md5('u' || user_id || '|' || event_type) AS dedupe_key
FROM events GROUP BY user_id, event_type""",
    "keyed_collection": """
SELECT min(event_id) AS event_id, 'u' || user_id AS title, event_type AS source,
       md5('u' || user_id || '|' || event_type) AS dedupe_key
FROM events GROUP BY user_id, event_type""",
    "live_sentiment_by_industry": f"""
WITH news AS (
  SELECT r_name AS k, time_bucket(INTERVAL 15 MINUTE, ts) AS w, {SQL_VALUE} AS v
  FROM events JOIN nation ON user_id % 25 = n_nationkey JOIN region ON n_regionkey = r_regionkey),
closed AS (SELECT time_bucket(INTERVAL 15 MINUTE, date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTE) AS mark FROM events),
agg AS (SELECT k, w, count(*) AS n, avg(v) AS m FROM news, closed WHERE w < mark GROUP BY 1, 2),
grid AS (SELECT k, unnest(generate_series(min(w), any_value(mark) - INTERVAL 15 MINUTE, INTERVAL 15 MINUTE)) AS w
         FROM agg, closed GROUP BY 1),
filled AS (SELECT k, w, coalesce(n, 0) AS n,
                  last_value(m IGNORE NULLS) OVER (PARTITION BY k ORDER BY w) AS s,
                  row_number() OVER (PARTITION BY k ORDER BY w) AS i
           FROM grid LEFT JOIN agg USING (k, w)),
series AS (SELECT k, list(s ORDER BY w) AS xs FROM filled GROUP BY 1)
SELECT k AS industria_id, strftime(w, '%Y-%m-%d %H:%M:%S') AS timestamp, n AS news_count, round(s, 6) AS sentiment,
       round(list_reduce(xs[1:i], lambda a, x: 0.5::DOUBLE * a + 0.5::DOUBLE * x), 6) + 0.0 AS sentiment_influenced
FROM filled JOIN series USING (k)""",
}
ORACLES["backfill_volume_by_time"] = ORACLES["backfill_volume"]
