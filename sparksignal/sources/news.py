"""Landed news: CSV tables, event records, feeds and API responses."""

from __future__ import annotations

import csv
import io
import itertools
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.common import collapse, rows_where, strip
from ..functions.dates import parse_stamp14, with_publication_day
from ..operators.filters import non_blank, raw_keyword_filter

NEWS_COLUMNS = ["day", "hour_minute", "title", "news_summary", "source"]
NEWS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in NEWS_COLUMNS])

# Positions in a tab-separated event record.
RECORD_DATE, RECORD_URL, RECORD_ORGANIZATIONS, RECORD_MIN_COLUMNS = 1, 4, 10, 5

# The file kind listed in a manifest, and the number of parts of a manifest line.
MANIFEST_SUFFIX, MANIFEST_PARTS = ".gkg.csv.zip", 3

RSS_SCHEMA = "title string, description string, summary string, pubDate string, published string, updated string"
ARTICLES_SCHEMA = (
    "articles array<struct<title:string,description:string,publishedAt:string,source:map<string,string>>>"
)


def read_news_csv(spark: SparkSession, path, schema: T.StructType | str | None = None) -> DataFrame:
    """Headed CSV with doubled quotes and line breaks inside fields.

    Without a schema the header gives the names and all columns are text. Fields
    may span lines, so a file is one task: land many files, or convert to Parquet.
    """
    reader = spark.read.options(header=True, multiLine=True, quote='"', escape='"')
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def event_records(
    lines: DataFrame,
    ingest_ts: Column | str,
    *,
    keywords: list[str] | None = None,
    line: str = "value",
    source_name: str = "GDELT",
) -> DataFrame:
    """News rows from tab-separated event records, one record per row.

    Rows with fewer than five columns or no URL are skipped. The URL stands in
    for the title and the organizations for the summary.
    """
    others = [c for c in lines.columns if c != line]

    def field(position: int) -> Column:
        return F.get("_cols", F.lit(position))

    def usable(cols: Column) -> Column:
        return (F.size(cols) >= RECORD_MIN_COLUMNS) & (F.get(cols, F.lit(RECORD_URL)) != "")

    cols = F.split(F.col(line), "\t", -1)
    rows = raw_keyword_filter(lines, keywords, line).select(*others, rows_where(cols, usable).alias("_cols"))
    return with_publication_day(rows, field(RECORD_DATE), ingest_ts, stamps=True).select(
        *others,
        "day",
        "hour_minute",
        field(RECORD_URL).alias("title"),
        F.coalesce(field(RECORD_ORGANIZATIONS), F.lit("")).alias("news_summary"),
        F.lit(source_name).alias("source"),
    )


def read_event_lines(spark: SparkSession, paths) -> DataFrame:
    """Unpacked event files, one record per row."""
    return spark.read.text(paths)


def read_event_zips(spark: SparkSession, paths) -> DataFrame:
    """Records of the first member of each landed zip file; undecodable bytes are ignored."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as archive:
                    with archive.open(archive.namelist()[0]) as member:
                        lines: list[str] = []
                        for raw in member:
                            lines.append(raw.decode("utf-8", errors="ignore").rstrip("\n"))
                            if len(lines) == 10_000:
                                yield pa.RecordBatch.from_pydict({"value": lines})
                                lines = []
                        if lines:
                            yield pa.RecordBatch.from_pydict({"value": lines})

    files = spark.read.format("binaryFile").load(paths).select("content")
    return files.mapInArrow(unpack, "value string")


def file_manifest(
    lines: DataFrame, start_date: str, end_date: str, *, max_files: int | None = None, line: str = "value"
) -> DataFrame:
    """Listed event files of the day range: file_ts, url, size_bytes.

    A line reads "size hash url". Both end days are included. Ordered by time
    when only the first ``max_files`` are wanted.
    """
    first = F.lit(start_date).cast("date").cast("timestamp")
    after = F.date_add(F.lit(end_date).cast("date"), 1).cast("timestamp")
    candidates = lines.filter(F.col(line).contains(MANIFEST_SUFFIX))
    entries = candidates.select(
        rows_where(
            F.split(strip(F.col(line)), " ", -1),
            lambda parts: (F.size(parts) >= MANIFEST_PARTS) & F.element_at(parts, -1).endswith(MANIFEST_SUFFIX),
        ).alias("_parts")
    ).select(F.element_at("_parts", -1).alias("url"), F.get("_parts", F.lit(0)).try_cast("bigint").alias("size_bytes"))
    stamp = F.substring(F.substring_index("url", "/", -1), 1, 14)
    in_range = rows_where(parse_stamp14(stamp), lambda at: (at >= first) & (at < after))
    kept = entries.select(in_range.alias("file_ts"), "url", "size_bytes")
    return kept.orderBy("file_ts", "url").limit(max_files) if max_files else kept


def feed_rows(entries: DataFrame, ingest_ts: Column | str) -> DataFrame:
    """News rows from feed entries with title, summary, published, updated and feed_name."""
    have = set(entries.columns)

    def text(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) if name in have else F.lit("")

    raw_date = F.when(text("published") != "", text("published")).otherwise(text("updated"))
    core = {"title", "summary", "published", "updated", "feed_name"}
    others = [c for c in entries.columns if c not in core]
    rows = entries.select(
        *others,
        raw_date.alias("_date"),
        strip(text("title")).alias("title"),
        strip(text("summary")).alias("news_summary"),
        F.col("feed_name").alias("source"),
    )
    return with_publication_day(non_blank(rows, "title"), F.col("_date"), ingest_ts).select(*others, *NEWS_COLUMNS)


def feed_entries(documents: DataFrame, xml: str = "xml", feed_name: str = "feed_name") -> DataFrame:
    """Entries of feed documents held as XML text, one document per row."""
    schema = f"channel struct<item:array<struct<{_struct_fields(RSS_SCHEMA)}>>>"
    others = [c for c in documents.columns if c not in (xml, feed_name)]
    items = documents.select(
        *others, F.col(feed_name).alias("feed_name"), F.from_xml(xml, schema).alias("_doc")
    ).select(*others, "feed_name", F.explode("_doc.channel.item").alias("_item"))
    return items.select(
        *others,
        "feed_name",
        F.col("_item.title").alias("title"),
        F.coalesce("_item.summary", "_item.description").alias("summary"),
        F.coalesce("_item.published", "_item.pubDate").alias("published"),
        F.col("_item.updated").alias("updated"),
    )


def _struct_fields(ddl: str) -> str:
    return ",".join(":".join(part.split()) for part in ddl.split(","))


def read_feed_xml(spark: SparkSession, path, feed_name: str) -> DataFrame:
    """Entries of landed RSS files of one feed."""
    items = spark.read.format("xml").option("rowTag", "item").schema(RSS_SCHEMA).load(path)
    return items.select(
        F.lit(feed_name).alias("feed_name"),
        "title",
        F.coalesce("summary", "description").alias("summary"),
        F.coalesce("published", "pubDate").alias("published"),
        "updated",
    )


def api_articles(responses: DataFrame, ingest_ts: Column | str, default_source: str = "NewsAPI") -> DataFrame:
    """News rows from API responses that hold an ``articles`` array.

    The source name defaults only if its key is absent.
    """
    others = [c for c in responses.columns if c != "articles"]
    articles = responses.select(*others, F.explode("articles").alias("_a"))
    empty = F.lit("")
    source = F.col("_a.source")
    name = F.when(
        source.isNull() | ~F.map_contains_key(source, "name"), F.lit(default_source)
    ).otherwise(F.try_element_at(source, F.lit("name")))
    rows = articles.select(
        *others,
        F.coalesce("_a.publishedAt", empty).alias("_date"),
        strip(F.coalesce("_a.title", empty)).alias("title"),
        strip(F.coalesce("_a.description", empty)).alias("news_summary"),
        name.alias("source"),
    )
    return with_publication_day(non_blank(rows, "title"), F.col("_date"), ingest_ts).select(*others, *NEWS_COLUMNS)


def parse_api_json(documents: DataFrame, json: str = "json") -> DataFrame:
    """API responses held as JSON text."""
    others = [c for c in documents.columns if c != json]
    return documents.select(*others, F.from_json(json, ARTICLES_SCHEMA)["articles"].alias("articles"))


def read_api_json(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(ARTICLES_SCHEMA).option("multiLine", True).json(path)


#: Bytes of a file that reach Python at once; of rows that leave it at once, and of what a field takes besides its text.
PIECE_BYTES, ROWS_BYTES, FIELD_BYTES = 1024 * 1024, 8 * 1024 * 1024, 64


class _Pieces(io.RawIOBase):
    """The pieces of a file as one stream."""

    def __init__(self, pieces: Iterator[bytes]):
        self._pieces, self._left = pieces, memoryview(b"")

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        while not self._left:
            piece = next(self._pieces, None)
            if piece is None:
                return 0
            self._left = memoryview(piece)
        size = min(len(buffer), len(self._left))
        buffer[:size], self._left = self._left[:size], self._left[size:]
        return size


def read_ragged_csv(spark: SparkSession, path, *, multi_line: bool = True) -> DataFrame:
    """Rows of a headerless CSV as the array ``fields``; rows may have any number of fields.

    With ``multi_line`` a quoted field may hold line breaks and a file is one
    task, read by Python piece by piece; without it every line is a row and files
    are split freely.
    """
    schema = "fields array<string>"

    def batch_of(rows: list[list[str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"fields": pa.array(rows, pa.list_(pa.string()))})

    def rows_of(lines) -> Iterator[pa.RecordBatch]:
        rows: list[list[str]] = []
        size = 0
        for row in csv.reader(lines):
            rows.append(row)
            size += FIELD_BYTES * (len(row) + 1) + sum(map(len, row))
            if size >= ROWS_BYTES:
                yield batch_of(rows)
                rows, size = [], 0
        if rows:
            yield batch_of(rows)

    def parse_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        number = 0

        def pieces() -> Iterator[tuple[int, bytes]]:
            nonlocal number
            for batch in batches:
                for at, piece in zip(batch.column("at"), batch.column("piece"), strict=True):
                    number += at.as_py() == 0
                    yield number, piece.as_py()

        for _, own in itertools.groupby(pieces(), key=lambda piece: piece[0]):
            raw = io.BufferedReader(_Pieces(piece for _, piece in own))
            yield from rows_of(io.TextIOWrapper(raw, encoding="utf-8", newline=""))

    if multi_line:
        files = spark.read.format("binaryFile").load(path).select("content")
        last = F.greatest(F.ceil(F.length("content") / PIECE_BYTES) - 1, F.lit(0)).cast("int")
        # The pieces of a file follow each other in its task.
        placed = files.select("content", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        piece = F.substring(F.col("content"), F.col("at") * PIECE_BYTES + 1, F.lit(PIECE_BYTES))
        return placed.select("at", piece.alias("piece")).mapInArrow(parse_files, schema)

    def parse_line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for batch in batches:
            yield batch_of([row for line in batch.column("value").to_pylist() for row in csv.reader([line])])

    return spark.read.text(path).mapInArrow(parse_line_batches, schema)


def ragged_headlines(rows: DataFrame, fields: str = "fields") -> DataFrame:
    """date, headline, outlet from ragged rows: first, everything between, last.

    Rows with fewer than three fields are dropped.
    """
    col = F.col(fields)
    return rows.filter(F.size(col) >= 3).select(
        strip(F.get(col, 0)).alias("date"),
        collapse(F.array_join(F.slice(col, F.lit(2), F.size(col) - 2), " ")).alias("headline"),
        strip(F.element_at(col, -1)).alias("outlet"),
    )
