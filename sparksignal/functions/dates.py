"""Publication dates and time buckets. Every timestamp is UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fail_if, strip

# RFC 822 zone names and their offsets in hours. Other names are ignored.
ZONE_OFFSETS = {
    "GMT": 0,
    "UTC": 0,
    "UT": 0,
    "Z": 0,
    "EST": -5,
    "EDT": -4,
    "CST": -6,
    "CDT": -5,
    "MST": -7,
    "MDT": -6,
    "PST": -8,
    "PDT": -7,
}

# Month names by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

_MONTH = r"(?i)(?<![a-z])(" + "|".join(MONTHS) + r")[a-z]*\.?"
_TIME = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*(?:([AaPp])\.?[Mm]\b\.?)?"
_ZONE = r"\d\s*(?:[A-Za-z]{1,5}\s*)?([+-])(\d{2}):?(\d{2})\b"
_ZONE_NAME = r"(?:\d|[AaPp]\.?[Mm]\.?)\s*\(?(" + "|".join(ZONE_OFFSETS) + r")\b"
#: Two-digit years from here on belong to the last century.
_LAST_CENTURY = 69


def date_parts(text: Column) -> Column:
    """Year, month, day, time of day and zone offset of a date text, as texts and numbers in one struct.

    The time is what looks like ``h:mm``, the zone what follows it. A month name
    is taken from anywhere; with one, the remaining numbers are day and year.
    Without one, a date is year first, month first, or in bare digits.
    """
    return _once(strip(text), lambda bare: _once(F.regexp_extract(bare, _TIME, 0), lambda time: _parts(bare, time)))


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _parts(bare: Column, time: Column) -> Column:
    # What stands before the time, and after it without zone and white space.
    at = F.when(time != "", F.instr(bare, time)).otherwise(F.length(bare) + 1)
    before = F.substring(bare, F.lit(1), at - 1)
    after = F.substring(bare, at + F.length(time), F.length(bare))
    zone = F.substring(bare, at, F.length(bare))
    rest = F.concat_ws(" ", before, F.regexp_replace(after, r"[+-]\d{2}:?\d{2}\b|\(.*\)", " "))
    fields = F.split(F.regexp_replace(time, _TIME, "$1:$2:$3:$4"), ":")
    # The last five characters are the sign, hours and minutes.
    offset = F.replace(F.regexp_extract(zone, _ZONE, 0), F.lit(":"), F.lit(""))

    def struct(rest: Column, fields: Column, offset: Column) -> Column:
        return F.struct(
            F.regexp_extract(rest, _MONTH, 1).alias("month"),
            F.regexp_extract_all(F.regexp_replace(rest, r"\.\d+$", ""), F.lit(r"\d+"), F.lit(0)).alias("numbers"),
            *[F.coalesce(F.get(fields, k), F.lit("")).alias(name) for k, name in enumerate(("hour", "minute", "second"))],
            F.lower(F.coalesce(F.get(fields, 3), F.lit(""))).alias("half"),
            F.substring(offset, F.lit(-5), F.lit(1)).alias("sign"),
            F.substring(offset, F.lit(-4), F.lit(2)).alias("zone_hours"),
            F.substring(offset, F.lit(-2), F.lit(2)).alias("zone_minutes"),
            F.regexp_extract(zone, _ZONE_NAME, 1).alias("zone_name"),
        )

    return _once(rest, lambda r: _once(fields, lambda f: _once(offset, lambda o: struct(r, f, o))))


def compose_date(parts: Column) -> Column:
    """Timestamp in UTC from ``date_parts``; NULL where they make no date."""

    def number(text: Column) -> Column:
        return F.try_to_number(text, F.lit("99999999999999")).cast("int")

    def at(k: int) -> Column:
        return F.get(parts["numbers"], k)

    named = parts["month"] != ""
    first, size = at(0), F.size(parts["numbers"])
    year_first = F.length(first) == 4
    # Bare digits: yyyyMMdd, with or without HHmm and ss.
    digits = F.when((size >= 1) & F.length(first).isin(8, 12, 14) & ~named, first)
    month_name = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(parts["month"])).cast("int")
    # Month before day, unless the first number can be no month.
    swapped = number(at(0)) > 12
    year_text = (
        F.when(digits.isNotNull(), F.substring(digits, 1, 4))
        .when(named, F.when(year_first, first).otherwise(at(1)))
        .when(year_first, first)
        .otherwise(at(2))
    )
    month = (
        F.when(digits.isNotNull(), number(F.substring(digits, 5, 2)))
        .when(named, month_name)
        .when(year_first, number(at(1)))
        .otherwise(F.when(swapped, number(at(1))).otherwise(number(at(0))))
    )
    day = (
        F.when(digits.isNotNull(), number(F.substring(digits, 7, 2)))
        .when(named, F.when(year_first, number(at(1))).otherwise(number(first)))
        .when(year_first, number(at(2)))
        .otherwise(F.when(swapped, number(at(0))).otherwise(number(at(1))))
    )
    short = number(year_text)
    year = (
        F.when(F.length(year_text) == 4, short)
        .when(F.length(year_text) == 2, short + F.when(short < _LAST_CENTURY, 2000).otherwise(1900))
    )
    hour12 = F.pmod(number(parts["hour"]), F.lit(12)) + F.when(parts["half"] == "p", 12).otherwise(0)
    hour = F.when(parts["half"] != "", hour12).otherwise(number(parts["hour"]))
    # Times of day in bare digits follow the date's eight.
    hour = F.coalesce(hour, number(F.substring(digits, 9, 2)), F.lit(0))
    minute = F.coalesce(number(parts["minute"]), number(F.substring(digits, 11, 2)), F.lit(0))
    second = F.coalesce(number(parts["second"]), number(F.substring(digits, 13, 2)), F.lit(0))
    local = F.try_make_timestamp(year, month, day, hour, minute, second, F.lit("UTC"))
    offset = number(parts["zone_hours"]) * 60 + number(parts["zone_minutes"])
    names = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    named_offset = F.try_element_at(names, parts["zone_name"]) * 60
    signed = F.when(parts["sign"] != "", offset * F.when(parts["sign"] == "-", -1).otherwise(1))
    minutes = F.coalesce(signed, named_offset, F.lit(0))
    return F.timestamp_seconds(F.unix_seconds(local) - minutes * 60)


def parse_date_text(text: Column) -> Column:
    """Timestamp from a date text in any usual style, NULL if it holds no date."""
    return _once(date_parts(text), compose_date)


def unreadable_dates(df: DataFrame, raw: Column) -> DataFrame:
    """Counts of all rows, of rows without a date text, and of texts that hold no date."""
    rows = df.select(strip(raw).alias("_raw")).select("_raw", date_parts(F.col("_raw")).alias("_parts"))
    blank = F.coalesce(F.col("_raw") == "", F.lit(True))
    lost = ~blank & _once(F.col("_parts"), compose_date).isNull()
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(blank.cast("long")), F.lit(0)).alias("without_date"),
        F.coalesce(F.sum(lost.cast("long")), F.lit(0)).alias("unreadable"),
    )


def parse_stamp14(text: Column) -> Column:
    """Timestamp from a ``yyyyMMddHHmmss`` stamp, NULL for anything else."""
    return F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def with_publication_day(
    df: DataFrame, raw: Column, ingest_ts: Column | str, *, stamps: bool = False
) -> DataFrame:
    """Add ``day`` and ``hour_minute`` from a feed's date text, or from 14-digit stamps.

    A date without a time of day counts from the next midnight, so that nothing
    is seen before it was published. Empty or unreadable text takes the
    collection time and counts as having no time. Zones are converted to UTC.
    Each step is a column of its own, so that it is computed once per row.
    """
    now = F.lit(ingest_ts).cast("timestamp") if isinstance(ingest_ts, str) else ingest_ts
    if stamps:
        staged = df.withColumn("_parsed", parse_stamp14(raw)).withColumn("_timed", F.col("_parsed").isNotNull())
    else:
        staged = (
            df.withColumn("_raw", raw)
            .withColumn("_parts", date_parts(F.col("_raw")))
            .withColumn("_parsed", _once(F.col("_parts"), compose_date))
            .withColumn("_timed", F.col("_parsed").isNotNull() & F.col("_raw").contains(":"))
            .drop("_raw", "_parts")
        )
    timed, day = F.col("_timed"), F.to_date("_at")
    return (
        staged.withColumn("_at", F.coalesce("_parsed", now))
        .withColumns(
            {
                "day": F.when(timed, day).otherwise(F.date_add(day, 1)).cast("string"),
                "hour_minute": F.when(timed, F.date_format("_at", "HH:mm")).otherwise(F.lit("00:00")),
            }
        )
        .drop("_parsed", "_timed", "_at")
    )


def as_timestamp(df: DataFrame, name: str) -> Column:
    """A column as TIMESTAMP; NULL stays NULL, unreadable text is an error."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return _strict_timestamp(col)
    return col.cast("timestamp")


def _strict_timestamp(text: Column) -> Column:
    parsed = F.try_to_timestamp(text)
    return fail_if(
        text.isNotNull() & parsed.isNull(), "a publication time cannot be read as a timestamp", parsed
    )


def day_and_time(df: DataFrame, day: str, time: str) -> Column:
    """``day`` and ``hour_minute`` texts as one timestamp."""
    joined = F.concat(
        strip(F.col(day).cast("string")), F.lit(" "), strip(F.col(time).cast("string"))
    )
    return _strict_timestamp(joined)


def publication_time(
    df: DataFrame,
    *,
    timestamp_column: str = "timestamp",
    date_column: str = "day",
    time_column: str = "hour_minute",
    allow_date: bool = False,
) -> Column:
    """Pick the time column by fixed precedence from the columns the table has."""
    single = time_column_of(df, timestamp_column, (date_column, time_column), allow_date)
    if single is not None:
        return as_timestamp(df, single)
    if date_column in df.columns and time_column in df.columns:
        return day_and_time(df, date_column, time_column)
    raise ValueError("no publication time: expected timestamp, published_at, or day with hour_minute")


def time_column_of(
    df: DataFrame,
    timestamp_column: str = "timestamp",
    split_columns: tuple[str, str] = ("day", "hour_minute"),
    allow_date: bool = False,
) -> str | None:
    """The one column that holds the publication time, None if it is split over two."""
    for name in (timestamp_column, "published_at"):
        if name in df.columns:
            return name
    if allow_date and "date" in df.columns and not set(split_columns) <= set(df.columns):
        return "date"
    return None


def floor_minutes(ts: Column, minutes: int = 15) -> Column:
    """Start of the ``minutes``-wide window that holds ``ts``."""
    step = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_micros(ts) / F.lit(1_000_000 * step)) * F.lit(step))


def in_day_range(ts: Column, start_date: str, end_date: str, kind: str = "timestamp") -> Column:
    """Both end days included; NULL timestamps fall out.

    The bounds take the type ``kind`` of the column, so that a filter on a
    stored column reaches the scan.
    """
    first = F.lit(start_date).cast("date").cast(kind)
    after = F.date_add(F.lit(end_date).cast("date"), 1).cast(kind)
    return (ts >= first) & (ts < after)


def prune_days(df: DataFrame, name: str | None, start_date: str, end_date: str) -> DataFrame:
    """Filter a stored time column in its own type; other columns are left to later filters."""
    kind = df.schema[name].dataType if name is not None else None
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return df.filter(in_day_range(F.col(name), start_date, end_date, kind.simpleString()))
    return df
