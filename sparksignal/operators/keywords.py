"""Keyword lists of any length: which keywords a text contains.

The keywords of a table go into an automaton that finds all of them in one pass
over a text, however many there are. A task holds one block of keywords,
bounded in bytes; longer lists take one pass over the texts per block, and only
the hits of each pass are carried on.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.common import strip
from ..session import cut_lineage

#: Bytes of the keywords one task holds; the automaton takes some fifty times as much.
BLOCK_BYTES = 4 * 1024 * 1024

_BUILT: dict[int, tuple] = {}


def _automaton(block):
    """(automaton, whether the empty keyword is listed) of a broadcast block, kept between a worker's tasks."""
    import ahocorasick

    if id(block) not in _BUILT:
        _BUILT.clear()
        automaton = ahocorasick.Automaton()
        for word in block.value:
            if word:
                automaton.add_word(word, word)
        automaton.make_automaton()
        # The block itself is kept, so that its number stays its own.
        _BUILT[id(block)] = block, automaton, "" in block.value
    return _BUILT[id(block)][1:]


def _finder(block):
    @F.pandas_udf("array<string>")
    def found(texts: pd.Series) -> pd.Series:
        automaton, always = _automaton(block)
        scan = automaton.iter if len(automaton) else lambda _: ()
        start = {""} if always else set()
        return pd.Series([sorted(start.union(word for _, word in scan(text))) for text in texts], index=texts.index)

    return found


def keyword_table(spark: SparkSession, keywords: DataFrame | Sequence[str], trim: bool = True) -> DataFrame:
    """(keyword): the distinct lower-cased keywords of a list or of a table's first column, NULL ones left out.

    With ``trim`` white space around keywords is removed and blank ones are
    ignored; without it they stay as they are, the empty one included.
    """
    if not isinstance(keywords, DataFrame):
        keywords = spark.createDataFrame([(k,) for k in keywords], "keyword string")
    word = F.col(keywords.columns[0]).cast("string")
    words = keywords.select(F.lower(strip(word) if trim else word).alias("keyword")).where("keyword is not null")
    return (words.where("keyword <> ''") if trim else words).distinct()


def with_keywords(
    df: DataFrame,
    text: Column,
    keywords: DataFrame | Sequence[str],
    *,
    out: str = "matched",
    trim: bool = True,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``df`` with the sorted array of all keywords its lower-cased ``text`` contains.

    A NULL text is empty: it contains the empty keyword, if that is listed, and
    nothing else. All rows stay, repeated ones too; without keywords the arrays are
    empty. An existing column ``out`` is replaced.
    """
    spark = df.sparkSession
    words = cut_lineage(keyword_table(spark, keywords, trim))
    blocks = max(1, math.ceil((words.agg(F.sum(F.octet_length("keyword"))).first()[0] or 0) / block_bytes))
    part = F.pmod(F.xxhash64("keyword"), F.lit(blocks))
    finders = [
        _finder(spark.sparkContext.broadcast([r[0] for r in words.where(part == b).select("keyword").collect()])) for b in range(blocks)
    ]
    lowered = F.lower(F.coalesce(text, F.lit("")))
    if blocks == 1:
        return df.withColumn(out, finders[0](lowered))
    rows = cut_lineage(df.withColumns({"_text": lowered, "_row": F.monotonically_increasing_id()}))
    hits = reduce(DataFrame.unionByName, [rows.select("_row", F.explode(f("_text")).alias("_word")) for f in finders])
    found = hits.groupBy("_row").agg(F.array_sort(F.collect_list("_word")).alias("_found"))
    none = F.expr("cast(array() as array<string>)")
    return rows.join(found, "_row", "left").withColumn(out, F.coalesce("_found", none)).drop("_row", "_text", "_found")


def keyword_rows(df: DataFrame, text: Column, keywords: DataFrame | Sequence[str], **options) -> DataFrame:
    """The rows of ``df`` whose text contains a keyword, with those it contains; see ``with_keywords``."""
    out = options.get("out", "matched")
    return with_keywords(df, text, keywords, **options).where(F.size(out) > 0)
