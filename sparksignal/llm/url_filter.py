"""URL filtering by lists of rules and of canonical URLs.

Listed keys go into a blocked Bloom filter: a key's hash picks one block and a
few bits in it. Each URL brings the keys that could list it (its canonical
form, and every parent host with every rule-length start of its path). The
filter passes possible hits only; a hash join with the list removes the false
ones. The filter's size is a parameter, its blocks are the broadcast side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a block are kept as this many numbers of 32 bits.
LANES = 8
#: Blocks of the filter; 32 bytes each.
BLOCKS = 1 << 15
#: Copies of the list in the exact join, so that no listed key is a hot one.
SALTS = 32

# Query parameters that do not change what a URL names.
TRACKING = r"(?i)^(utm_[a-z]+|ref|fbclid|gclid)(=|$)"
# Pages a server gives for a folder.
INDEX_PAGE = r"/index\.(html?|php)$"


def _lower(col: Column) -> Column:
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one and for NULL."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def url_host(url: Column) -> Column:
    """Host with A-Z lower-cased, port included."""
    return _lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """Path up to the query or fragment."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """One form for URLs that name the same page: no scheme, fragment, default port, ``www.``, tracking parameter,
    index page or closing slash; parameters sorted. NULL where there is no ``://``."""
    rest = F.regexp_replace(_rest(url), r"(?s)#.*$", "")
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), INDEX_PAGE, "/"), r"/+$", "")
    asked = F.regexp_extract(rest, r"(?s)\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(asked, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("rule "), host, F.lit(" "), path)


def url_key(canonical: Column) -> Column:
    return F.concat(F.lit("url "), canonical)


def _parents(host: Column) -> Column:
    """The host and every host above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )


def _candidates(host: Column, path: Column, canonical: Column, lengths: list[int]) -> Column:
    """All keys under which a URL may be listed."""
    starts = F.filter(
        F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.when(F.length(path) >= n, F.substring(path, F.lit(1), n))),
        lambda s: s.isNotNull(),
    )
    rules = F.flatten(F.transform(_parents(host), lambda h: F.transform(starts, lambda s: rule_key(h, s))))
    listed = F.when(canonical.isNotNull(), F.array(url_key(canonical))).otherwise(F.expr("cast(array() as array<string>)"))
    return F.concat(rules, listed) if lengths else listed


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit in each lane, from five bits of the key's second hash."""
    h = F.xxhash64(F.lit(2), key)
    return [
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 5 * k).bitwiseAND(F.lit(31)).cast("int")
        )
        for k in range(LANES)
    ]


def bloom_filter(keys: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(block, lane0..lane7): the blocks of the filter that hold a key. Never more than ``blocks`` rows."""
    bits = _bits(F.col("key"))
    return (
        keys.select(_block(F.col("key"), blocks).alias("block"), *[b.alias(f"lane{k}") for k, b in enumerate(bits)])
        .groupBy("block")
        .agg(*[F.bit_or(f"lane{k}").alias(f"lane{k}") for k in range(LANES)])
    )


def _probed(rows: DataFrame, key: str, bloom: DataFrame, blocks: int, how: str) -> DataFrame:
    bits = _bits(F.col(key))
    found = rows.withColumn("_block", _block(F.col(key), blocks)).join(
        F.broadcast(bloom.withColumnRenamed("block", "_block")), "_block", how
    )
    hit = F.lit(True)
    for k, b in enumerate(bits):
        hit = hit & (F.coalesce(F.col(f"lane{k}"), F.lit(0)).bitwiseAND(b) != 0)
    return found.withColumn("_hit", hit)


def may_be_listed(rows: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose key the filter lets pass: all that are listed, and a few others."""
    return _probed(rows, key, bloom, blocks, "inner").where("_hit").select(*rows.columns)


def not_listed(rows: DataFrame, key: str, bloom: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """The rows whose key the filter stops: surely not listed."""
    return _probed(rows, key, bloom, blocks, "left").where("not _hit").select(*rows.columns)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    listed: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    otherwise: str = "allow",
    blocks: int = BLOCKS,
) -> DataFrame:
    """(page_id, host, path, rule, listed, verdict) for every row of ``pages``.

    ``rules``: (host, path, verdict); a rule fits its host and all hosts below,
    where the URL's path starts with the rule's. The longest rule wins, by the
    length of host and path, then by text. ``listed``: (url, verdict), compared
    in canonical form; it decides where no rule fits; of several verdicts the
    last by text counts. ``otherwise`` is the verdict of all others.

    A URL that is NULL or has no ``://`` has an empty host and path and is
    under no rule. Repeated rows, NULL ids included, each come back. Empty lists
    list nothing. Other columns take no part.
    """
    keys = rules.select(
        rule_key(F.col("host"), F.col("path")).alias("key"),
        F.concat("host", "path").alias("rule"),
        F.col("verdict"),
    ).unionByName(
        listed.where(canonical_url(F.col("url")).isNotNull()).select(
            url_key(canonical_url(F.col("url"))).alias("key"), F.lit(None).cast("string").alias("rule"), F.col("verdict")
        )
    )
    keys = keys.groupBy("key").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))
    # Path lengths of rules: as many as the longest path has characters at most.
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect() if r[0] is not None)
    bloom = bloom_filter(keys, blocks)

    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")).withColumns(
        {"host": url_host(url), "path": url_path(url), "canonical": canonical_url(url)}
    )
    candidates = rows.where(F.col("canonical").isNotNull()).select(
        "page_id", "url", F.explode(_candidates(F.col("host"), F.col("path"), F.col("canonical"), lengths)).alias("key")
    )
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    salted = keys.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = may_be_listed(candidates, "key", bloom, blocks).withColumn("salt", salt)
    found = hits.join(salted.hint("shuffle_hash"), ["key", "salt"]).select("page_id", "url", "rule", "verdict")
    # By length of the rule, then its text; listed URLs come after all rules.
    weight = F.struct(F.coalesce(F.length("rule"), F.lit(-1)).alias("n"), F.col("rule").alias("rule"), F.col("verdict").alias("v"))
    best = (
        found.groupBy("page_id", "url")
        .agg(F.max(weight).alias("best"), F.max(F.col("rule").isNull()).alias("listed"))
        .select(F.col("page_id").alias("hit_id"), F.col("url").alias("hit_url"), "best", "listed")
    )
    same = rows["page_id"].eqNullSafe(F.col("hit_id")) & (rows["url"] == F.col("hit_url"))
    return rows.join(best, same, "left").select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("listed"), F.lit(False)).alias("listed"),
        F.coalesce(F.col("best.v"), F.lit(otherwise)).alias("verdict"),
    )
