"""The numbered queries over the sample tables, and the SQL they must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .chat_format import collapse_and_render
from .common import table
from .conversation_repair import repair_summary
from .decontaminate import scan_texts, with_hit_counts
from .embedding_dedup import near_duplicates
from .language_id import identify_languages, learn
from .license_scan import license_summary, scan_licenses
from .merkle import fold, leaf_hash, merkle_manifest, proof_hash
from .ngram_jaccard import jaccard_groups
from .piece_codec import encode_pieces
from .substring_dedup import remove_repeats
from .token_counts import token_counts
from .token_files import token_index, write_token_files
from .url_filter import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = with_hit_counts(scan_texts(docs, table(spark, sf_dir, "benchmark")))
    items = F.array_join(F.array_sort(F.col("item_ids").cast("array<string>")), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(items, 256).alias("items_sha256"),
        "contaminated",
    )


def sql_words(text: str) -> str:
    """Words of a text in DuckDB: A-Z lower-cased, runs of digits, letters and characters beyond ASCII."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLES["op2_decontamination"] = f"""
WITH items AS (SELECT item_id, {sql_words("text")} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, len(w[s:s + 12]) AS k, array_to_string(w[s:s + 12], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {sql_words("text")} AS w FROM documents),
spots AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS words
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s
        FROM docs, (SELECT DISTINCT k FROM windows))),
hits AS (SELECT doc_id, s, windows.k, item_id FROM spots JOIN windows ON spots.words = windows.words AND spots.k = windows.k),
hit_words AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS pos FROM (SELECT DISTINCT doc_id, s, k FROM hits)) GROUP BY 1),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hits) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

# The rules of the URL query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# Words whose pages are listed for blocking.
INSULTS = "idiot|pathetic|worthless"


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed are the canonical URLs of pages with an insult; other addresses of the same page are blocked with them."""
    pages = table(spark, sf_dir, "pages")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    listed = pages.where(F.col("html").rlike(INSULTS)).select("url", F.lit("block").alias("verdict"))
    return judge_urls(pages, rules, listed).select("page_id", "host", "path", "rule", "verdict")


_SQL_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES["op3_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id, url, html,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT *, coalesce({_SQL_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")}, '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
canon AS (
  SELECT page_id, host, path, html, CASE WHEN strpos(url, '://') > 0 THEN
         regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '')
         || regexp_replace(regexp_replace(path, '/index\.(html?|php)$', '/'), '/+$', '')
         || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS canonical
  FROM (SELECT *, list_sort(list_filter(
          string_split(regexp_extract(regexp_replace(rest, '#.*$', '', 's'), '\?(.*)$', 1, 's'), '&'),
          lambda p: p <> '' AND NOT regexp_matches(p, '(?i)^(utm_[a-z]+|ref|fbclid|gclid)(=|$)'))) AS q FROM split)),
listed AS (SELECT DISTINCT canonical FROM canon WHERE regexp_matches(html, '{INSULTS}') AND canonical IS NOT NULL),
rules(rh, rp, v) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
fits AS (
  SELECT page_id, arg_max(rh || rp, (length(rh || rp), rh || rp)) AS rule, arg_max(v, (length(rh || rp), rh || rp)) AS v
  FROM canon JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT canon.page_id, host, path, rule,
       coalesce(v, CASE WHEN listed.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon LEFT JOIN fits ON canon.page_id = fits.page_id LEFT JOIN listed ON canon.canonical = listed.canonical
"""


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(table(spark, sf_dir, "conversations"))


ORACLES["op4_chat_format"] = r"""
WITH turns AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1) AS turn, coalesce(lower(trim(role)), 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
steps AS (
  SELECT conv_id, turn, string_agg(turn || chr(1) || role || chr(1) || text, chr(2) ORDER BY role, text) AS step
  FROM turns GROUP BY 1, 2),
prefixes AS (
  SELECT conv_id, turn, turn = max(turn) OVER (PARTITION BY conv_id) AS is_last,
         md5(string_agg(step, chr(3)) OVER (PARTITION BY conv_id ORDER BY turn)) AS h FROM steps),
whole AS (SELECT h, min(conv_id) AS conv_id, count(*) AS copies FROM prefixes WHERE is_last GROUP BY 1),
kept AS (SELECT * FROM whole WHERE h NOT IN (SELECT h FROM prefixes WHERE NOT is_last)),
sizes AS (SELECT conv_id, count(*) AS n_turns FROM turns GROUP BY 1)
SELECT conv_id, greatest(turn, 0) // 256 AS part, n_turns, count(*) AS n_rendered, copies,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
FROM turns JOIN kept USING (conv_id) JOIN sizes USING (conv_id) GROUP BY ALL
"""


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_summary(scan_licenses(table(spark, sf_dir, "documents")))


def held_out() -> Column:
    """Rows no model learns from; a NULL id is not among them."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.where(~held_out()))
    rows = docs.select("doc_id", "text", held_out().alias("held_out"))
    return identify_languages(rows, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


ORACLES["op7_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 4], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN sizes sx ON sx.doc_id = x.doc_id JOIN sizes sy ON sy.doc_id = y.doc_id
  GROUP BY 1, 2, sx.n, sy.n HAVING 100 * count(*) >= 75 * (sx.n + sy.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT words.doc_id, coalesce(n, 0) AS n_shingles, least(words.doc_id, coalesce(m, words.doc_id)) AS component_id
FROM words LEFT JOIN sizes ON words.doc_id = sizes.doc_id LEFT JOIN least ON words.doc_id = least.a
"""


@query
def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_pieces(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


@query
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), end_id=2)
    return token_index(spark, path)


@query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLES["op10_embedding_dedup"] = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY 1),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON vec_id = degree.a LEFT JOIN least ON vec_id = least.a
"""


def sql_crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in DuckDB, bit by bit."""
    bits = "list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), xor({}, {}))"
    each = bits.format("r", "b")
    return (
        f"xor(list_reduce(list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT), lambda r, b: {each}, "
        "4294967295::BIGINT), 4294967295)"
    )


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tampered rows, those whose id has an even checksum, have lost the line ends of their text."""
    docs = table(spark, sf_dir, "documents")
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, leaf_hash(*values, F.replace("text", F.lit("\n"), F.lit(""))))
    leaves = docs.select("doc_id", "source", leaf_hash(*values, F.col("text")).alias("leaf"), tampered.alias("tampered"))
    steps = F.col("steps")
    folded = fold(F.coalesce("tampered", "leaf"), steps)
    return merkle_manifest(leaves).select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_hash(steps).alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )


def _merkle_sql(levels: int = 16) -> str:
    """Levels of leaves, then of subroots, one after the other: up to 3 ** ``levels`` nodes each."""
    field = "coalesce(octet_length(encode({0}::VARCHAR)) || ':' || {0}::VARCHAR, '-')"
    values = [field.format(c) for c in ("doc_id", "source", "lang", "n_chars")]
    parts = [
        f"""leaves AS (SELECT doc_id, source, sha256({" || ".join([*values, field.format("text")])}) AS leaf,
          CASE WHEN {sql_crc32("doc_id::VARCHAR")} % 2 = 0
               THEN sha256({" || ".join([*values, field.format("replace(text, chr(10), '')")])}) END AS tampered FROM documents)""",
        """a0 AS (SELECT *, leaf AS h, coalesce(source, '') || (source IS NULL) AS g, source IS NOT NULL AS later,
          row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
          count(*) OVER (PARTITION BY source) AS n FROM leaves)""",
    ]
    # Every row keeps its place; h becomes the hash of its node, sib what stood beside it on the way.
    start = "leaf, coalesce(tampered, leaf) AS f, ''::VARCHAR AS sib"
    parts.append(f"w0 AS (SELECT doc_id, source, g, later, pos, n, h, {start} FROM a0)")

    def climb(name: str, key: str, k: int) -> str:
        """Nodes of level ``k`` and, from them, rows of level ``k`` + 1."""
        old, new = f"{name}{k}", f"{name}{k + 1}"
        return f"""
          {old}n AS (SELECT DISTINCT {key} AS g, pos, n, h FROM {old}),
          {old}r AS (SELECT g, pos // 3 AS run, list(h ORDER BY pos) AS hs FROM {old}n WHERE n > 1 GROUP BY ALL),
          {new} AS (
            SELECT o.* REPLACE (
              CASE WHEN n > 1 THEN pos // 3 ELSE pos END AS pos,
              CASE WHEN n > 1 THEN (n + 2) // 3 ELSE n END AS n,
              CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE h END AS h,
              CASE WHEN n > 1 THEN sha256(array_to_string(hs[:pos % 3], '') || f || array_to_string(hs[pos % 3 + 2:], '')) ELSE f END AS f,
              CASE WHEN n > 1 THEN sib || array_to_string(hs[:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], '') ELSE sib END AS sib)
            FROM {old} o LEFT JOIN {old}r r ON o.{key} = r.g AND o.pos // 3 = r.run)"""

    parts += [climb("w", "g", k) for k in range(levels)]
    parts.append(
        f"""u0 AS (SELECT doc_id, leaf, f, sib, h AS subroot, h, 'all' AS every,
          dense_rank() OVER (ORDER BY later, source) - 1 AS pos,
          (SELECT count(DISTINCT g) FROM a0) AS n FROM w{levels})"""
    )
    parts += [climb("u", "every", k) for k in range(levels)]
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, subroot, h AS root, sha256(sib) AS proof_sha256, f AS folded_root, f = h AS verified FROM u{levels}"""


ORACLES["op11_merkle_manifest"] = _merkle_sql()


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with faults of a fixed rule: rows dropped, emptied, without sentence ends, repeated, given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = (F.crc32(key.cast("binary")) % 20).alias("kind")
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    changed = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text)
    return (
        conversations.select("conv_id", "turn", "role", "text", kind)
        .where("kind <> 0")
        .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(role).alias("role"), changed.alias("text"), "kind")
        .withColumn("_copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .drop("kind", "_copy")
    )


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    repaired = repair_summary(damaged(conversations)).withColumnRenamed("conv_id", "_conv")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    originals = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    return originals.join(repaired, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def _repair_sql() -> str:
    never = 1000000

    def row(stay: str, initials: dict[str, str], turned: str) -> str:
        """Cost before a row, from the costs after it, without insertions."""
        kept = "".join(f" WHEN '{i}' THEN {b}" for i, b in initials.items())
        return f"least(2 + {stay}, CASE WHEN del THEN {never} ELSE pen + least(CASE ini{kept} ELSE {never} END, 1 + {turned}) END)"

    after = [row("b0", {"s": "b1", "u": "b2"}, "b2"), row("b1", {"u": "b2"}, "b2"), row("b2", {"a": "b3"}, "b3"), row("b3", {"u": "b2"}, "b2")]
    costs = ", ".join(f"{x} AS x{k}" for k, x in enumerate(after))
    return rf"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {sql_crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
changed AS (
  SELECT coalesce(conv_id::VARCHAR, ' ') AS c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM changed),
marked AS (
  SELECT *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stem, left(role, 1) AS ini,
         row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS seen,
         left(lag(role) OVER (PARTITION BY c ORDER BY i), 1) AS prior FROM placed),
facts AS (
  SELECT *, stem = '' AS blank, stem <> '' AND seen AS dup, stem <> '' AND NOT seen AND right(stem, 1) NOT IN ('.', '!', '?') AS cut,
         stem = '' OR seen AS del, CASE WHEN right(stem, 1) NOT IN ('.', '!', '?') THEN 5 ELSE 0 END AS pen FROM marked),
counts AS (
  SELECT c, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (cut) AS truncated,
         count(*) FILTER (prior || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM facts GROUP BY c),
back AS (
  SELECT c, n + 1 AS i, 0 AS b0, 10 AS b1, 5 AS b2, 0 AS b3 FROM counts
  UNION ALL
  SELECT c, i, least(x0, 5 + x2, 10 + x3), least(x1, 5 + x2, 10 + x3), least(x2, 5 + x3), least(x3, 5 + x2)
  FROM (SELECT back.c, facts.i, {costs} FROM back JOIN facts ON facts.c = back.c AND facts.i = back.i - 1)),
vec AS (SELECT c, i, [b0, b1, b2, b3] AS b FROM back),
walk AS (
  SELECT c, 1::BIGINT AS i, 0 AS q, ''::VARCHAR AS audit, []::VARCHAR[] AS said, false AS stop FROM counts
  UNION ALL
  SELECT c, CASE WHEN e IN ('I', '') THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN q WHEN '' THEN q WHEN 'K' THEN k ELSE t END, audit || e,
         CASE WHEN e IN ('D', '') THEN said ELSE list_append(said, CASE WHEN e = 'K' THEN role
              WHEN t = 2 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END) END,
         e = ''
  FROM (
    SELECT *, CASE WHEN here THEN CASE WHEN 2 + w[q + 1] = v[q + 1] THEN 'D' WHEN 5 + v[t + 1] = v[q + 1] THEN 'I'
                                       WHEN k IS NOT NULL AND pen + w[k + 1] = v[q + 1] THEN 'K' ELSE 'R' END
                   WHEN v[q + 1] > 0 THEN 'I' ELSE '' END AS e
    FROM (SELECT walk.*, v.b AS v, w.b AS w, f.role, f.text, f.pen, f.i IS NOT NULL AS here,
                 CASE WHEN q = 2 THEN 3 ELSE 2 END AS t,
                 CASE WHEN ini = 's' AND q = 0 THEN 1 WHEN ini = 'u' AND q <> 2 THEN 2 WHEN ini = 'a' AND q = 2 THEN 3 END AS k
          FROM walk JOIN vec v ON v.c = walk.c AND v.i = walk.i LEFT JOIN vec w ON w.c = walk.c AND w.i = walk.i + 1
          LEFT JOIN facts f ON f.c = walk.c AND f.i = walk.i WHERE NOT stop))),
done AS (SELECT walk.c, audit, said, b[1] AS cost FROM walk JOIN vec ON vec.c = walk.c AND vec.i = 1 WHERE stop)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.c = coalesce(conv_id::VARCHAR, ' ') LEFT JOIN done ON done.c = coalesce(conv_id::VARCHAR, ' ')
"""


ORACLES["op12_conversation_repair"] = _repair_sql()


@query
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op13_substring_dedup"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words)),
least AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS p FROM windows JOIN least ON windows.h = least.h AND m < doc_id),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT each.doc_id, string_agg(word, ' ' ORDER BY each.p) AS t, count(*) AS n
  FROM each LEFT JOIN gone ON each.doc_id = gone.doc_id AND each.p = gone.p WHERE gone.p IS NULL GROUP BY 1)
SELECT words.doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""
