"""Operators over several rows against brute force: links, groups, conversations, URL lists."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparksignal.llm import queries
from sparksignal.llm.chat_format import collapse_and_render
from sparksignal.llm.components import connected_components
from sparksignal.llm.embedding_dedup import near_duplicates
from sparksignal.llm.ngram_jaccard import jaccard_groups, keep_one_of_each_group, shingles
from sparksignal.llm.url_filter import canonical_url, judge_urls

from .fixtures import SF, texts_of


class Groups:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def tie(self, a, b):
        a, b = self.find(a), self.find(b)
        self.parent[max(a, b)] = min(a, b)


def test_components_equal_union_find(spark):
    draw = random.Random(7)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 540)]
    loose = [(draw.randint(1000, 1060), draw.randint(1000, 1060)) for _ in range(45)]
    edges = [*chain, *star, *loose, (7, 7), (8, 9), (9, 8), (None, 3), (3, None), (2**62, -5)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups = Groups()
    for a, b in edges:
        if a is not None and b is not None and a != b:
            groups.tie(a, b)
    assert got == {x: groups.find(x) for x in list(groups.parent)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# Jaccard groups


def shingle_set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    k = min(5, len(words))
    return {tuple(words[a : a + k]) for a in range(len(words) - k + 1)} if k else set()


def brute_groups(rows):
    sets = [shingle_set(t) for _, t in rows]
    groups = Groups()
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * len(sets[i] | sets[j]):
            groups.tie(i, j)
    out = []
    for i, (doc, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if groups.find(j) == groups.find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(members) if members else None))
    return out


def near_copies(seed):
    """Random texts, exact copies, chains of ever more changed copies, shared passages, and odd rows."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = draw.choices(vocabulary, k=40)
    rows, ids = [], iter(draw.sample(range(10_000), 2_000))

    def text(n):
        return draw.choices(vocabulary, k=n)

    for _ in range(25):
        base = text(draw.randint(3, 120))
        rows.append((next(ids), " ".join(base)))
        for _ in range(draw.randint(0, 5)):
            base = list(base)
            for _ in range(draw.randint(0, max(1, len(base) // 30))):
                base[draw.randrange(len(base))] = draw.choice(vocabulary)
            rows.append((next(ids), (" " if draw.random() < 0.5 else "\n").join(base).title()))
    for _ in range(30):  # mostly one shared passage, some of it enough to link
        own = text(draw.randint(0, 25))
        rows.append((next(ids), " ".join([*own, *passage, *text(draw.randint(0, 6))])))
    dense = text(200)
    for _ in range(40):  # a large group of near copies
        copy = list(dense)
        for _ in range(draw.randint(1, 6)):
            copy[draw.randrange(200)] = draw.choice(vocabulary)
        rows.append((next(ids), " ".join(copy)))
    rows += [(None, rows[0][1]), (None, "never seen before by anyone at all"), (1, None), (2, ""), (3, " \t\n"), (4, "one")]
    rows += [(5, "one"), (6, "ONE two"), (5, "two other words under the same id"), rows[3], rows[3]]
    return rows


def test_jaccard_groups_equal_brute_force(spark):
    rows = near_copies(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("set", F.lit("x")).withColumn("n", F.lit(1))
    got = jaccard_groups(docs.repartition(5)).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute_groups(rows), key=str)


def test_one_of_each_group_stays(spark):
    rows = near_copies(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("root", F.lit("x"))
    kept = keep_one_of_each_group(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] for r in kept.collect()), key=str)
    want, seen = [], set()
    for (doc, _), (_, size, component) in zip(rows, brute_groups(rows), strict=True):
        if not size:
            want.append(doc)
        elif component is None:
            want.append(None)
        elif component not in seen:
            seen.add(component)
            want.append(component)
    # One id holds two unlinked texts: both stay.
    want.append(5) if sum(r[0] == 5 for r in kept.collect()) == 2 else None
    assert got == sorted(want, key=str)


def test_shingles_are_sets_of_word_sequences():
    for text in ["a b c d e f a b c d e f", "A  b\tc", "x", "é ß é ß é ß é ß", "w " * 300_000]:
        assert len(shingles(text.encode())) == len(shingle_set(text))
    assert len(shingles(None)) == len(shingles(b" \n")) == 0
    assert set(shingles(b"a b c d e")) & set(shingles(b"a b c d")) == set()


# Embeddings


def cosine_rows(seed):
    draw = np.random.default_rng(seed)
    rows, at = [], 0
    for label in (0, 1, None):
        for _ in range(12):
            base = draw.normal(size=16)
            for _ in range(int(draw.integers(1, 7))):
                v = base + draw.normal(scale=0.05, size=16)
                rows.append((at, [float(x) for x in v.astype(np.float32)], label))
                at += 1
    rows += [(at + 1, rows[0][1], 0), (at + 2, [2 * x for x in rows[0][1]], 0), (at + 3, rows[0][1], 0)]
    rows += [(at + 4, None, 0), (at + 5, [0.0] * 16, 0), (at + 6, [float("nan")] * 16, 0), (at + 7, [None] * 16, 0)]
    rows += [(at + 8, [float("inf")] * 16, 0), (at + 9, [1.0, 2.0], 0), (at + 10, [1.0, 2.0], 0), (at + 11, [], 0)]
    rows += [(at + 1, rows[0][1], 0), (None, rows[0][1], 0), (None, [0.0] * 16, 1), (at + 12, [1e-30] * 16, 1), (at + 13, [1e30] * 16, 1)]
    return rows


def brute_links(rows):
    def usable(v):
        return v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    groups, links = Groups(), [0] * len(rows)
    for i, j in itertools.combinations(range(len(rows)), 2):
        (_, a, x), (_, b, y) = rows[i], rows[j]
        if x is None or x != y or not usable(a) or not usable(b) or len(a) != len(b):
            continue
        a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
        if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
            links[i] += 1
            links[j] += 1
            groups.tie(i, j)
    out = []
    for i, (vec, _, _) in enumerate(rows):
        members = [rows[j][0] for j in range(len(rows)) if groups.find(i) == groups.find(j) and rows[j][0] is not None]
        component = min(members) if members else None
        out.append((vec, links[i], component, vec is not None and vec == component))
    return out


@pytest.mark.parametrize("block", [1000, 2])
def test_embedding_links_equal_brute_force(spark, block):
    rows = cosine_rows(11)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("w", F.lit("x"))
    got = near_duplicates(df, block=block)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_links(rows), key=str)


@pytest.mark.parametrize("block", [1000, 7])
def test_chains_of_embeddings_stay_together(spark, block):
    """Vectors along arcs, each near its two neighbours only, numbered at random."""
    draw = random.Random(4)
    steps = [np.deg2rad(8 * k + (30 if k >= 15 else 0)) for k in range(30)]
    ids = draw.sample(range(1000), len(steps))
    rows = [(i, [float(np.cos(s)), float(np.sin(s))], 1) for i, s in zip(ids, steps, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = near_duplicates(df, bits=2, tables=24, block=block)
    want = brute_links(rows)
    assert len({r[2] for r in want}) == 2
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_no_embeddings(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


# URLs


URLS = [
    (1, "http://www.Example.ORG/es/x?a=1"),
    (2, "https://example.org/en/123"),
    (3, "https://sub.example.org:8080/en/9#top"),
    (4, "HTTP://shop.com/fr"),
    (5, "http://shop.com/fr/index.html?utm_source=x&b=2&a=1"),
    (6, "https://www.shop.com/fr/?a=1&b=2"),
    (7, "no scheme"),
    (8, None),
    (8, None),
    (None, "https://listed.net/page/"),
    (9, "http://listed.net/page#x"),
    (9, "http://listed.net/page#x"),
    (10, "http://notlisted.net/page"),
    (11, "x://"),
    (12, "http://org/path?q=://y"),
    (13, "http://badexample.org/es/"),
    (14, "http://com/de/"),
    (15, "http://a.b.c.com/de/" + "y" * 5000),
]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def brute_url(url, rules, listed):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail[: min([tail.index(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for h, p, v in rules if url and "://" in url and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if listed else "allow"


@pytest.mark.parametrize("blocks", [1 << 15, 1])
def test_urls_equal_brute_force(spark, blocks):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("rule", F.lit("x"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([("https://www.listed.net/page?ref=1", "block"), (None, "block"), ("junk", "block")], "url string, verdict string")
    got = judge_urls(pages, rules, listed, blocks=blocks).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, *brute_url(u, RULES, i in (None, 9))) for i, u in URLS]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    nothing = judge_urls(pages, rules.limit(0), listed.limit(0), otherwise="keep")
    assert {r["verdict"] for r in nothing.collect()} == {"keep"}
    assert judge_urls(pages.limit(0), rules, listed).count() == 0


def test_canonical_urls(spark):
    texts = dict(URLS)
    rows = spark.createDataFrame(URLS, "page_id long, url string").select("page_id", canonical_url(F.col("url")).alias("c")).collect()
    got = {r["page_id"]: r["c"] for r in rows}
    assert got[5] == got[6] == "shop.com/fr?a=1&b=2"
    assert got[None] == got[9] == "listed.net/page"
    assert got[7] is None and got[8] is None and texts[7] == "no scheme"


# Conversations


def brute_chat(rows, stretch):
    logs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            step = (-1 if turn is None else turn, (role or "unknown").strip().lower(), text or "")
            logs.setdefault(conv, set()).add(step)
    prefixes = set()
    for steps in logs.values():
        last = max(t for t, _, _ in steps)
        for turn in {t for t, _, _ in steps} - {last}:
            prefixes.add(frozenset(s for s in steps if s[0] <= turn))
    out, wholes = [], {}
    for conv, steps in logs.items():
        wholes.setdefault(frozenset(steps), []).append(conv)
    for steps, convs in wholes.items():
        if steps in prefixes:
            continue
        parts = {}
        for t, role, text in sorted(steps):
            parts.setdefault(max(t, 0) // stretch, []).append(f"<|im_start|>{role}\n{text}<|im_end|>\n")
        for part, lines in parts.items():
            out.append((min(convs), part, len(steps), len(lines), len(convs), "".join(lines)))
    return out


CHATS = [
    *[(1, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for t in range(3)],
    *[(2, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for t in range(9)],
    *[(3, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for t in range(9)],
    *[(4, t, "user" if t % 2 == 0 else "assistant", f"line {t}") for t in range(4)],
    (4, 4, "assistant", "another end"),
    (5, 0, " User ", "line 0"),
    (6, 0, "user", "hello"),
    (6, 0, "user", "hello"),
    (6, 0, "assistant", "a tie"),
    (7, 0, "user", "hello"),
    (8, None, None, None),
    (9, None, "unknown", ""),
    (9, 1, "user", "x" * 100_000),
    (None, 0, "user", "nobody's"),
    (-1, 5, "user", "late start"),
]


@pytest.mark.parametrize("stretch", [256, 2])
def test_conversations_equal_brute_force(spark, stretch):
    log = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").withColumn("n", F.lit("x"))
    got = collapse_and_render(log, stretch)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(brute_chat(CHATS, stretch), key=str)
    assert collapse_and_render(log.limit(0)).count() == 0


def test_conversations_stay_native(spark):
    plan = collapse_and_render(spark.read.parquet(f"{SF}/conversations.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# The pipeline


def test_pipeline_equals_brute_force(spark):
    import hashlib

    import corpus_pipeline
    from tests.llm.test_text_operators import brute_hits, pieces

    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 4
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    rows = [(d, t) for d, t in texts_of(spark) if t and any(c.isalpha() for c in t)]
    rows = [(d, t) for (d, t), (_, n, c) in zip(rows, brute_groups(rows), strict=True) if not n or c == d]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sp, want = pieces(), {}
    for doc, text in rows:
        words, hit, _ = brute_hits(text, items, 13)
        if not (hit and 20 * len(hit) >= len(words)):
            want[doc] = sp.encode(text)
    assert got.keys() == want.keys()
    for doc, ids in want.items():
        assert got[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_pipeline_stages_on_empty_and_odd_rows(spark):
    import corpus_pipeline

    rows = [(1, None, None, None), (2, "", "en", "s"), (None, "a text without an id", None, "s"), (3, "the words of a text", "en", None)]
    for part in (rows, []):
        docs = spark.createDataFrame(part, "doc_id long, text string, lang string, source string")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == ["doc_id", "text", "lang", "source"], name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == (2 if part else 0)


def test_numbered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 11))
