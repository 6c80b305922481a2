"""Merkle manifest, conversation repair and substring removal against plain versions."""

import functools
import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparksignal.llm import conversation_repair, merkle, substring_dedup
from sparksignal.llm.hashing import Runs, word_hashes
from sparksignal.llm.queries import damaged

# Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_way(nodes, i):
    """Root of the nodes, and what stands before and after node i and its parents."""
    steps = []
    while len(nodes) > 1:
        run = i // 3 * 3
        steps.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])))
        nodes, i = [H(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], i // 3
    return nodes[0], steps


def plain_manifest(rows):
    """(doc_id, leaf, subroot, root, steps) of (doc_id, source, leaf)."""
    groups = defaultdict(list)
    for doc, source, leaf in rows:
        groups[source].append((doc is not None, doc or 0, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    roots = {}
    for name in names:
        groups[name].sort()
        roots[name] = plain_way([g[2] for g in groups[name]], 0)[0]
    out = []
    for k, name in enumerate(names):
        leaves = [g[2] for g in groups[name]]
        root, above = plain_way([roots[n] for n in names], k)
        for i, (known, doc, leaf) in enumerate(groups[name]):
            subroot, steps = plain_way(leaves, i)
            out.append((doc if known else None, leaf, subroot, root, tuple(steps + above)))
    return sorted(out, key=repr)


def spark_manifest(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").withColumn("n", F.lit(1))
    found = merkle.merkle_manifest(df.withColumnRenamed("n", "block")).collect()
    return sorted([(r["doc_id"], r["leaf"], r["subroot"], r["root"], tuple((s[0], s[1]) for s in r["steps"])) for r in found], key=repr)


@pytest.mark.parametrize("sizes", [[1], [2, 1], [9, 10, 1], [100, 3, 28], [1] * 12])
def test_merkle_levels_and_recursion(spark, monkeypatch, sizes):
    # Blocks of nine make few rows climb several tables of blocks.
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    rows = [(i, f"s{g}", H(str(g), str(i))) for g, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert spark_manifest(spark, rows) == plain_manifest(rows)


def test_merkle_full_blocks(spark):
    rows = [(i * 3 - 50, "hot" if i % 4 else "é", H(str(i))) for i in range(1000)]
    assert spark_manifest(spark, rows) == plain_manifest(rows)


def test_merkle_odd_rows(spark):
    rows = [(None, None, H("a")), (None, None, H("a")), (5, None, H("b")), (5, "", H("c")), (5, "", H("d")), (-1, "z", H("e")), (7, "Z", H("f"))]
    assert spark_manifest(spark, rows) == plain_manifest(rows)
    assert spark_manifest(spark, []) == []
    with pytest.raises(ValueError, match="rename"):
        merkle.merkle_manifest(spark.createDataFrame([(1, "s", "h", 1)], "doc_id long, source string, leaf string, Root int"))


def test_leaf_hash_and_fold(spark):
    rows = [(1, "é\n", None), (None, "", 7), (2, None, -3), (3, "x" * 100_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    found = [r[0] for r in df.select(merkle.leaf_hash(*[F.col(c) for c in df.columns])).collect()]
    assert found == [H(*[plain_field(v) for v in r]) for r in rows]
    step = F.array(F.struct(F.lit("aa").alias("before"), F.lit("").alias("after")), F.struct(F.lit("").alias("before"), F.lit("").alias("after")))
    got = spark.range(1).select(merkle.fold(F.lit("00"), step), merkle.proof_hash(step)).first()
    assert tuple(got) == (H(H("aa00")), H("aa"))


# Conversation repair


def plain_edits(facts):
    """(cost, audit, rows) by best strings for every state, from the end."""
    keep = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.cache
    def best(i, q, inserted):
        options = []
        if i == len(facts) and q in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:  # more in a row never help
            new = "a" if q == "u" else "u"
            c, a, r = best(i, new, inserted + 1)
            options.append((c + 5, "I" + a, (("user" if new == "u" else "assistant") + ":", *r)))
        if i < len(facts):
            role, text, fault = facts[i]
            c, a, r = best(i + 1, q, 0)
            options.append((c + 2, "D" + a, r))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                if role[:1] in keep[q]:
                    c, a, r = best(i + 1, role[:1], 0)
                    options.append((c + extra, "K" + a, (f"{role}:{text}", *r)))
                new = "a" if q == "u" else "u"
                c, a, r = best(i + 1, new, 0)
                options.append((c + extra + 1, "R" + a, (("user" if new == "u" else "assistant") + f":{text}", *r)))
        return min(options, default=(10**9, "", ()))

    import sys

    sys.setrecursionlimit(100_000)
    return best(0, "", 0)


BLANKS = " \t\n\x0b\x0c\r"


def plain_repair(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn, " " if role is None else role, " " if text is None else text))
    out = {}
    for conv, said in groups.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        facts, seen = [], set()
        for _, role, text in said:
            stem = text.strip(BLANKS)
            fault = "blank" if not stem else "duplicate" if (role, text) in seen else "truncated" if stem[-1] not in ".!?" else ""
            seen.add((role, text))
            facts.append((role, text, fault))
        turns = [t for t, *_ in said if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [sum(f == kind for *_, f in facts) for kind in ("blank", "duplicate", "truncated")]
        initials = [r[:1] for r, *_ in facts]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, kept = plain_edits(tuple(facts))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def random_conversation(rng, n):
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    weights = [8, 8, 1, 1, 0.3, 0.3, 0.3]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n", None, "Fine. \t"]
    turn, rows = 0, []
    for k in range(n):
        turn += rng.choice([0, 1, 1, 1, 2])
        text = rng.choice(texts) if rng.random() < 0.3 else f"Part {k}{rng.choice(['.', '.', '.', ''])}"
        rows.append((None if rng.random() < 0.03 else turn, rng.choices(roles, weights)[0], text))
    return rows


SAID = "conv_id long, turn long, role string, text string"


def test_repair_agrees_with_plain_version(spark):
    rng = random.Random(7)
    rows = [(c, *r) for c in range(60) for r in random_conversation(rng, rng.randint(1, 9))]
    # Long ones have checkpoints; the key None is a conversation, too.
    rows += [(c, *r) for c, n in ((100, 65), (101, 400), (None, 150)) for r in random_conversation(rng, n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SAID).withColumns({"pos": F.lit("x"), "codes": F.lit(1)})
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.repair_summary(df).collect()}
    assert found == plain_repair(rows)
    edits = conversation_repair.repair_edits(df).collect()
    of_long = sorted((r for r in edits if r["conv_id"] == 101), key=lambda r: r["place"])
    assert "".join(r["edit"] for r in of_long) == found[101][6]
    said = "\n".join(f"{r['role']}:{r['text']}" for r in of_long if r["edit"] != "D")
    assert hashlib.sha256(said.encode()).hexdigest() == found[101][7]


def test_repair_of_nothing_and_of_long_texts(spark):
    assert conversation_repair.repair_summary(spark.createDataFrame([], SAID)).collect() == []
    rows = [(1, 0, "user", "a" * 2_000_000 + "."), (1, 1, "assistant", "b." * 500_000)] + [(2, 5, "user", "Again.")] * 300
    found = {r[0]: tuple(r)[1:] for r in conversation_repair.repair_summary(spark.createDataFrame(rows, SAID)).collect()}
    assert found == plain_repair(rows)
    assert found[2][1:4] == (0, 299, 0) and found[1][6] == "KK"


def test_matrices_give_the_vectors():
    rng = random.Random(3)
    for _ in range(50):
        codes = "".join(rng.choice("suaoSUAObd") for _ in range(rng.randint(1, 30)))
        at = rng.randint(0, len(codes))
        after = conversation_repair.backward(codes[at:], conversation_repair.END)
        assert conversation_repair.before_piece(conversation_repair.matrix(codes[:at]), after) == conversation_repair.backward(
            codes, conversation_repair.END
        )


def test_damage(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (*range(40), None) for r, x in (("assistant", "Yes. No!"), (None, None))]
    found = sorted(map(tuple, damaged(spark.createDataFrame(rows, SAID)).collect()), key=repr)
    expected = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if kind == 4:
            r = "user"
        x = "" if kind == 1 else x.replace(".", "").replace("!", "") if kind == 2 else x
        expected += [(c, t, r, x)] * {0: 0, 3: 2}.get(kind, 1)
    assert found == sorted(expected, key=repr)


# Substring removal


def plain_removal(rows, window):
    least = {}
    words = [(doc, (text or "").encode().split()) for doc, text in rows]
    rank = lambda d: (d is None, d or 0)
    for doc, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            least[key] = min(least.get(key, rank(doc)), rank(doc))
    out = []
    for doc, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < rank(doc):
                gone[i : i + window] = [True] * window
        out.append((doc, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def spark_removal(spark, rows, window):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit(1), "doc": F.lit("d"), "marks": F.lit(0)})
    found = substring_dedup.remove_repeats(df, window=window).collect()
    return sorted([(r[0], r[1], r[2], bytes(r[3])) for r in found], key=repr)


def passages(seed, docs, letters, lengths):
    """Texts put together from few passages, with single changed words."""
    rng = random.Random(seed)
    pool = [[rng.choice(letters) + str(rng.randint(0, 40)) for _ in range(rng.randint(*lengths))] for _ in range(12)]
    out = []
    for doc in range(docs):
        words = [w for _ in range(rng.randint(0, 6)) for w in rng.choice(pool)[rng.randint(0, 9) :]]
        words = [f"own{doc}" if rng.random() < 0.02 else w for w in words]
        out.append((doc - 5, rng.choice([" ", "\n", "\t "]).join(words)))
    return out


@pytest.mark.parametrize("window,lengths", [(10, (5, 40)), (50, (30, 160))])
def test_removal_agrees_with_plain_version(spark, window, lengths):
    rows = passages(window, 60, "abc", lengths)
    rows += [(None, rows[7][1]), (None, rows[7][1]), (3, rows[9][1]), (3, rows[9][1]), (50, None), (51, ""), (52, " \n"), (53, "short text")]
    # Texts of one word or of one line over and over branch at every edge, or nowhere.
    rows += [(60, "word " * 300), (61, "word " * 200), (62, "a b c d e f g\n" * 60), (63, "x " + "a b c d e f g\n" * 50), (64, "word " * 120 + "end")]
    random.Random(2).shuffle(rows)
    assert spark_removal(spark, rows, window) == plain_removal(rows, window)


def test_one_passage_in_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(70))
    rows = [(i, f"before{i} x{i} {passage} after{i}") for i in range(400)] + [(1000 + i, passage) for i in range(200)]
    assert spark_removal(spark, rows, 50) == plain_removal(rows, 50)


def test_removal_from_nothing_and_from_long_texts(spark):
    assert spark_removal(spark, [], 50) == []
    rng = random.Random(4)
    long = [f"w{rng.randint(0, 5000)}" for _ in range(60_000)]
    rows = [(2, " ".join(long)), (1, " ".join(long[20_000:45_000])), (3, " ".join(long[59_900:] + long[:100])), (4, "unique " * 10)]
    assert spark_removal(spark, rows, 50) == plain_removal(rows, 50)


def test_paths_hold_every_edge_once(monkeypatch):
    monkeypatch.setattr(substring_dedup, "PIECE", 100)
    rng = np.random.default_rng(1)
    hashed = word_hashes([b"w%d" % i for i in rng.integers(0, 50, 1000)])
    start, n, anchor, path = substring_dedup.paths(hashed, 20, 4)
    assert np.concatenate([np.arange(s, s + k) for s, k in zip(start, n)]).tolist() == list(range(981))
    assert path.tolist() == Runs(hashed)(start, start + n + 19).tolist()
    # The anchor of an edge follows from the edge alone.
    for s, k, a in zip(start, n, anchor):
        for at in range(s, s + k):
            assert substring_dedup.paths(hashed[at : at + 20], 20, 4)[2].tolist() == [a]


def test_spans_that_do_not_agree_stay(spark, monkeypatch):
    rows = passages(1, 30, "ab", (30, 120))
    real = substring_dedup.repeated_spans

    def with_false_ones(docs, *args):
        spans = real(docs, *args)
        names = {r["doc_id"]: r["row"] for r in docs.select("doc_id", substring_dedup._row_key("doc_id", "text").alias("row")).collect()}
        assert len(rows[20][1].split()) > 60
        false = [(names[rows[20][0]], 0, 3, names[rows[21][0]], 5)]
        return spans.unionByName(spark.createDataFrame(false, "row long, at long, size long, s_row long, s_at long"))

    monkeypatch.setattr(substring_dedup, "repeated_spans", with_false_ones)
    assert spark_removal(spark, rows, 50) == plain_removal(rows, 50)


# What several operators share


def test_components_joined_link_by_link(spark):
    from sparksignal.llm.components import connected_components, joined_components

    rng = random.Random(8)
    rounds = [[(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(40)] for _ in range(3)] + [[], [(5, 5)]]
    labels, seen = None, []
    for links in rounds:
        seen += links
        labels = joined_components(labels, spark.createDataFrame(links, "a long, b long"))
        whole = connected_components(spark.createDataFrame(seen, "a long, b long"))
        assert sorted(map(tuple, labels.collect())) == sorted(map(tuple, whole.collect()))


def test_forgotten_pre_tokens_are_encoded_again(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    from sparksignal.llm import bpe_text

    monkeypatch.setattr(bpe_text, "REMEMBERED", 20)
    path = public_tokenizers.path("byte_bpe_50k.json")
    bpe, library = bpe_text.BpeText(bpe_text.read_spec(path)), Tokenizer.from_file(path)
    rng = random.Random(2)
    for _ in range(60):
        texts = [" ".join(f"word{rng.randint(0, 60)}" for _ in range(rng.randint(0, 15))) for _ in range(4)]
        assert [np.frombuffer(e, "<u4").tolist() for e in bpe.encode(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts
        ]
        assert len(bpe.ids) < 20 + 4 * 16 * 4 and not getattr(bpe.ids.before, "before", None)


def test_heavy_and_light_keys_join_alike(spark):
    from sparksignal.llm.skew import join_per_key

    rows = [(0, i) for i in range(3000)] + [(k, k) for k in range(1, 1500)] + [(None, 1), (5000, 1)]
    left = spark.createDataFrame(rows, "k long, v long")
    per_key = spark.createDataFrame([(k, 3000 if k == 0 else 1, f"n{k}") for k in range(1500)], "k long, n long, name string")
    found = join_per_key(left, per_key, ["k"], "n").select("k", "v", "name").collect()
    assert sorted(map(tuple, found)) == sorted((k, v, f"n{k}") for k, v in rows if k is not None and k < 1500)
    assert join_per_key(left, per_key.limit(0), ["k"], "n").collect() == []


def test_parts_and_their_characters_are_those_of_the_library():
    from sparksignal.llm import bpe_text, queries

    bpe = bpe_text.BpeText(bpe_text.read_spec(queries.tokenizer_file("byte_bpe_50k.json")))
    texts = ["don't we'll 've'd '9's ''s '\n's it's", " a\tb\x7f\x00 c'É 're x", "É's naïve  12a '  'mm"]
    for text in texts:
        parts = bpe.pre_tokens(text)
        wanted = bpe.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        assert parts == [text[a:b] for _, (a, b) in wanted]
        assert [bpe_text._as_characters(p) for p in parts] == [characters for characters, _ in wanted]
