"""Operators on single texts against brute force: counts, windows, licenses, languages, ids."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparksignal.llm import queries
from sparksignal.llm.decontaminate import drop_contaminated, remove_spans, scan_texts, with_hit_counts
from sparksignal.llm.language_id import Model, identify, identify_languages, learn, viterbi
from sparksignal.llm.license_scan import Rule, license_summary, scan_licenses, signature_rules, suppress
from sparksignal.llm.piece_codec import encode_pieces
from sparksignal.llm.token_counts import token_counts
from sparksignal.llm.token_files import read_token_files, token_index, write_token_files

from .fixtures import SF, WORD, odd_docs, texts_of

BYTE_BPE = queries.tokenizer_file("byte_bpe_50k.json")
PIECES = queries.tokenizer_file("piece_bpe_32k.model")


def byte_bpe():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTE_BPE)


def pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.mark.parametrize("head", [1 << 18, 3])
def test_token_counts_equal_the_library(spark, head):
    docs = odd_docs(spark)
    got = sorted(map(tuple, token_counts(docs, BYTE_BPE, head_pieces=head).collect()), key=str)
    bpe = byte_bpe()
    want = [
        (r["doc_id"], len((r["text"] or "").encode()), len(bpe.encode(r["text"] or "", add_special_tokens=False).ids))
        for r in docs.collect()
    ]
    assert got == sorted(want, key=str)


def test_token_counts_query(spark):
    got = {r["doc_id"]: r for r in queries.op1_token_counts(spark, SF).collect()}
    bpe = byte_bpe()
    for doc, text in texts_of(spark):
        n = len(bpe.encode(text or "", add_special_tokens=False).ids)
        assert (got[doc]["n_tokens"], got[doc]["over_limit"]) == (n, n > 1024)


def test_pieces_equal_the_library(spark):
    docs = odd_docs(spark)
    sp = pieces()
    got = sorted(((r["doc_id"], r["ids"], r["decoded"]) for r in encode_pieces(docs, PIECES).collect()), key=str)
    want = []
    for r in docs.collect():
        ids = sp.encode(r["text"] or "")
        want.append((r["doc_id"], ids, sp.decode(ids) if ids else ""))
    assert got == sorted(want, key=str)


def test_pieces_of_random_texts():
    from sparksignal.llm.piece_codec import PieceCodec, read_model

    codec, sp, draw = PieceCodec(read_model(PIECES)), pieces(), random.Random(3)
    alphabet = ["a", "aa", "  ", "th", "he", "e", "r", "ing", "中", "é", " ", " the", "\0", "==", "\n", "😀", "▁", "1", "23"]
    for _ in range(3000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randint(0, 25)))
        assert np.frombuffer(codec.encode(text), "<i4").tolist() == sp.encode(text)


def test_pieces_query(spark):
    got = {r["doc_id"]: r for r in queries.op8_sentencepiece(spark, SF).collect()}
    sp = pieces()
    for doc, text in texts_of(spark):
        ids = sp.encode(text or "")
        assert got[doc]["n_tokens"] == len(ids)
        assert got[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[doc]["decoded_sha256"] == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_token_files_round_trip(spark, tmp_path):
    docs = odd_docs(spark)
    path = str(tmp_path / "ids")
    write_token_files(docs.repartition(3), path, BYTE_BPE, end_id=2)
    bpe = byte_bpe()
    stored = read_token_files(spark, path).orderBy("part", "local_start").collect()
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in stored]
    assert keys == sorted(keys)
    want = [(r["doc_id"], [*bpe.encode(r["text"] or "", add_special_tokens=False).ids, 2]) for r in docs.collect()]
    assert sorted(((r["doc_id"], list(r["ids"])) for r in stored), key=str) == sorted(want, key=str)
    index = sorted(token_index(spark, path).collect(), key=lambda r: r["start"])
    at = 0
    for r, s in zip(index, stored, strict=True):
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (s["doc_id"], at, len(s["ids"]))
        assert r["ids_crc32"] == zlib.crc32(np.array(s["ids"], "<u4").tobytes())
        at += len(s["ids"])
    one = read_token_files(spark, path).where("doc_id = 5").select("ids")
    assert one.count() == sum(1 for r in stored if r["doc_id"] == 5)


def test_token_files_query(spark):
    got = sorted(queries.op9_token_files(spark, SF).collect(), key=lambda r: r["doc_id"])
    bpe, at = byte_bpe(), 0
    for r, (doc, text) in zip(got, sorted(texts_of(spark)), strict=True):
        ids = [*bpe.encode(text or "", add_special_tokens=False).ids, 2]
        want = (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == want
        at += len(ids)


def brute_hits(text, items, size):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    hit, found = set(), set()
    for item, item_text in items:
        item_words = WORD.findall((item_text or "").lower())
        k = min(size, len(item_words))
        windows = {tuple(item_words[a : a + k]) for a in range(len(item_words) - k + 1)} if k else set()
        for a in range(len(words) - k + 1 if k else 0):
            if tuple(words[a : a + k]) in windows:
                hit.update(range(a, a + k))
                found.add(item)
    return words, hit, found


ITEMS = [
    (1, "one two three four five six seven"),
    (2, "Three four FIVE six"),
    (10, "alpha beta"),
    (10, "gamma"),
    (None, "no owner here at all"),
    (4, ""),
    (5, None),
    (6, "..."),
]
SCANNED = [
    (1, "Zero one, two three four five six seven eight"),
    (2, "alpha - beta gamma; alpha"),
    (3, None),
    (4, ""),
    (5, "nothing of the kind " * 40 + "gamma"),
    (5, "nothing of the kind " * 40 + "gamma"),
    (None, "no owner here at all"),
    (7, "é one two three four é"),
    (8, "one two three three four five"),
]


@pytest.mark.parametrize("block_words", [1 << 20, 9])
def test_windows_equal_brute_force(spark, block_words):
    docs = spark.createDataFrame(SCANNED, "doc_id long, text string").withColumn("item_id", F.lit(1))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit("x"))
    got = with_hit_counts(scan_texts(docs, items, window=4, block_words=block_words)).collect()
    assert len(got) == len(SCANNED)
    by_text = {r["text"]: r for r in got}
    for _, text in SCANNED:
        words, hit, found = brute_hits(text, ITEMS, 4)
        r = by_text[text]
        assert (r["n_words"], r["n_hit"]) == (len(words), len(hit))
        assert r["item_ids"] == sorted(i for i in found if i is not None)
        assert r["contaminated"] == (len(hit) > 0 and 20 * len(hit) >= len(words))


def test_contaminated_documents_and_spans_go(spark):
    docs = spark.createDataFrame(SCANNED, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = [r["doc_id"] for r in drop_contaminated(docs, items, window=4).collect()]
    assert sorted(kept) == [3, 4, 5, 5, 8]
    cut = {r["doc_id"]: r["text"] for r in remove_spans(docs, items, window=4).collect()}
    assert cut[1] == "Zero  eight"
    assert cut[2] == " - ; alpha" or cut[2] == "; alpha"
    assert cut[3] is None and cut[4] == ""
    assert cut[7] == "é  é"


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(SCANNED, "doc_id long, text string")
    assert scan_texts(docs, items).count() == 0
    assert with_hit_counts(scan_texts(some, items)).agg(F.sum("n_hit")).first()[0] == 0
    assert token_counts(docs, BYTE_BPE).count() == 0
    assert encode_pieces(docs, PIECES).count() == 0
    assert scan_licenses(docs).count() == 0
    assert identify_languages(docs, learn(docs.withColumn("lang", F.lit("en")))).count() == 0


def test_names_that_clash_are_refused(spark):
    docs = spark.createDataFrame([(1, "x", 2)], "doc_id long, text string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    with pytest.raises(ValueError, match="n_words"):
        scan_texts(docs, items)
    with pytest.raises(ValueError, match="lang_pred"):
        identify_languages(docs.withColumnRenamed("n_words", "lang_pred"), Model(["en"], None, None))


# Licenses


def brute_license(text, rules):
    words = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    joined = " ".join(words)
    found = []
    for rule in rules:
        for m in re.finditer(f"(?:^|(?<= ))(?:{rule.pattern})(?=$| )", joined):
            first = joined.count(" ", 0, m.start())
            found.append((first, first + m[0].count(" ") + 1, rule))
    found = sorted(set(found), key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label, d[2].pattern))
    kept = []
    for d in found:
        if not any(k[0] <= d[0] and d[1] <= k[1] for k in kept):
            kept.append(d)
    return words, sorted(kept, key=lambda d: (d[0], d[1], d[2].label))


LICENSED = [
    (1, "Licensed under the Apache License, Version 2.0. Released under the MIT License."),
    (2, "This work is licensed under the GNU General Public License, version 3."),
    (3, "CC BY-NC 4.0 and cc by; CC-BY-SA 3.0"),
    (4, "SPDX-License-Identifier: GPL-2.0-or-later MIT License mit license MITLicense mit licensé"),
    (4, "SPDX-License-Identifier: GPL-2.0-or-later MIT License mit license MITLicense mit licensé"),
    (5, None),
    (6, ""),
    (None, "all rights reserved, GNU Lesser General Public License v2.1 or BSD 3-Clause License"),
    (8, "word " * 3000 + "mit license " * 200),
    (9, "Ich gehe mit dem Hund"),
]


def test_licenses_equal_brute_force(spark):
    rules = signature_rules()
    assert len(rules) > 300
    docs = spark.createDataFrame(LICENSED, "doc_id long, text string").withColumn("label", F.lit("x"))
    got = scan_licenses(docs).collect()
    assert len(got) == len(LICENSED)
    by_id = {r["doc_id"]: r for r in got}
    for doc, text in LICENSED:
        words, kept = brute_license(text, rules)
        r = by_id[doc]
        assert r["n_words"] == len(words)
        assert [(d["first"], d["end"], d["label"]) for d in r["detections"]] == [(a, b, x.label) for a, b, x in kept]
        places = sorted(
            (at, label)
            for phrase, label in (
                (("gnu", "general", "public", "license"), "gpl"),
                (("apache", "license"), "apache"),
                (("cc", "by"), "cc-by"),
                (("mit", "license"), "mit"),
            )
            for at in range(len(words))
            if tuple(words[at : at + len(phrase)]) == phrase
        )
        assert sorted((p["first"], p["label"]) for p in r["base"]) == places


def test_license_query_over_the_sample(spark):
    got = {r["doc_id"]: r for r in queries.op5_license_scan(spark, SF).collect()}
    rules = signature_rules()
    for doc, text in texts_of(spark):
        words, kept = brute_license(text, [r for r in rules if r.keyword in " ".join(WORD.findall((text or "").lower()))])
        r = got[doc]
        assert set(r["labels"].split(",")) - {""} >= {d[2].label for d in kept}
        assert r["score"] == max([d[2].priority for d in kept], default=0) / 100
        assert r["n_words"] == len(words)


def test_license_lines(spark):
    rows = {r["doc_id"]: r for r in license_summary(scan_licenses(spark.createDataFrame(LICENSED, "doc_id long, text string"))).collect()}
    assert (rows[1]["n_base"], rows[1]["first_word"], rows[1]["base_labels"]) == (2, 3, "apache,mit")
    assert rows[3]["labels"] == "cc-by,cc-by-nc-4.0,cc-by-sa-3.0"
    assert (rows[5]["n_base"], rows[5]["first_word"], rows[5]["base_labels"], rows[5]["score"]) == (0, None, "", 0.0)
    assert rows[9]["labels"] == ""


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so"""
BSD_TEXT = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
1. Redistributions of source code must retain the above copyright notice. 2. Redistributions in binary form must reproduce
the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution. """
ISC_TEXT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

# Texts and the labels a reader gives them; none is taken from the rules.
LABELLED = [
    ("GPL v3", "gpl-3"),
    ("the GPLv3", "gpl-3"),
    ("GPLv2+", "gpl-2"),
    ("GPL3", "gpl-3"),
    ("GPL-2.0-or-later", "gpl-2"),
    ("GNU General Public License v3.0", "gpl,gpl-3"),
    ("Apache License v2.0", "apache,apache-2.0"),
    ("Apache License, Version 2", "apache,apache-2.0"),
    ("Apache 2.0 License", "apache-2.0"),
    ("Apache v2", "apache-2.0"),
    ("an Apache v2.4 server", ""),
    ("LGPL v2.1", "lgpl-2.1"),
    ("LGPLv2.1+", "lgpl-2.1"),
    ("AGPLv3", "agpl-3"),
    ("MPL v2.0", "mpl-2.0"),
    ("MPLv2", "mpl-2.0"),
    ("CC BY-SA v4.0", "cc-by,cc-by-sa-4.0"),
    ("BSD-3-Clause", "bsd-3-clause"),
    ("BSD-2-Clause OR 0BSD", "0bsd,bsd-2-clause"),
    ("released under the GPL", "gpl"),
    ("available under MIT", "mit"),
    ("wir gehen mit v2 los", ""),
    ("under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License", "gpl,gpl-3"),
    ("permission is hereby granted, free of charge", "mit"),
    (MIT_TEXT + ", subject to the following conditions:", "mit"),
    (MIT_TEXT + ".", "mit-0"),
    (MIT_TEXT.replace("deal in", "deal with") + ", subject to", "ncsa"),
    ("redistribution and use in source and binary forms", "bsd"),
    (BSD_TEXT + "THIS SOFTWARE IS PROVIDED BY THE AUTHORS", "bsd,bsd-2-clause"),
    (BSD_TEXT + "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products derived from this software", "bsd,bsd-3-clause"),
    (ISC_TEXT + ", provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    (ISC_TEXT + ".", "0bsd"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "zlib"),
]


def test_common_forms_and_wordings_get_their_labels(spark):
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(LABELLED)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in license_summary(scan_licenses(docs)).collect()}
    assert {t: rows[k]["labels"] for k, (t, _) in enumerate(LABELLED)} == dict(LABELLED)
    assert all((rows[k]["score"] > 0) == bool(want) for k, (_, want) in enumerate(LABELLED))


def test_contained_detections_are_suppressed():
    low, high = Rule("low", "a", "a", 10), Rule("high", "b", "b", 20)
    kept = suppress([(0, 9, low), (2, 4, high), (3, 4, low), (8, 12, high), (2, 4, high)])
    assert [(a, b, r.label) for a, b, r in kept] == [(0, 9, "low"), (2, 4, "high"), (8, 12, "high")]


# Languages


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(5)
    for size, repeat in ((6, 40), (9, 10)):
        for _ in range(repeat):
            sizes = draw.integers(0, size, 4)
            first = np.concatenate([[0], np.cumsum(sizes)])
            scores = draw.normal(0, 2, (first[-1], 3)).astype(np.float32)
            paths = viterbi(scores, first, 1.5)
            for lo, hi in itertools.pairwise(first):
                best = max(worth(scores[lo:hi], p) for p in itertools.product(range(3), repeat=int(hi - lo)))
                assert worth(scores[lo:hi], paths[lo:hi]) == pytest.approx(best, abs=1e-5)


def worth(scores, path):
    return sum(scores[t, x] for t, x in enumerate(path)) - 1.5 * sum(a != b for a, b in itertools.pairwise(path))


def test_viterbi_over_several_blocks(monkeypatch):
    """Blocks of three words give the same values as one block."""
    draw = np.random.default_rng(6)
    scores = draw.normal(0, 2, (200, 4)).astype(np.float32)
    first = np.array([0, 0, 1, 50, 113, 200])
    whole = viterbi(scores, first, 1.5)
    monkeypatch.setattr("sparksignal.llm.language_id.BLOCK", 3)
    parts = viterbi(scores, first, 1.5)
    for lo, hi in itertools.pairwise(first):
        assert worth(scores[lo:hi], parts[lo:hi]) == pytest.approx(worth(scores[lo:hi], whole[lo:hi]), abs=1e-5)


def test_languages_of_mixed_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = learn(docs)
    english = docs.where("lang = 'en' and n_chars between 500 and 900").first()["text"]
    french = docs.where("lang = 'fr' and n_chars between 1500 and 2500").first()["text"]
    (lang, score, spans), = identify(model, [english + "\n" + french])
    assert lang == "fr" and 0.5 < score < 1
    assert [s["lang"] for s in spans] == ["en", "fr"]
    assert abs(spans[1]["first"] - len(english)) < 60
    odd = identify(model, [None, "", "123 ... 45", "Ж", "the"])
    assert [x[0] for x in odd[:3]] == ["und"] * 3 and [x[1] for x in odd[:3]] == [0.0] * 3
    assert all(x[0] in model.languages for x in odd[3:])
    rows = [(None, None), (1, "1 2"), (1, "1 2"), (2, english)]
    out = identify_languages(spark.createDataFrame(rows, "doc_id long, text string"), model)
    assert sorted(r["lang_pred"] for r in out.collect()) == ["en", "und", "und", "und"]


def test_scripts_narrow_candidates(spark):
    rows = [("en", "the cat and the dog"), ("ru", "кот и пёс дома"), ("el", "γάτα και σκύλος"), (None, "x"), ("en", None)]
    model = learn(spark.createDataFrame(rows, "lang string, text string"))
    found = identify(model, ["дом кот", "σκύλος", "cat кот пёс"])
    assert [f[0] for f in found] == ["ru", "el", "ru"]
    nothing = learn(spark.createDataFrame([], "lang string, text string"))
    assert identify(nothing, ["abc"]) == [("und", 0.0, [])]


def test_copies_of_a_text_do_not_change_the_model(spark):
    """A hot text counts once, and a language of few texts in many copies is learned."""
    texts = [("en", f"the word {k} and another", 1) for k in range(60)] + [("en", "a text that all repeat", 3000)]
    texts += [("fi", f"sana {k} ja toinen", 50) for k in range(40)]
    once = spark.createDataFrame([t[:2] for t in texts], "lang string, text string")
    counted = spark.createDataFrame(texts, "lang string, text string, n int")
    copies = counted.select("lang", "text", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    for per_language in (1, 5, 1000):
        one, many = learn(once, per_language=per_language), learn(copies, per_language=per_language)
        assert one.languages == many.languages == ["en", "fi"]
        assert np.array_equal(one.weights, many.weights) and np.array_equal(one.allowed, many.allowed)
        # A flat column of weights would mean a language without a text.
        assert (many.weights.max(axis=1) > many.weights.min(axis=1)).all()
    assert [f[0] for f in identify(many, ["the word", "sana ja toinen"])] == ["en", "fi"]


def test_held_out_accuracy(spark):
    got = queries.op6_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").collect()
    assert len(rows) > 20
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows)
