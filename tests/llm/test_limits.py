"""What bounds the operators: how vectors travel, what workers remember."""

import numpy as np

from sparksignal.llm import embedding_dedup
from sparksignal.llm.embedding_dedup import near_duplicates


def test_vectors_of_any_magnitude_meet(spark):
    """Sign patterns come from vectors of length one: raw sums of the largest doubles are no numbers."""
    draw = np.random.default_rng(3)
    base = np.clip(draw.standard_normal((20, 64)), -1, 1)
    rows = [(2 * k + far, (v * (1.7e308 if far else 1e-300)).tolist(), 1) for k, v in enumerate(base) for far in (0, 1)]
    got = near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted(map(tuple, got)) == [(i, 1, i // 2 * 2, i % 2 == 0) for i in range(40)]


def test_vectors_reach_buckets_as_bytes(spark, monkeypatch):
    """Not as lists, which a worker would turn into one Python object per number and bucket."""
    seen = spark.sparkContext.accumulator(0)
    links = embedding_dedup._links

    def watched(*args):
        run = links(*args)

        def look(group):
            seen.add(any(str(f.type).startswith("list") for f in group.schema))
            return run(group)

        return look

    monkeypatch.setattr(embedding_dedup, "_links", watched)
    rows = [(k, [1.0, k * 1e-4, 0.5], 0) for k in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r["n_links"] for r in near_duplicates(df).collect()} == {49}
    assert seen.value == 0


def test_pre_tokens_of_latin_texts_equal_the_library():
    """Letters below and above 256, blanks of all kinds and endings behind apostrophes."""
    from sparksignal.llm import bpe_text, queries

    bpe = bpe_text.BpeText(bpe_text.read_spec(queries.tokenizer_file("byte_bpe_50k.json")))
    draw = np.random.default_rng(7)
    for letters in ("aZé ÿ09'slt\t\n.-", "aZé ɏĀ09'slt\t\n.-", "aª×÷ſ'  ǅɐ"):
        for _ in range(300):
            text = "".join(draw.choice(list(letters + "  "), draw.integers(0, 25)))
            want = [text[a:b] for _, (a, b) in bpe.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
            assert bpe.pre_tokens(text) == want
    assert len([plain for plain, _ in bpe_text._SPLITS if plain.fullmatch("größe")]) == 2
