"""What a worker remembers of the units it has encoded."""

import numpy as np


def test_units_are_forgotten_generation_by_generation(monkeypatch):
    """A unit that is asked for again and again is encoded once, however many others come between."""
    from sparksignal.llm import piece_codec, queries

    monkeypatch.setattr(piece_codec, "REMEMBERED", 20)
    codec = piece_codec.PieceCodec(piece_codec.read_model(queries.tokenizer_file("piece_bpe_32k.model")))
    found = []
    one_unit = codec.units.find
    codec.units.find = lambda unit: found.append(unit) or one_unit(unit)
    texts = [f"always  here word{k} größe{k} 語{k}\t ▁{k}" for k in range(200)]
    for text in texts:
        assert np.frombuffer(codec.encode(text), "<i4").tolist() == codec.model.encode(text)
    assert found.count("▁always") + found.count("▁here") <= 2
    assert found.count("▁word7") == 1
    assert len(codec.units) + len(codec.units.before) <= 60
