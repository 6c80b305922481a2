"""Byte-level BPE by distinct pre-tokens.

No token reaches over a pre-token's end, so a text's ids are its pre-tokens'
ids in a row, and each distinct pre-token is encoded once per worker.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array

#: Distinct pre-tokens of a generation; a worker remembers two generations.
REMEMBERED = 600_000

_BLANKS = r" \t\n\x0b\x0c\r"


def _latin(letters: str) -> tuple[re.Pattern, re.Pattern]:
    """For texts of ASCII and these letters alone: what such a text looks like, and its pre-tokens.

    Words, which are most of a text, are tried before the endings behind an apostrophe: none of them starts like the
    other. The blank that most words begin with is fixed, so one look tells whether to go on.
    """
    split = (
        rf" [{letters}]+|[{letters}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_BLANKS}{letters}0-9]+"
        rf"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+"
    )
    return re.compile(rf"[\x00-\x7f{letters}]*"), re.compile(split)


# The byte-level pre-tokenizer's pattern for Latin letters. Letters below 256 are found faster.
_SPLITS = [_latin("a-zA-ZÀ-ÖØ-öø-ÿ"), _latin("a-zA-ZÀ-ÖØ-öø-ɏ")]

#: Byte-level tokenizers write printable bytes as they are and the others, in order, as the characters from 256 on.
_PRINTED = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_AS_CHARACTERS = "".join(chr(b) if b in _PRINTED else chr(256 + _OTHERS.index(b)) for b in range(256))


def _as_characters(part: str) -> str:
    """A pre-token's bytes as the characters that stand for them."""
    return codecs.charmap_decode(part.encode(), "strict", _AS_CHARACTERS)[0]


class _Remembered(dict):
    """Ids by pre-token, of those asked for since the generation began; asks the one before, then ``find``."""

    def __init__(self, find, before: dict | None = None):
        super().__init__()
        self.find, self.before = find, before or {}

    def __missing__(self, part: str) -> bytes:
        ids = self.before.get(part)
        if ids is None:
            ids = array("I", self.find(part)).tobytes()
        self[part] = ids
        return ids

    def next(self) -> _Remembered:
        """A new generation, before which is this one; what the last had and this one did not ask for is forgotten."""
        self.before = {}
        return _Remembered(self.find, self)


class BpeText:
    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        loaded = json.loads(spec)
        added = loaded.get("added_tokens") or []
        pre = loaded.get("pre_tokenizer") or {}
        #: Whether a text's ids are known to be its pre-tokens' ids.
        self.may_split = (
            pre.get("type") == "ByteLevel"
            and bool(pre.get("use_regex", True))
            and not pre.get("add_prefix_space")
            and loaded.get("normalizer") is None
            and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        )
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        self._added_ids = {t["content"]: t["id"] for t in added}
        self._model = self.tokenizer.model
        self.ids = _Remembered(self.part_ids)

    def pre_tokens(self, text: str) -> list[str]:
        """Pre-tokens as they stand in the text; a special string is one of them."""
        if not self.may_split:
            raise ValueError("pre-tokens are known for byte-level tokenizers only")
        out: list[str] = []
        for k, part in enumerate(self._added.split(text) if self._added else [text]):
            if k % 2:
                out.append(part)
                continue
            split = next((split for plain, split in _SPLITS if plain.fullmatch(part)), None)
            if split:
                out += split.findall(part)
            else:
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def part_ids(self, part: str) -> list[int]:
        """Ids of one pre-token."""
        if part in self._added_ids:
            return [self._added_ids[part]]
        return [t.id for t in self._model.tokenize(_as_characters(part))]

    def counts(self, parts: list[str]) -> list[int]:
        """Number of ids of each pre-token."""
        return [len(self.part_ids(p)) for p in parts]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit integers."""
        if not self.may_split:
            return [array("I", e.ids).tobytes() for e in self._batch(texts)]
        if len(self.ids) > REMEMBERED:
            self.ids = self.ids.next()
        get = self.ids.__getitem__
        return [b"".join(map(get, self.pre_tokens(t))) for t in texts]

    def _batch(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)


_LOADED: dict[int, BpeText] = {}


def loaded(spec: str) -> BpeText:
    """The tokenizer of this worker, kept between its tasks."""
    key = hash(spec)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = BpeText(spec)
    return _LOADED[key]


def read_spec(path: str) -> str:
    """The tokenizer file's text, read on the driver and sent to the workers."""
    with open(path, encoding="utf-8") as f:
        return f.read()
