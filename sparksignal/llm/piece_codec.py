"""SentencePiece BPE encoding by a prefix table, and decoding.

For every prefix of a text the last token of its encoding is unique. It is
found among the vocabulary's automaton matches that end there: a match of
length k is the last token exactly if it can follow the last token of the
prefix k characters shorter. Two tokens can stand side by side exactly if
undoing their merges, latest first, never meets a merge across the boundary
that would have been made earlier. The ids are read from the table backwards.

No piece holds white space after another character, so texts are cut before
each run of white space, and each distinct unit is encoded once per worker as
long as it is asked for: units are forgotten generation by generation.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, record_batch

SPACE = "▁"
#: Distinct units of a generation; a worker remembers two generations.
REMEMBERED = 250_000
#: Pairs of tokens a worker remembers before it starts anew.
PAIRS = 800_000
#: Units from this length on are not remembered.
LONG = 200

_ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded string"
_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
)


class _After(dict):
    """Whether a token can follow this one, for the tokens asked about so far."""

    def __init__(self, codec: PieceCodec, token: int):
        super().__init__()
        self.codec, self.token = codec, token

    def __missing__(self, token: int) -> bool:
        fits = self[token] = self.codec._pair(self.token, token)
        return fits


class _Units(dict):
    """Ids by unit, without its first blank, of those asked for since the generation began; asks the one before, then ``find``."""

    def __init__(self, find, before: dict | None = None):
        super().__init__()
        self.find, self.before = find, before or {}

    def __missing__(self, rest: str) -> bytes:
        ids = self.before.get(rest)
        if ids is None:
            ids = self.find(SPACE + rest)
            if len(rest) >= LONG:
                return ids
        self[rest] = ids
        return ids

    def next(self) -> _Units:
        """A new generation, before which is this one; what the last had and this one did not ask for is forgotten."""
        self.before = {}
        return _Units(self.find, self)


class PieceCodec:
    def __init__(self, model: bytes):
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.model.get_piece_size()
        self.bytes = {}
        ranked = []
        self.text: dict[int, str] = {}
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_unused(i)):
                self.text[i] = piece
                if len(piece) > 1:
                    ranked.append((-self.model.get_score(i), i))
        self.unknown = self.model.unk_id()
        #: Merges are made in this order; single characters have none.
        self.rank = {i: k for k, (_, i) in enumerate(sorted(ranked))}
        self.id_of = {piece: i for i, piece in self.text.items()}
        self.may_cut = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.text.values())
        self.halves: dict[int, tuple[int, int]] = {}
        #: Rank of the merge of two neighbours, where it makes a piece.
        self.merges = {
            (self.id_of[p[:k]], self.id_of[p[k:]]): self.rank[i]
            for i in self.rank
            for p in (self.text[i],)
            for k in range(1, len(p))
            if p[:k] in self.id_of and p[k:] in self.id_of
        }
        #: For each piece made by a merge: the merge's rank and its two halves.
        self.undone: dict[int, tuple[int, int, int]] = {}
        self.after = {i: _After(self, i) for i in self.text}
        self.n_pairs = 0
        #: What follows where a unit or an unknown character has ended, and where no encoding ends.
        self.all_fit, self.none_fits = dict.fromkeys(self.text, True), dict.fromkeys(self.text, False)
        self.units = _Units(self._unit)
        #: Characters that are pieces.
        self.known = frozenset(p for p in self.id_of if len(p) == 1)
        self._find_halves()
        self.matches = ahocorasick.Automaton()
        for i, piece in self.text.items():
            if len(piece) == 1 or i in self.halves:
                self.matches.add_word(piece, (len(piece), i))
        self.matches.make_automaton()
        #: Unknown characters become their bytes if the model has them all, else one unknown token.
        self.fallback = len(self.bytes) == 256

    def _find_halves(self) -> None:
        """The last merge behind each piece, shortest pieces first; pieces no merge leads to have none."""
        for i in sorted(self.rank, key=lambda i: len(self.text[i])):
            piece = self.text[i]
            for k in range(1, len(piece)):
                left, right = self.id_of.get(piece[:k]), self.id_of.get(piece[k:])
                if left is None or right is None:
                    continue
                if all(len(self.text[t]) == 1 or t in self.halves for t in (left, right)):
                    if self._adjacent(left, right, self.rank[i]):
                        self.halves[i] = (left, right)
                        self.undone[i] = (self.rank[i], left, right)
                        break

    def _adjacent(self, left: int, right: int, until: int | None = None) -> bool:
        """Whether the two tokens stay apart through all merges, or through those before rank ``until``.

        The merges that built the two tokens are undone from the latest to the
        earliest. Each state lasted until the merge undone last, and a merge
        over the boundary must not have been due before that. At equal ranks the
        merge further left goes first.
        """
        merges, undone = self.merges, self.undone
        # Times count in thirds of a rank: a merge left of the boundary, over it, right of it.
        end = 1 << 60 if until is None else 3 * until + 1
        while True:
            over = merges.get((left, right))
            if over is not None and 3 * over + 1 < end:
                return False
            made_left, made_right = undone.get(left), undone.get(right)
            if made_right is not None and (made_left is None or made_right[0] >= made_left[0]):
                end, right = 3 * made_right[0] + 2, made_right[1]
            elif made_left is not None:
                end, left = 3 * made_left[0], made_left[2]
            else:
                return True

    def _pair(self, left: int, right: int) -> bool:
        if self.n_pairs >= PAIRS:
            for after in self.after.values():
                after.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        return self._adjacent(left, right)

    def _last(self, unit: str, ends: list[int]) -> list[tuple[int, int] | None]:
        """Length and id of the last token of each prefix; after the prefixes that end at ``ends`` any token fits."""
        last: list[tuple[int, int] | None] = [None] * len(unit)
        # Which tokens can follow each prefix; behind all others, found as place -1, stands the empty one.
        follow = [self.none_fits] * len(unit) + [self.all_fit]
        for at in ends:
            follow[at] = self.all_fit
        after = self.after
        for at, found in self.matches.iter(unit):
            if last[at] is None:
                size, token = found
                if follow[at - size][token]:
                    last[at] = found
                    follow[at] = after[token]
        return last

    def _unit(self, unit: str) -> bytes:
        """Ids of one unit as little-endian integers."""
        last = self._last(unit, [])
        # The whole unit has a last token unless it holds a character that is no piece.
        if last[-1] is None:
            last = self._last(unit, [at for at, char in enumerate(unit) if char not in self.known])
        ids: list[int] = []
        at = len(unit) - 1
        while at >= 0:
            found = last[at]
            if found is None:
                ids.extend(self._outside(unit[at])[::-1])
                at -= 1
            else:
                size, token = found
                ids.append(token)
                at -= size
        ids.reverse()
        return array("i", ids).tobytes()

    def _outside(self, char: str) -> list[int]:
        """Ids of a character that is no piece."""
        return [self.bytes[b] for b in char.encode()] if self.fallback else [self.unknown]

    def normalized(self, text: str) -> str:
        return self.model.normalize(text) if text else ""

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        clean = self.normalized(text)
        if not clean:
            return b""
        if not self.may_cut:
            return self._unit(clean)
        if len(self.units) > REMEMBERED:
            self.units = self.units.next()
        if SPACE * 2 in clean:
            # Only the first blank of a run begins a unit; the others stay with what follows them.
            head, *rest = re.split(f"(?<!{SPACE}){SPACE}", clean)
        else:
            head, *rest = clean.split(SPACE)
        return (self._unit(head) if head else b"") + b"".join(map(self.units.__getitem__, rest))

    def decode(self, ids: list[int]) -> str:
        return self.model.decode(ids)


_LOADED: dict[int, PieceCodec] = {}


def loaded(model: bytes) -> PieceCodec:
    """The codec of this worker, kept between its tasks."""
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = PieceCodec(model)
    return _LOADED[key]


def read_model(path: str) -> bytes:
    """The model file, read on the driver and sent to the workers."""
    with open(path, "rb") as f:
        return f.read()


def _lists(parts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    sizes = np.array([len(p) // 4 for p in parts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    flat = np.frombuffer(b"".join(parts), "<i4")
    return sizes, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def _round_trip(model):
    def run(batches):
        codec = loaded(model.value)
        for batch in batches:
            parts = [codec.encode(t) if t else b"" for t in column(batch, "text")]
            sizes, lists = _lists(parts)
            decoded = [codec.decode(np.frombuffer(p, "<i4").tolist()) if p else "" for p in parts]
            yield record_batch(_ROWS, batch.column(0), sizes, lists, decoded)

    return run


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids of every whole text and the text decoded from them.

    A NULL text is empty: no ids, decoded to an empty text. Rows are handled one
    by one, so repeated rows and NULL ids stay as they are; other columns take no part.
    """
    model = docs.sparkSession.sparkContext.broadcast(read_model(model_path))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_round_trip(model), _ENCODED)
