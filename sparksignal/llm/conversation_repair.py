"""Repair of conversations whose turns break the order of speakers.

A conversation is repaired by the cheapest edits that leave the role initials
``(s?(ua)+)?``: rows are kept, given another role or deleted, and rows of empty
text are inserted. Costs come from a backward dynamic program over the rows,
with one cost for each state of that pattern.

A conversation of n rows is cut into pieces of about sqrt(n) rows, and the
backward cost vectors are stored at the ends of pieces only, the checkpoints.
To find them, each piece is reduced to a small matrix of costs from state to
state, all pieces side by side; a conversation's matrices, sqrt(n) of them, then
give its checkpoints. Walking forward, the vectors inside one piece at a time
are computed again from its checkpoint, and the edits follow: of those that
keep to the least cost, the one whose initial comes first in ASCII.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import column, record_batch
from .numbering import numbered
from .skew import join_per_key

#: Least rows of a piece; longer conversations have pieces of the square root of their rows.
PIECE = 64

#: Costs of the edits.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: States: nothing yet, after a system row, after a user row, after an assistant row.
_STATES = range(4)
_BEYOND = 1 << 40
#: The state an inserted or relabelled row leads to, and its role.
_NEXT = (2, 2, 3, 2)
_ROLES = {2: "user", 3: "assistant"}
#: State after keeping a row, by its initial.
_KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

# Codes of rows: blank, duplicate, or the initial (o: another one), in upper case where the text is truncated.
_BLANK, _DUPLICATE = "b", "d"

Vector = tuple[int, int, int, int]
#: Costs after the last row: nothing follows but insertions.
END: Vector = (0, 2 * INSERT, INSERT, 0)


def step(code: str, after: Vector) -> Vector:
    """Costs before a row, from those after it."""
    best = [DELETE + c for c in after]
    if code not in (_BLANK, _DUPLICATE):
        extra = TRUNCATED if code.isupper() else 0
        initial = code.lower()
        for q in _STATES:
            best[q] = min(best[q], extra + RELABEL + after[_NEXT[q]])
            kept = _KEPT[q].get(initial)
            if kept is not None:
                best[q] = min(best[q], extra + after[kept])
    user, assistant = min(best[2], INSERT + best[3]), min(best[3], INSERT + best[2])
    return min(best[0], INSERT + user), min(best[1], INSERT + user), user, assistant


def backward(codes: str, after: Vector) -> Vector:
    for code in reversed(codes):
        after = step(code, after)
    return after


def vectors(codes: str, after: Vector) -> list[Vector]:
    """Costs before each row of a piece and after its last one."""
    out = [after]
    for code in reversed(codes):
        out.append(step(code, out[-1]))
    return out[::-1]


def matrix(codes: str) -> list[int]:
    """Least cost from each state before a piece to each state after it, row by row."""
    ends = [backward(codes, tuple(0 if q == end else _BEYOND for q in _STATES)) for end in _STATES]
    return [ends[end][q] for q in _STATES for end in _STATES]


def before_piece(costs: list[int], after: Vector) -> Vector:
    return tuple(min(costs[4 * q + end] + after[end] for end in _STATES) for q in _STATES)


class Walk:
    """The forward walk through one conversation: a state, and the edits so far."""

    def __init__(self):
        self.state = 0

    def edits(self, code: str | None, here: Vector, after: Vector | None) -> Iterator[tuple[str, str | None]]:
        """(initial, new role) of the edits at a row, insertions before it included; None stands for the end."""
        while True:
            q, best = self.state, here[self.state]
            if code is not None and DELETE + after[q] == best:
                yield "D", None
                return
            if INSERT + here[_NEXT[q]] == best:
                self.state = _NEXT[q]
                yield "I", _ROLES[self.state]
                continue
            if code is None:
                return
            extra = TRUNCATED if code.isupper() else 0
            kept = _KEPT[q].get(code.lower())
            if kept is not None and extra + after[kept] == best:
                self.state = kept
                yield "K", None
            else:
                self.state = _NEXT[q]
                yield "R", _ROLES[self.state]
            return


_KEY = ["no_conv", "conv"]
_MATRIX = pa.schema([("no_conv", pa.bool_()), ("conv", pa.int64()), ("piece", pa.int64()), ("costs", pa.list_(pa.int64()))])
_ENDS = pa.schema([("no_conv", pa.bool_()), ("conv", pa.int64()), ("piece", pa.int64()), ("after", pa.list_(pa.int64()))])
_SUMMARY = pa.schema(
    [
        ("conv_id", pa.int64()),
        *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        ("audit", pa.string()),
        ("repaired_sha256", pa.string()),
    ]
)
_EDITS = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())]
)


def _sql(schema: pa.Schema) -> str:
    names = {"int64": "long", "bool": "boolean", "string": "string", "list<item: int64>": "array<long>"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def _matrices(batches):
    for batch in batches:
        yield record_batch(
            _MATRIX, column(batch, "no_conv"), column(batch, "conv"), column(batch, "piece"), [matrix(c) for c in column(batch, "codes")]
        )


def _checkpoints(batches):
    for batch in batches:
        for no_conv, conv, pieces in zip(*(column(batch, c) for c in ("no_conv", "conv", "pieces")), strict=True):
            after, ends = END, []
            for p in reversed(pieces):
                ends.append((p["piece"], list(after)))
                after = before_piece(p["costs"], after)
            yield record_batch(_ENDS, [no_conv] * len(ends), [conv] * len(ends), *zip(*ends, strict=True))


class _Conversation:
    """What a walk gathers: counts, the edits' initials and the digest of the repaired rows."""

    def __init__(self, key):
        self.key, self.walk = key, Walk()
        self.place = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.first = self.last = None
        self.turns = 0
        self.before = None
        self.audit: list[str] = []
        self.digest, self.empty = hashlib.sha256(), True

    def piece(self, codes: str, after: list[int]):
        self.codes, self.ends, self.at = codes, vectors(codes, tuple(after)), 0
        if not self.place:
            self.cost = self.ends[0][0]

    def _written(self, role: str, text: str):
        self.digest.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode())
        self.empty = False

    def row(self, turn, role: str, text: str) -> list[tuple]:
        code, here, after = self.codes[self.at], self.ends[self.at], self.ends[self.at + 1]
        self.at += 1
        self.place += 1
        self.blank += code == _BLANK
        self.duplicate += code == _DUPLICATE
        self.truncated += code.isupper()
        if turn is not None and turn != self.last:
            self.turns, self.last = self.turns + 1, turn
            self.first = turn if self.first is None else self.first
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        out = []
        for edit, new in self.walk.edits(code, here, after):
            out.append((edit, turn, new or role, "" if edit == "I" else text))
        self._take(out)
        return out

    def _take(self, edits: list[tuple]):
        for edit, _, role, text in edits:
            self.audit.append(edit)
            if edit != "D":
                self._written(role, text)

    def end(self) -> list[tuple]:
        out = [(edit, None, new, "") for edit, new in self.walk.edits(None, END, None)]
        self._take(out)
        return out

    def summary(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (None if self.key[0] else self.key[1], *counts, "".join(self.audit), self.digest.hexdigest())


def _walked(batches, finished):
    """Edits, in order, of sorted conversations; each conversation is handed to ``finished`` at its end."""
    open_one: _Conversation | None = None
    for batch in batches:
        columns = [column(batch, c) for c in ("no_conv", "conv", "turn", "role", "text", "codes", "after")]
        edits = []
        for no_conv, conv, turn, role, text, codes, after in zip(*columns, strict=True):
            if open_one is None or open_one.key != (no_conv, conv):
                if open_one:
                    edits += [(open_one.key, e) for e in open_one.end()]
                    finished(open_one)
                open_one = _Conversation((no_conv, conv))
            if codes is not None:
                open_one.piece(codes, after)
            else:
                edits += [(open_one.key, e) for e in open_one.row(turn, role, text)]
        yield edits
    if open_one:
        last = [(open_one.key, e) for e in open_one.end()]
        finished(open_one)
        yield last


def _summaries(batches):
    done: list[_Conversation] = []
    for _ in _walked(batches, done.append):
        if done:
            yield record_batch(_SUMMARY, *zip(*[c.summary() for c in done], strict=True))
            done.clear()


def _edit_rows(batches):
    key, place = None, 0
    for edits in _walked(batches, lambda _: None):
        out = []
        for owner, (edit, turn, role, text) in edits:
            key, place = (key, place + 1) if owner == key else (owner, 0)
            out.append((None if owner[0] else owner[1], place, edit, turn, role, text))
        if out:
            yield record_batch(_EDITS, *zip(*out, strict=True))


# White space of ASCII.
_BLANKS = " \t\n\x0b\x0c\r"


def _ordered(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows with pos and total in their conversation; what is NULL in role or text is one blank."""
    conv = F.col(id_col).cast("long")
    rows = conversations.select(
        conv.isNull().alias("no_conv"),
        F.coalesce(conv, F.lit(0)).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )
    return cut_lineage(numbered(rows.withColumn("print", F.md5("text")), _KEY, ["turn", "role", "print"]))


def _pieces(rows: DataFrame) -> DataFrame:
    """(conversation, piece, total, size, codes): a character for each row."""
    end = F.rtrim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    size = F.greatest(F.lit(PIECE), F.ceil(F.sqrt("total"))).cast("long")
    facts = rows.select(
        *_KEY,
        "pos",
        "total",
        size.alias("size"),
        F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")).alias("said"),
        F.when(end == "", F.lit(_BLANK))
        .when(F.right(end, F.lit(1)).isin(".", "!", "?"), known)
        .otherwise(F.upper(known))
        .alias("code"),
    )
    facts = cut_lineage(facts)
    first = cut_lineage(facts.groupBy(*_KEY, "said").agg(F.min("pos").alias("first"), F.count("*").alias("times")))
    again = (F.col("pos") > F.col("first")) & (F.col("code") != _BLANK)
    coded = join_per_key(facts, first, [*_KEY, "said"], "times").withColumn("code", F.when(again, F.lit(_DUPLICATE)).otherwise(F.col("code")))
    letters = F.array_sort(F.collect_list(F.struct("pos", "code")))
    return coded.groupBy(*_KEY, F.floor(F.col("pos") / F.col("size")).alias("piece"), "total", "size").agg(
        F.array_join(F.transform(letters, lambda x: x["code"]), "").alias("codes")
    )


def _with_checkpoints(pieces: DataFrame) -> DataFrame:
    """Pieces with the cost vector after their last row."""
    whole = F.col("total") <= F.col("size")
    end = F.array(*[F.lit(c).cast("long") for c in END])
    several = pieces.where(~whole)
    costs = several.select(*_KEY, "piece", "codes").mapInArrow(_matrices, _sql(_MATRIX))
    # sqrt(n) pieces of a conversation of n rows, 16 numbers each.
    chains = costs.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("piece", "costs"))).alias("pieces"))
    ends = chains.mapInArrow(_checkpoints, _sql(_ENDS))
    return pieces.where(whole).withColumn("after", end).unionByName(several.join(ends, [*_KEY, "piece"]).select(*pieces.columns, "after"))


def _stream(conversations: DataFrame, **columns: str) -> DataFrame:
    """Pieces, each followed by its rows, conversation after conversation."""
    rows = _ordered(conversations, **columns)
    pieces = cut_lineage(_with_checkpoints(cut_lineage(_pieces(rows))))
    marks = pieces.select(
        *_KEY,
        (F.col("piece") * F.col("size")).alias("pos"),
        F.lit(0).alias("kind"),
        F.lit(None).cast("long").alias("turn"),
        F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("string").alias("text"),
        "codes",
        "after",
    )
    said = rows.select(
        *_KEY, "pos", F.lit(1).alias("kind"), "turn", "role", "text", F.lit(None).cast("string").alias("codes"),
        F.lit(None).cast("array<long>").alias("after"),
    )
    return marks.unionByName(said).repartition(*_KEY).sortWithinPartitions(*_KEY, "pos", "kind")


def _named(id_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> dict[str, str]:
    return {"id_col": id_col, "turn_col": turn_col, "role_col": role_col, "text_col": text_col}


def repair_summary(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    Rows stand in order of turn, NULL first, then role, then the digest of the
    text. NULL roles and texts are one blank; rows of a NULL id are one conversation.
    A row's first fault counts: blank, duplicate (role and text seen earlier),
    truncated (the last character that is no white space is none of ``.!?``). gaps
    counts the missing turn numbers, illegal the neighbouring initials that may not
    follow each other. ``audit`` has the edits' initials, the digest is that of the
    repaired ``role:text``, joined by line ends; without rows it is that of nothing.
    An empty table gives no rows; other columns take no part.

    A conversation may be of any length: it is read as a stream, piece by piece.
    Its digest is a chain, so the last pass over one conversation is one task.
    """
    return _stream(conversations, **_named(**columns)).mapInArrow(_summaries, _sql(_SUMMARY))


def repair_edits(conversations: DataFrame, **columns: str) -> DataFrame:
    """(conv_id, place, edit, turn, role, text): all edits in order, with the rows as repaired; see ``repair_summary``.

    Deleted rows are among them, with edit ``D``; inserted rows have the turn of
    the row they precede, NULL at the end.
    """
    return _stream(conversations, **_named(**columns)).mapInArrow(_edit_rows, _sql(_EDITS))
