"""Language identification of mixed texts.

Words are scored for every language by hashed character n-grams learned from
labelled documents. The script of a word leaves only the languages seen in
that script. Viterbi over the words of a text, with a penalty for each switch,
labels spans; the language with the most letters is the text's.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, record_batch, slices

UNDETERMINED = "und"
#: Different labelled texts read per language, about; which ones is decided by a hash of the text.
SAMPLE_PER_LANGUAGE = 4_000
#: Hash buckets per n-gram length.
BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
#: Cost of a change of language, in nats.
SWITCH = 8.0
#: Share of a language's letters that a script must reach to count as one of its scripts.
SCRIPT_SHARE = 0.01

# Code point ranges of scripts, by first and last code point.
SCRIPTS = (
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("ethiopic", 0x1200, 0x137F),
    ("khmer", 0x1780, 0x17FF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
)
SCRIPT_NAMES = ("other", *dict.fromkeys(name for name, _, _ in SCRIPTS))


@cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether it is a letter, and its script."""
    letter = np.array([chr(i).isalpha() for i in range(0x110000)])
    script = np.zeros(0x110000, np.uint8)
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, script


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, letters: np.ndarray):
    """(order, positions, buckets): the n-grams that end at each position.

    Non-letters are one boundary mark; a gram may begin or end with it but not
    hold it inside, and holds a letter. The mark after a word belongs to it.
    """
    marked = np.where(letters, codes, 0).astype(np.uint32)
    hashed = np.zeros(len(marked), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        rolled = np.zeros(len(marked), np.uint32)
        if order > 1:
            rolled[1:] = hashed[:-1]
        hashed = (rolled + np.uint32(1)) * np.uint32(0x9E3779B1) + marked
        if order not in ORDERS:
            continue
        valid = letters.copy() if order == 1 else np.ones(len(marked), bool)
        valid[: order - 1] = False
        for inner in range(1, order - 1):
            valid[order - 1 :] &= letters[order - 1 - inner : len(letters) - inner]
        if order == 2:
            valid[1:] &= letters[1:] | letters[:-1]
        at = np.flatnonzero(valid)
        h = hashed[at]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(12)
        yield order, at, (h % np.uint32(BUCKETS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    #: log-probability of each n-gram bucket, per order: (orders, buckets, languages)
    weights: np.ndarray
    #: languages seen in each script: (scripts, languages)
    allowed: np.ndarray


def _separate(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with a mark before and after each, whether they are letters, and where texts begin."""
    parts, starts, at = [np.zeros(1, np.uint32)], [], 1
    for t in texts:
        codes = code_points(t) if t else np.zeros(0, np.uint32)
        starts.append(at)
        parts += [codes, np.zeros(1, np.uint32)]
        at += len(codes) + 1
    codes = np.concatenate(parts)
    return codes, _characters()[0][np.minimum(codes, 0x10FFFF)], np.array([*starts, at], np.int64)


def _counts(batches):
    """Per language: counts of n-gram buckets and of letters in each script (order 0)."""
    totals: dict[str, dict[int, np.ndarray]] = {}
    for batch in batches:
        by_language: dict[str, list[str]] = {}
        for lang, text in zip(column(batch, "lang"), column(batch, "text"), strict=True):
            by_language.setdefault(lang, []).append(text)
        for lang, texts in by_language.items():
            own = totals.setdefault(
                lang, {0: np.zeros(len(SCRIPT_NAMES), np.int64)} | {n: np.zeros(BUCKETS, np.int64) for n in ORDERS}
            )
            codes, letters, _ = _separate(texts)
            own[0] += np.bincount(_characters()[1][codes[letters]], minlength=len(SCRIPT_NAMES))
            for order, _, buckets in _grams(codes, letters):
                own[order] += np.bincount(buckets, minlength=BUCKETS)
    schema = pa.schema([("lang", pa.string()), ("order", pa.int32()), ("bucket", pa.int32()), ("n", pa.int64())])
    for lang, own in totals.items():
        for order, values in own.items():
            at = np.flatnonzero(values)
            yield record_batch(schema, [lang] * len(at), [order] * len(at), at.astype(np.int32), values[at])


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learn from rows with a language and a text.

    About ``per_language`` different texts of each language are read, chosen by
    a hash of the text, so that the model's cost does not depend on the input's
    size. A text counts once however often it repeats, and every language has one
    text at least. The model holds a fixed number of weights per language.
    """
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    scale = 1 << 40
    place = F.pmod(F.xxhash64("text"), F.lit(scale))
    # Only hashes are dealt out here; copies of a text are one row.
    found = rows.select("lang", place.alias("at")).distinct().groupBy("lang").agg(F.count("at"), F.min("at")).collect()
    sizes = {lang: (texts, least) for lang, texts, least in found}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((len(ORDERS), BUCKETS, 0), np.float32), np.ones((len(SCRIPT_NAMES), 0), bool))
    # The share of the texts, and at least the one of least hash.
    ends = {lang: min(scale, max(-(-per_language * scale // texts), least + 1)) for lang, (texts, least) in sizes.items()}
    share = F.create_map(*[F.lit(x).cast(kind) for lang in languages for x, kind in ((lang, "string"), (ends[lang], "long"))])
    taken = rows.where(place < F.try_element_at(share, F.col("lang"))).distinct()
    counted = (
        taken.mapInArrow(_counts, "lang string, order int, bucket int, n long")
        .groupBy("lang", "order", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    counts = np.zeros((len(ORDERS) + 1, BUCKETS, len(languages)))
    code = counted["lang"].map({lang: k for k, lang in enumerate(languages)}).to_numpy()
    level = counted["order"].map({0: 0} | {n: k + 1 for k, n in enumerate(ORDERS)}).to_numpy()
    counts[level, counted["bucket"].to_numpy(), code] = counted["n"].to_numpy()
    smoothed = counts[1:] + 0.1
    weights = np.log(smoothed / smoothed.sum(axis=1, keepdims=True))
    scripts = counts[0, : len(SCRIPT_NAMES)]
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0, keepdims=True), 1)
    allowed[~allowed.any(axis=1)] = True  # a script no language was seen in narrows nothing
    return Model(languages, weights.astype(np.float32), allowed)


def _word_scores(model: Model, codes: np.ndarray, letters: np.ndarray):
    """(starts, lengths, scores): place, letters and mean-free log-likelihood per language of every word."""
    edges = np.diff(letters.astype(np.int8), prepend=np.int8(0))
    starts = np.flatnonzero(edges == 1)
    ends = np.flatnonzero(edges == -1)
    if not len(starts):
        return starts, starts, np.zeros((0, len(model.languages)), np.float32)
    total = np.zeros((len(codes), len(model.languages)), np.float32)
    for k, (_, at, buckets) in enumerate(_grams(codes, letters)):
        total[at] += model.weights[k][buckets]
    scores = np.add.reduceat(total, starts, axis=0)
    scores -= scores.max(axis=1, keepdims=True)
    script = _characters()[1][codes[starts]]
    scores[~model.allowed[script]] -= 1e4
    return starts, ends - starts, scores


#: Words of a block whose paths are found side by side with those of all other blocks.
BLOCK = 64
#: Words x languages x languages held at once.
CELLS = 1 << 23


def viterbi(scores: np.ndarray, first: np.ndarray, switch: float) -> np.ndarray:
    """Best path of each of several texts: word scores (words, languages), where texts begin, to a language per word.

    A path earns its words' scores and pays ``switch`` for each change. Texts
    are cut into blocks; for all blocks at once, the best way from each language
    before the block to each at its end is found word by word. These ways are then
    joined block by block, and the path is read backwards.
    """
    languages = scores.shape[1]
    sizes = np.diff(first)
    blocks = -(-sizes // BLOCK)
    begin = np.concatenate([[0], np.cumsum(blocks)])
    count = int(begin[-1])
    at = np.arange(len(scores)) + np.repeat(begin[:-1] * BLOCK - first[:-1], sizes)
    padded = np.zeros((count * BLOCK, languages))
    padded[at] = scores  # padding scores nothing, so a path stays as it is there
    padded = padded.reshape(count, BLOCK, languages)

    # Value of the best way by (block, language before, language now).
    entry = np.where(np.eye(languages, dtype=bool), 0.0, -switch)
    value = np.broadcast_to(entry, (count, languages, languages)).copy()
    value[begin[:-1][blocks > 0]] = 0.0  # nothing stands before a text
    value += padded[:, :1]
    stayed = np.ones((BLOCK, count, languages, languages), bool)
    came = np.zeros((BLOCK, count, languages), np.int16)
    for t in range(1, BLOCK):
        came[t] = value.argmax(axis=2)
        moved = value.max(axis=2)[:, :, None] - switch
        np.greater_equal(value, moved, out=stayed[t])
        value = np.maximum(value, moved) + padded[:, t : t + 1]

    # From block to block.
    before = np.zeros((count, languages), np.int16)
    total = np.zeros((len(sizes), languages))
    order = np.argsort(-blocks, kind="stable")
    longest = int(blocks.max(initial=0))
    active = np.searchsorted(-blocks[order], -np.arange(longest), side="left")
    for b in range(longest):
        texts = order[: active[b]]
        k = begin[texts] + b
        ways = total[texts][:, :, None] + value[k]
        before[k] = ways.argmax(axis=1)
        total[texts] = ways.max(axis=1)
    start, end = np.zeros(count, np.int64), np.zeros(count, np.int64)
    state = total.argmax(axis=1)
    for b in range(longest - 1, -1, -1):
        texts = order[: active[b]]
        k = begin[texts] + b
        end[k] = state[texts]
        start[k] = before[k, end[k]]
        state[texts] = start[k]

    # Backwards inside all blocks.
    rows = np.arange(count)
    path = np.zeros((count, BLOCK), np.int16)
    state = end
    for t in range(BLOCK - 1, -1, -1):
        path[:, t] = state
        state = np.where(stayed[t, rows, start, state], state, came[t, rows, start])
    return path.reshape(-1)[at]


#: Code points scored at once.
CHUNK = 1 << 20


def _label(model: Model, texts: list[str | None]) -> list[tuple[list[tuple[int, int, str]], dict[str, int]]]:
    """Spans (first and end character, language) and letters per language of each text."""
    codes, letters, bounds = _separate(texts)
    starts, lengths, scores = _word_scores(model, codes, letters)
    first = np.searchsorted(starts, bounds)
    path = np.zeros(len(starts), np.int16)
    most = max(1, CELLS // len(model.languages) ** 2)
    begin = 0
    while begin < len(texts):
        # As many texts as fit, one at least.
        end = max(begin + 1, int(np.searchsorted(first, first[begin] + most, side="right")) - 1)
        end = min(end, len(texts))
        lo, hi = first[begin], first[end]
        if hi > lo:
            path[lo:hi] = viterbi(scores[lo:hi], first[begin : end + 1] - lo, SWITCH)
        begin = end
    out: list = []
    names = model.languages
    for g in range(len(texts)):
        lo, hi = first[g], first[g + 1]
        if lo == hi:
            out.append(([], {}))
            continue
        own, n, place = path[lo:hi], lengths[lo:hi], starts[lo:hi] - bounds[g]
        cut = np.flatnonzero(np.diff(own)) + 1
        spans = [
            (int(place[a]), int(place[b - 1] + n[b - 1]), names[own[a]])
            for a, b in zip([0, *cut], [*cut, len(own)], strict=True)
        ]
        sums = np.bincount(own, weights=n, minlength=len(names))
        out.append((spans, {names[k]: int(sums[k]) for k in np.flatnonzero(sums)}))
    return out


def _chunks(texts: list[str | None]):
    """Runs of texts of about ``CHUNK`` characters."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t or "")
        if size >= CHUNK:
            yield texts[at : k + 1]
            at, size = k + 1, 0
    if at < len(texts):
        yield texts[at:]


_SPAN = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("lang", pa.string())])


def identify(model: Model, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text; the score is the language's share of the letters."""
    out = []
    for part in _chunks(texts):
        found = _label(model, part) if model.languages else [([], {})] * len(part)
        for spans, letters in found:
            if not letters:
                out.append((UNDETERMINED, 0.0, []))
                continue
            lang = max(sorted(letters), key=letters.__getitem__)
            score = letters[lang] / sum(letters.values())
            out.append((lang, score, [{"first": a, "end": b, "lang": x} for a, b, x in spans]))
    return out


def _predict(model, text_at):
    def run(batches):
        for whole in batches:
            for batch in slices(whole, 64):
                found = identify(model.value, batch.column(text_at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                        pa.array([f[2] for f in found], pa.list_(_SPAN)),
                    ],
                    names=[*batch.schema.names, "lang_pred", "lang_score", "lang_spans"],
                )

    return run


def identify_languages(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_spans (character ranges of the lower-cased text) appended.

    A text that is NULL or has no letter is ``und`` with score 0, and so is every
    text if no language was learned. All rows and columns are kept; columns
    named like the new ones are refused.
    """
    clash = {"lang_pred", "lang_score", "lang_spans"} & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)} first")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    added = "lang_pred string, lang_score double, lang_spans array<struct<first: bigint, end: bigint, lang: string>>"
    return docs.mapInArrow(_predict(shared, docs.columns.index(text_col)), f"{schema}, {added}")
