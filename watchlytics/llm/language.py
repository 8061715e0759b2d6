"""Language identification: script ranges narrow the candidates, Viterbi over word scores labels spans.

``learn`` counts, per language, letters of each script and letter trigrams hashed into a fixed number of buckets: the
model has ``2 ** BUCKET_BITS`` numbers per language, however much text it saw. ``label_spans`` scores each word of
each whole text under every language whose learnt text uses the word's script (under all, if none does), and takes the
best sequence of languages, where every change costs ``SWITCH``. All documents of a batch advance word by word
together. A document's language is the one with the most letters, the first by name among equals; its score is its share
of the letters.

Null texts, texts without letters and all texts of a model without languages are ``und`` with score 0 and no spans.
Very long texts are read whole, in slices: what stays of them is a score per word and language. An empty table
gives no rows; columns named like the added ones are replaced. Repeated rows get equal results; rows never move, and only counts are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from watchlytics.llm.common import bound_batches

UNKNOWN = "und"
BUCKET_BITS = 16
#: Cost of a change of language, in units of log probability.
SWITCH = 10.0
#: Characters of a text cut into words, and letters scored under all languages, at a time.
SLICE, LETTERS_AT_ONCE = 1 << 19, 1 << 14
#: Certainly no letter: a text may be cut there.
NO_LETTER = re.compile(r"[\W\d_]")
#: Share of a language's letters from which on a script counts as one of its own.
SCRIPT_SHARE = 0.001
#: First code points of Unicode ranges and their scripts.
SCRIPT_RANGES = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "bengali"),
    (0x0A00, "gurmukhi"),
    (0x0A80, "gujarati"),
    (0x0B00, "oriya"),
    (0x0B80, "tamil"),
    (0x0C00, "telugu"),
    (0x0C80, "kannada"),
    (0x0D00, "malayalam"),
    (0x0D80, "sinhala"),
    (0x0E00, "thai"),
    (0x0E80, "lao"),
    (0x0F00, "tibetan"),
    (0x1000, "burmese"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "ethiopic"),
    (0x13A0, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
    (0x32000, "other"),
)
SCRIPTS = tuple(dict.fromkeys(name for _, name in SCRIPT_RANGES))
SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("lang", T.StringType())])

_tables: list[np.ndarray] = []


def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: script number from 1 on (0: no letter), lower-case code point."""
    if not _tables:
        size = 0x110000
        script = np.zeros(size, np.uint8)
        starts = [start for start, _ in SCRIPT_RANGES] + [size]
        for (start, name), end in zip(SCRIPT_RANGES, starts[1:]):
            script[start:end] = SCRIPTS.index(name) + 1
        lower = np.arange(size, dtype=np.uint32)
        for code in range(size):
            c = chr(code)
            if not c.isalpha():
                script[code] = 0
            elif len(small := c.lower()) == 1:
                lower[code] = ord(small)
        _tables.extend((script, lower))
    return _tables[0], _tables[1]


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Trigram buckets and scripts of the letters of a text; starts, ends and first letters of its words.

    A word is a run of letters of one script.
    """
    script_of, lower = character_tables()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_of[codes]
    small = np.where(script > 0, lower[codes], 0).astype(np.uint64)
    padded = np.concatenate([[0], small, [0]]).astype(np.uint64)
    mixed = padded[:-2] * np.uint64(0x9E3779B1) + padded[1:-1] * np.uint64(0x85EBCA77) + padded[2:] * np.uint64(0xC2B2AE3D)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    bucket = (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    change = np.concatenate([[True], script[1:] != script[:-1]]) if len(script) else np.empty(0, bool)
    starts = np.flatnonzero(change & (script > 0))
    edges = np.append(np.flatnonzero(change), len(script))
    ends = edges[np.searchsorted(edges, starts, side="right")]
    letters = np.flatnonzero(script > 0)
    firsts = np.concatenate([[0], np.cumsum(ends - starts)])[:-1].astype(np.int64)
    return bucket[letters], script[letters], starts, ends, firsts


def slices_of(text: str) -> Iterator[tuple[int, str]]:
    """Parts of a text with their first characters: of ``SLICE`` characters and the rest of a word. No word is cut."""
    at = 0
    while at < len(text):
        found = NO_LETTER.search(text, at + SLICE)
        end = found.start() if found else len(text)
        yield at, text[at:end]
        at = end


@dataclass
class Model:
    """Languages by name; log probabilities (bucket, language); scripts (script, language) that are their own."""

    languages: list[str]
    logs: np.ndarray
    scripts: np.ndarray


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """Count scripts and trigrams of all texts with a language."""
    spark = docs.sparkSession
    bound_batches(spark)
    size = 1 << BUCKET_BITS
    given = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string"), text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, words in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = totals.setdefault(name, np.zeros(size + len(SCRIPTS) + 1, np.int64))
                for _, part in slices_of(words.as_py()):
                    bucket, script, *_ = words_of(part)
                    own[:size] += np.bincount(bucket, minlength=size) if len(bucket) > size // 4 else 0
                    if len(bucket) <= size // 4:
                        np.add.at(own, bucket, 1)
                    own[size:] += np.bincount(script, minlength=len(SCRIPTS) + 1)
        for name, own in totals.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["lang", "place", "n"])

    counts = given.mapInArrow(count, "lang string, place int, n long").groupBy("lang", "place").agg(F.sum("n").alias("n"))
    table = counts.toArrow()
    names = np.array(table.column("lang").to_pylist(), dtype=object)
    languages = sorted(set(names.tolist()))
    found = np.zeros((size + len(SCRIPTS) + 1, len(languages)))
    if languages:
        column = np.searchsorted(np.array(languages, dtype=object), names)
        found[table.column("place").to_numpy(), column.astype(np.int64)] = table.column("n").to_numpy()
    grams, scripts = found[:size], found[size:]
    logs = np.log((grams + 0.5) / (grams.sum(axis=0) + 0.5 * size))
    return Model(languages, logs.astype(np.float32), scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0)))


def viterbi(scores: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best language number of each word. ``scores`` (word, language) holds the texts one after the other."""
    states = scores.shape[1]
    order = np.argsort(-lengths, kind="stable")
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1][order]
    sorted_lengths = lengths[order]
    longest = int(sorted_lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-sorted_lengths, -np.arange(1, longest + 1), side="right")
    came = np.empty(scores.shape, np.uint8 if states < 256 else np.int32)
    own = np.arange(states, dtype=came.dtype)
    value = np.zeros((len(lengths), states), np.float32)
    for t in range(longest):
        n = active[t]
        at = starts[:n] + t
        now = value[:n]
        if t:
            best = now.argmax(axis=1)
            top = now[np.arange(n), best] - np.float32(switch)
            change = now < top[:, None]
            came[at] = np.where(change, best[:, None].astype(came.dtype), own)
            np.maximum(now, top[:, None], out=now)
        now += scores[at]
        now -= now.max(axis=1)[:, None]
    path = np.empty(len(scores), came.dtype)
    state = value.argmax(axis=1)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        path[at] = state[:n]
        if t:
            state[:n] = came[at, state[:n]]
    return path


def score_words(text: str, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and scores (word, language) of the words of a text, from slices of its letters."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, len(model.languages)), np.float32))]
    for first, part in slices_of(text):
        bucket, script, starts, ends, firsts = words_of(part)
        scores = np.zeros((len(starts), len(model.languages)), np.float32)
        for a in range(0, len(bucket), LETTERS_AT_ONCE):
            b = min(len(bucket), a + LETTERS_AT_ONCE)
            low, high = np.searchsorted(firsts, [a, b - 1], side="right")
            within = np.maximum(firsts[low - 1 : high] - a, 0)
            scores[low - 1 : high] += np.add.reduceat(model.logs[bucket[a:b]], within, axis=0)
        fits = model.scripts[script[firsts]]
        scores[~fits & fits.any(axis=1)[:, None]] = -1e9
        found.append((starts + first, ends + first, scores))
    return tuple(np.concatenate(x) for x in zip(*found))


def label_texts(texts: list[str | None], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
    """Language, score and spans (characters from, to, language) of each text."""
    none = (UNKNOWN, 0.0, [])
    if not model.languages:
        return [none] * len(texts)
    pieces = [score_words(t or "", model) for t in texts]
    lengths = np.array([len(p[0]) for p in pieces], np.int64)
    scores = np.concatenate([p[2] for p in pieces])
    pieces = [p[:2] for p in pieces]
    scores -= scores.max(axis=1, keepdims=True)
    path = viterbi(np.maximum(scores, np.float32(-1e6), out=scores), lengths, switch)
    out, at = [], 0
    for (starts, ends), n in zip(pieces, lengths.tolist()):
        if not n:
            out.append(none)
            continue
        own = path[at : at + n]
        at += n
        letters = np.bincount(own, weights=ends - starts, minlength=len(model.languages))
        best = int(letters.argmax())
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        last = np.append(first[1:], n) - 1
        spans = [(a, b, model.languages[k]) for a, b, k in zip(starts[first].tolist(), ends[last].tolist(), own[first].tolist())]
        out.append((model.languages[best], float(letters[best] / letters.sum()), spans))
    return out


def label_spans(docs: DataFrame, model: Model, switch: float = SWITCH) -> DataFrame:
    """``docs`` without its text, with lang_pred, score and spans; columns of these names are replaced."""
    spark = docs.sparkSession
    bound_batches(spark)
    added = ("lang_pred", "score", "spans")
    kept = [c for c in docs.columns if c.lower() not in (*added, "text")]
    given = docs.select(*(F.col(f"`{c}`") for c in kept), "text")
    shared = spark.sparkContext.broadcast(model)  # a fixed number of buckets per language

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label_texts(batch.column(len(kept)).to_pylist(), shared.value, switch)
            spans = [[{"start": a, "end": b, "lang": c} for a, b, c in s] for _, _, s in found]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], pa.array([x for x, _, _ in found], pa.string()), pa.array([x for _, x, _ in found], pa.float64()), pa.array(spans, kind)],
                names=[*kept, *added],
            )

    fields = docs.select(*(F.col(f"`{c}`") for c in kept)).schema.fields
    schema = T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(SPAN))])
    return given.mapInArrow(label, schema)
