"""Fill-in-middle transformation: a wavelet matrix over character classes finds both cuts of every text.

The bytes of all texts of an Arrow batch become classes (continuation byte, white space, first or later character
of a word, each apart at the start of a line) of one wavelet matrix. The ranks of the classes that begin a unit add up
to the number of units before a byte; bisection on that number gives the byte a cut falls on, for all texts of the
batch at once. Units are ``code_point``, ``word`` (with the white space after it) or ``line`` (with its break).

Every choice comes from a SHA-256 of a salt and the row's key, so a repeated run, a retried task and repeated rows
give the same result. The prefix ends after the smaller and the middle after the larger of two numbers
of units. A text that is empty or holds a sentinel stays plain, as does a given share of the others.

Null text counts as empty, a null key as an empty key. White space before the first word belongs to the first
unit. An empty table gives no rows. Columns of the input named like the added ones are replaced. A very long text is a
batch of its own and needs some ten bytes a byte of text; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from watchlytics.llm.common import bound_batches
from watchlytics.llm.decontamination import WaveletMatrix

#: What stands before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
#: Of a hundred texts: those that stay plain; of the others, those that begin with the suffix.
PLAIN, SPM = 10, 20
CONTINUATION, INNER, SPACE, WORD, SPACE_AT_LINE, WORD_AT_LINE = range(6)
CLASS_BITS = 3
#: Classes of the bytes that begin a unit.
UNITS = {
    "code_point": (INNER, SPACE, WORD, SPACE_AT_LINE, WORD_AT_LINE),
    "word": (WORD, WORD_AT_LINE),
    "line": (SPACE_AT_LINE, WORD_AT_LINE),
}
ADDED = T.StructType().add("n", "long").add("form", "string").add("prefix_units", "long").add("middle_units", "long").add("output", "string")


def classes(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Class of each byte of texts that follow each other and begin at ``starts``."""
    begins = np.zeros(len(raw) + 1, bool)
    begins[starts] = True
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    after_space = begins[:-1].copy()
    after_space[1:] |= space[:-1]
    after_break = begins[:-1].copy()
    after_break[1:] |= raw[:-1] == 10
    found = np.where(space, SPACE, np.where(after_space, WORD, INNER)) + 2 * after_break
    return np.where((raw & 0xC0) == 0x80, CONTINUATION, found).astype(np.uint8)


class UnitMatrix:
    """Numbers of units in byte ranges, and the byte after so many units."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, unit: str):
        self.matrix = WaveletMatrix(classes(raw, starts), CLASS_BITS)
        self.begin = UNITS[unit]

    def before(self, at: np.ndarray) -> np.ndarray:
        """Units that begin before each byte: the ranks of their classes together."""
        return sum(self.matrix.rank(np.full(len(at), c, np.int64), at) for c in self.begin)

    def cut(self, start: np.ndarray, end: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Byte after the first ``units`` units of each range, by bisection on ranks."""
        wanted = self.before(start) + units
        low, high = start.copy(), end.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            fits = self.before(middle) <= wanted
            low, high = np.where(fits, middle, low), np.where(fits, high, middle - 1)
        return np.where(units == 0, start, low)


def numbers(key: str, salt: str) -> tuple[int, ...]:
    """The first four groups of eight digits of the key's hex SHA-256."""
    digest = hashlib.sha256(f"{salt}:{key}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """Sentinels must be found again wherever they are put: their first character is nowhere else in them."""
    if len(set(sentinels)) != 3 or not all(sentinels):
        raise ValueError("three different sentinels are needed")
    if any(s[0] in t[1:] for s in sentinels for t in sentinels):
        raise ValueError("a sentinel's first character must not occur later in a sentinel")


def transform(texts: list[bytes], keys: list[str], unit: str, salt: str, plain: int, spm: int, sentinels: tuple[str, str, str]) -> list[tuple]:
    """(units, form, units of prefix, units of middle, output) of each text."""
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
    starts = ends - np.fromiter(map(len, texts), np.int64, len(texts))
    matrix = UnitMatrix(np.frombuffer(b"".join(texts), np.uint8), starts, unit)
    n = matrix.before(ends) - matrix.before(starts)
    h = np.array([numbers(k, salt) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    first = (matrix.cut(starts, ends, cuts[:, 0]) - starts).tolist()
    second = (matrix.cut(starts, ends, cuts[:, 1]) - starts).tolist()
    p, s, m = marks = [x.encode() for x in sentinels]
    out = []
    for i, text in enumerate(texts):
        if not text or h[i, 2] % 100 >= 100 - plain or any(x in text for x in marks):
            out.append((n[i], "plain", None, None, text))
            continue
        before, inside, after = text[: first[i]], text[first[i] : second[i]], text[second[i] :]
        form = "spm" if h[i, 3] % 100 < spm else "psm"
        parts = (s, after, p, before, m, inside) if form == "spm" else (p, before, s, after, m, inside)
        out.append((n[i], form, cuts[i, 0], cuts[i, 1] - cuts[i, 0], b"".join(parts)))
    return out


def fill_in_middle(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = "code_point",
    salt: str = "1",
    plain: int = PLAIN,
    spm: int = SPM,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """``docs`` with n (units of the text), form (plain, psm or spm), prefix_units and middle_units (null if plain), output.

    ``text`` becomes ``output``: as it is (plain), prefix, suffix and middle (psm) or suffix, prefix and middle
    (spm), each after its sentinel. ``plain`` and ``spm`` are shares in percent.
    """
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    check_sentinels(sentinels)
    bound_batches(docs.sparkSession)
    names = {f.name for f in ADDED}
    kept = [c for c in docs.columns if c.lower() not in names]
    given = docs.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("_key_of_row"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("_text_of_row"),
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, texts = (batch.column(len(kept) + i).to_pylist() for i in (0, 1))
            n, form, prefix, middle, output = zip(*transform(texts, keys, unit, salt, plain, spm, sentinels))
            output = pa.array(output, pa.binary()).cast(pa.string())
            added = [pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), output]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *added], names=[*kept, *ADDED.names])

    return given.mapInArrow(cut, T.StructType([*given.schema.fields[: len(kept)], *ADDED.fields]))


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text an output was made of. It holds no sentinel but the three put there, so they split it."""
    part = F.split(output, "|".join(map(re.escape, sentinels)), -1)
    second, third = F.get(part, F.lit(1)), F.get(part, F.lit(2))
    last = F.get(part, F.lit(3))
    return F.when(form == "psm", F.concat(second, last, third)).when(form == "spm", F.concat(third, last, second)).otherwise(output)
