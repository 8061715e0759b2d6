"""Token counts per section: whole documents are encoded once, token spans are joined to sections.

Tokens know the characters they cover; sections are character spans of the same text (lines, or fields
joined to one text). Each document's token spans and sections are merged as two sorted lists of intervals,
inside the map task that encoded it: nothing is shuffled and tokens are never rows.

A token that reaches over a section's border counts once, by one of two rules: ``largest`` gives it to the
section that holds most of its characters (the first among equals), ``first`` to the section of its first
character inside any section. Tokens outside all sections are counted under section -1 with null borders. A
character that several tokens share belongs to each of them; empty sections have no tokens. Null text has no
sections and no rows; repeated rows get rows each, an empty table gives none. Very long texts are encoded whole, in memory in
proportion to their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from watchlytics.llm.bpe import Codec, Shared
from watchlytics.llm.common import bound_batches

RULES = ("largest", "first")
#: Rows handed over at a time.
ROWS_AT_ONCE = 50_000
COUNTED = (
    T.StructField("section", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("n_shared", T.LongType()),
)


def line_sections(text: Column) -> Column:
    """Lengths of the lines of a text in characters, the sections of ``count_tokens``; null for null."""
    lengths = F.transform(F.split(text, "\n", -1), lambda x: F.length(x).cast("long"))
    return F.when(text.isNotNull(), lengths)


def join_fields(docs: DataFrame, fields: list[str], text: str, lengths: str, separator: str = "\n") -> DataFrame:
    """``docs`` with the fields joined to one ``text`` and the ``lengths`` of its parts; null fields are empty."""
    values = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in fields]
    return docs.withColumns({text: F.concat_ws(separator, *values), lengths: F.array(*(F.length(v).cast("long") for v in values))})


def borders(lengths: list[int] | np.ndarray, separator: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of sections that follow each other, each with the separator after it but the last."""
    sizes = np.asarray(lengths, np.int64) + separator
    if len(sizes):
        sizes[-1] -= separator
    ends = np.cumsum(sizes)
    return ends - sizes, ends


def token_spans(codec: Codec, widths: np.ndarray, text: str) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last of each token; ``widths`` has the bytes of each id."""
    ids = np.frombuffer(codec.encode_bytes(text), "<u4")
    raw = np.frombuffer(text.encode(), np.uint8)
    character = np.cumsum((raw & 0xC0) != 0x80) - 1
    ends = np.cumsum(widths[ids])
    return character[ends - widths[ids]], character[ends - 1] + 1


def allocate(first: np.ndarray, last: np.ndarray, start: np.ndarray, end: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (-1: none) and whether it touches several. Sections are sorted and do not overlap."""
    if not len(start):
        return np.full(len(first), -1, np.int64), np.zeros(len(first), bool)
    low = np.searchsorted(end, first, side="right")
    high = np.searchsorted(start, last, side="left") - 1
    section = np.where(low <= high, low, -1)
    several = high > low
    if rule == "largest":
        for t in np.flatnonzero(several).tolist():
            parts = np.arange(low[t], high[t] + 1)
            held = np.minimum(end[parts], last[t]) - np.maximum(start[parts], first[t])
            section[t] = parts[held.argmax()]
    return section, several


def count_tokens(
    docs: DataFrame,
    lengths: str,
    text: str = "text",
    separator: int = 1,
    rule: str = "largest",
    vocabulary: str | None = None,
) -> DataFrame:
    """One row per section of each row of ``docs``: its columns but text and lengths, section, start, end, n_tokens, n_shared.

    ``lengths`` is the array of the sections' lengths in characters, ``separator`` the characters between them, which
    belong to the section before. ``n_shared`` counts the tokens of a section that touch others too. Columns of ``docs`` with
    the names of added ones are left out.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, vocabulary)
    added = {f.name for f in COUNTED}
    kept = [c for c in docs.columns if c.lower() not in added | {text.lower(), lengths.lower()}]
    picked = [F.col(f"`{c}`") for c in kept]
    given = docs.select(*picked, F.col(f"`{text}`"), F.col(f"`{lengths}`")).where(F.col(f"`{text}`").isNotNull())
    schema = T.StructType([*docs.select(*picked).schema.fields, *COUNTED])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = shared.codec()
        widths = np.fromiter(map(len, codec.strings), np.int64, len(codec.strings))
        for batch in batches:
            held: list[tuple[int, np.ndarray]] = []
            size = 0
            for row, (words, parts) in enumerate(zip(batch.column(len(kept)), batch.column(len(kept) + 1))):
                start, end = borders(parts.values.to_numpy(zero_copy_only=False) if parts.is_valid else [], separator)
                first, last = token_spans(codec, widths, words.as_py())
                section, several = allocate(first, last, start, end, rule)
                n = len(start)
                counts = np.bincount(section + 1, minlength=n + 1)
                crossing = np.bincount(section[several] + 1, minlength=n + 1)
                found = np.stack([np.arange(-1, n), np.append(-1, start), np.append(-1, end), counts, crossing])
                held.append((row, found[:, 0 if counts[0] else 1 :]))
                size += n
                if size >= ROWS_AT_ONCE:
                    yield _rows(batch, held, kept, schema)
                    held, size = [], 0
            if held:
                yield _rows(batch, held, kept, schema)

    return given.mapInArrow(count, schema)


def _rows(batch: pa.RecordBatch, held: list[tuple[int, np.ndarray]], kept: list[str], schema: T.StructType) -> pa.RecordBatch:
    place = pa.array(np.repeat([r for r, _ in held], [x.shape[1] for _, x in held]))
    section, start, end, n, crossing = np.concatenate([x for _, x in held], axis=1)
    none = section < 0
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(i).take(place) for i in range(len(kept))),
            pa.array(section.astype(np.int32)),
            pa.array(start, mask=none),
            pa.array(end, mask=none),
            pa.array(n),
            pa.array(crossing),
        ],
        names=schema.names,
    )
