"""Small tables with awkward rows, and the driver's smallest tables."""

from __future__ import annotations

import zlib

import duckdb

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the long text goes on and on " * 20_000

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "s", 0),
    (3, " \t\r\n\x0b\x0c ", "en", "s", 7),
    (4, "one two three four five six", "en", "s", 27),
    (4, "one two three four five six", "en", "s", 27),
    (None, "one two three\nfour five six", None, "s", None),
    (6, "One  two three four five six", "en", "s", 27),
    (7, LONG, "en", "s", len(LONG)),
    (8, "Ünïcödé \U0001f600 text here ‎ 漢字 \x00 end", "fr", "s", 30),
    (9, "<|endoftext|> it's we'll 12345 !!!", "en", "s", 30),
]


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame(rows, DOCS)


def fetch(sql: str) -> list[tuple]:
    return duckdb.sql(sql).fetchall()


def fold(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode()) % 4


def clashing(df, *names):
    """``df`` with further columns of the given names."""
    from pyspark.sql import functions as F

    return df.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
