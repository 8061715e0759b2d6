"""Fill-in-middle against plain slicing of code points, words and lines."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from llm_helpers import AWKWARD, SF, clashing, documents, fetch
from watchlytics.llm import fill_middle, queries

TEXTS = [
    "", " ", "a", "é", "漢字\U0001f600 x", "one two\nthree  four\n\n five\n", "  lead", "tail \n", "<P>", "a<S>b", "<M", "<", "a<", "<S", "P><",
    "\x00\x00", "x\r\ny", "é" * 2000 + "\n" + "z", "\n", "\n\n", "a b", *(t for _, t, *_ in AWKWARD if t),
]


def units(text, unit):
    if unit == "code_point":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    found = re.findall(r"[^\t-\r ]+[\t-\r ]*", text)
    lead = re.match(r"[\t-\r ]*", text).group()
    return [lead + found[0], *found[1:]] if found else []


def plainly(key, text, unit="code_point", salt="1", plain=10, spm=20):
    parts = units(text, unit)
    n = len(parts)
    digest = hashlib.sha256(f"{salt}:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 100 - plain:
        return n, "plain", None, None, text
    before, inside = "".join(parts[:a]), "".join(parts[a:b])
    after = text[len(before) + len(inside) :]
    if a == n:  # what has no unit goes where the last cut leaves it
        before, inside, after = text, "", ""
    elif b == n:
        inside, after = text[len(before) :], ""
    if a == 0 and n == 0:
        before, inside, after = "", "", text
    if h[3] % 100 < spm:
        return n, "spm", a, b - a, f"<S>{after}<P>{before}<M>{inside}"
    return n, "psm", a, b - a, f"<P>{before}<S>{after}<M>{inside}"


@pytest.mark.parametrize("unit", ["code_point", "word", "line"])
def test_cuts_of_all_units(unit):
    texts = [t for t in TEXTS for _ in range(12)]
    keys = [str(i) for i in range(len(texts))]
    got = fill_middle.transform([t.encode() for t in texts], keys, unit, "1", 10, 20, fill_middle.SENTINELS)
    for key, text, (n, form, a, b, output) in zip(keys, texts, got):
        assert (n, form, a, b, output.decode()) == plainly(key, text, unit)


def test_very_long_text():
    text = "long word é\n" * 200_000
    ((n, form, a, b, output),) = fill_middle.transform([text.encode()], ["5"], "code_point", "1", 0, 20, fill_middle.SENTINELS)
    assert (n, form, a, b, output.decode()) == plainly("5", text, plain=0)


def test_awkward_rows_come_back(spark):
    docs = clashing(documents(spark), "N", "output", "Form", "batch")
    found = fill_middle.fill_in_middle(docs, plain=0)
    assert found.columns == [c for c in docs.columns if c not in ("N", "output", "Form")] + fill_middle.ADDED.names
    back = found.select("*", fill_middle.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(back) == len(AWKWARD)
    for r in back:
        assert r.back == (r.text or "") and r.batch == "own batch"
        key = "" if r.doc_id is None else r.doc_id
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == plainly(key, r.text or "", plain=0)


def test_texts_that_end_like_a_sentinel(spark):
    rows = [(i, t, None, None, None) for i in range(40) for t in ("<", "<P", "a<S", "P><<", "<<<M", "M>")]
    found = fill_middle.fill_in_middle(documents(spark, rows), plain=0)
    assert {r.form for r in found.collect()} == {"psm", "spm"}
    assert found.where(fill_middle.restored(F.col("output"), F.col("form")) != F.col("text")).count() == 0


def test_own_sentinels(spark):
    docs = documents(spark, [(i, f"text {i} <P> [x", None, None, None) for i in range(30)])
    own = ("[pre]", "[suf]", "[mid]")
    found = fill_middle.fill_in_middle(docs, unit="word", plain=0, spm=50, sentinels=own)
    assert {r.form for r in found.collect()} == {"psm", "spm"}
    assert found.where(fill_middle.restored(F.col("output"), F.col("form"), own) != F.col("text")).count() == 0
    for bad in (("<a>", "<a>", "<b>"), ("aba", "x", "y"), ("", "x", "y")):
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(docs, sentinels=bad)


def test_empty_table(spark):
    assert fill_middle.fill_in_middle(documents(spark, [])).count() == 0


def test_query_against_plain_slicing(spark):
    found = {r.doc_id: r for r in queries.op13_fill_in_middle(spark, SF).collect()}
    rows = fetch(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'")
    assert len(found) == len(rows)
    for doc_id, text in rows:
        n, form, a, b, output = plainly(doc_id, text)
        r = found[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, a, b)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_query_against_its_sql(spark):
    got = sorted(tuple(r) for r in queries.op13_fill_in_middle(spark, SF).collect())
    sql = queries.ORACLES["op13_fill_in_middle"].replace("FROM documents", f"FROM '{SF}/documents.parquet'")
    assert got == sorted(fetch(sql))
