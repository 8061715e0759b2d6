"""Exact dedup against SQL and a plain grouping, with whole and with weak digests."""

import pytest
from pyspark.sql import functions as F

from llm_helpers import AWKWARD, SF, clashing, documents
from testbed.check import compare, duckdb_tables
from watchlytics.llm import exact_dedup as e
from watchlytics.llm.common import placed, stored
from watchlytics.session import new_folder


def weak(text):
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 1)


def plain(rows):
    """Kept identifier and size per row, by grouping the bare texts."""
    table = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups = {}
    for i, (doc_id, text, *_) in enumerate(rows):
        groups.setdefault((text or "").translate(table), []).append((-len(text or ""), doc_id is None, doc_id or 0, i))
    out = []
    for i, (doc_id, text, *_) in enumerate(rows):
        group = groups[(text or "").translate(table)]
        best = min(group)
        out.append((doc_id, None if best[1] else best[2], len(group)))
    return sorted(out, key=repr), sum(1 for _ in groups)


@pytest.mark.parametrize("digest", [e.sha256, weak])
def test_awkward_rows(spark, digest):
    found = e.duplicates(placed(clashing(documents(spark), "digest", "file", "place", "row", "_metadata")), digest=digest)
    want, groups = plain(AWKWARD)
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found.collect()), key=repr) == want
    assert found.where("kept").count() == groups


def test_digests_that_collide_do_not_change_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = ["doc_id", "keep_id", "group_size", "kept"]
    a, b = (e.duplicates(placed(docs), digest=f).select(*columns) for f in (e.sha256, weak))
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_query_against_sql(spark):
    from watchlytics.llm.queries import ORACLES, QUERIES

    import testbed.check as check

    check.QUERIES.update({"op1_exact_dedup": QUERIES["op1_exact_dedup"]})
    try:
        assert compare(spark, duckdb_tables(SF), SF, "op1_exact_dedup", ORACLES["op1_exact_dedup"]) == ""
    finally:
        del check.QUERIES["op1_exact_dedup"]


def test_state_outlives_a_run(spark):
    folder = new_folder(spark, "test-state")
    ledger = stored(e._rows(placed(documents(spark)), e.sha256).select("digest", "row"), "test-ledger")
    e.update_state(spark, ledger, folder)
    first = e.read_state(spark, folder).agg(F.sum("n")).first()[0]
    e.update_state(spark, ledger, folder)  # nothing new
    assert e.read_state(spark, folder).agg(F.sum("n")).first()[0] == first == len(AWKWARD)
    more = e._rows(placed(documents(spark, [(0, "ONE", None, None, None), (3, "oneTwo", None, None, None)])), e.sha256)
    more.select("digest", "row").write.mode("append").parquet(ledger.stored_path)
    e.update_state(spark, ledger, folder)
    state = e.read_state(spark, folder)
    assert state.agg(F.sum("n")).first()[0] == len(AWKWARD) + 2
    assert state.where("keep.doc_id = 0").count() == 1


def test_rows_that_stay(spark):
    docs = clashing(documents(spark), "file", "place", "document")
    kept = e.unique(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0 for r in kept.collect())) == [3, 4, 6, 7, 8, 9]
    assert e.unique(documents(spark, [])).count() == 0
    assert e.unique(docs.union(docs)).count() == 6


def test_no_python_on_the_executors(spark):
    found = e.duplicates(placed(spark.read.parquet(f"{SF}/documents.parquet")))
    text = found._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_later_calls_compare_bytes_with_earlier_ones(spark, tmp_path):
    """The weak digest covers many texts: sizes and kept rows must be those of all rows so far, by their bytes."""
    calls = [
        [(i, f"text {i % 40}" + "  " * (i % 3), None, None, None) for i in range(60)],
        [(100 + i, f"text {i}   ", None, None, None) for i in range(30, 90)],
        [(200, "text 1", None, None, None), (201, "none like it", None, None, None)],
    ]
    folder, so_far = new_folder(spark, "test-state"), []
    for number, rows in enumerate(calls):
        docs = documents(spark, rows)
        if number == 1:  # files of a table, with a blank in their path
            docs.write.parquet(str(tmp_path / "a table"))
            docs = spark.read.parquet(str(tmp_path / "a table"))
        so_far += rows
        found = e.duplicates(placed(docs), checkpoint=folder, digest=weak)
        own = {doc_id for doc_id, *_ in rows}
        want = [r for r in plain(so_far)[0] if r[0] in own]
        assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found.collect()), key=repr) == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in found.collect())


def test_a_new_text_is_compared_with_the_one_kept_earlier(spark):
    folder = new_folder(spark, "test-state")
    for rows, size in (([(1, "a", None, None, None)], 1), ([(2, "a longer text", None, None, None)], 1), ([(3, " a", None, None, None)], 2)):
        found = e.duplicates(placed(documents(spark, rows)), checkpoint=folder, digest=lambda text: F.lit("0")).collect()
        assert [(r.doc_id, r.keep_id, r.group_size) for r in found] == [(rows[0][0], rows[0][0], size)]


@pytest.mark.parametrize("broken", ["update_state", "read_state"])
def test_a_failed_call_can_be_repeated(spark, monkeypatch, tmp_path, broken):
    """Its rows count once, whether it failed before or after the state had them; later calls see them once too."""
    calls = [[(i, f"text {i % 4}", None, None, None) for i in range(10 * n, 10 * n + 10)] for n in range(3)]
    folder, so_far = new_folder(spark, "test-state"), []
    for number, rows in enumerate(calls):
        documents(spark, rows).write.parquet(str(tmp_path / str(number)))
        docs = placed(spark.read.parquet(str(tmp_path / str(number))))
        if number == 1:
            with monkeypatch.context() as patch:
                patch.setattr(e, broken, lambda *_: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    e.duplicates(docs, checkpoint=folder, call="second")
        so_far += rows
        for _ in range(2 if number == 1 else 1):
            found = e.duplicates(docs, checkpoint=folder, call="second" if number == 1 else None).collect()
            want = [r for r in plain(so_far)[0] if r[0] in {d for d, *_ in rows}]
            assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == want
    with pytest.raises(ValueError):
        e.duplicates(docs, checkpoint=folder, call="../x")
