"""ARC to WARC: parsing of both versions, synthesised headers, round trips."""

import gzip
import hashlib
from pathlib import Path

import pytest

from llm_helpers import clashing, fetch
from testbed.check import compare, duckdb_tables
from watchlytics.llm import arc_warc as w
from watchlytics.session import new_folder

SF = "/root/testdata/sf0.001"
BIG = "<p>" + "same payload " * 20 + "</p>"
PAGES = [
    (5, "http://a.com/x y\n", BIG),
    (3, None, BIG),
    (3, None, BIG),
    (None, "http://n.com/", BIG),
    (9, "http://b.com/", "short"),
    (8, "http://c.com/", "short"),
    (7, "http://d.com/", None),
    (6, "http://e.com/", ""),
    (10, "http://f.com/", "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nurl 1 2 3 4\n" + "é" * 100),
    (11, "http://g.com/", "x" * 300_000 + "\n"),
]


def pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def expected(rows):
    responses = {}
    for i, (key, _, html) in enumerate(rows):
        body = (html or "").encode()
        if len(body) >= 100:
            responses.setdefault(hashlib.sha256(body).hexdigest(), []).append((key is None, key or 0))
    out = []
    for key, _, html in rows:
        body = (html or "").encode()
        digest = hashlib.sha256(body).hexdigest()
        out.append((key, len(body), digest))
    return sorted(out, key=repr), {d: min(k)[1] for d, k in responses.items()}, {d: len(k) for d, k in responses.items()}


def test_round_trip_of_awkward_pages(spark):
    found = w.round_trip(clashing(pages(spark), "key", "record", "payload"))
    rows = found.collect()
    want, least, sizes = expected(PAGES)
    assert sorted(((r.key, r.payload_bytes, r.payload_digest) for r in rows), key=repr) == want
    for digest, n in sizes.items():
        group = [r for r in rows if r.payload_digest == digest]
        responses = [r for r in group if r.record_type == "response"]
        assert len(group) == n and len(responses) == 1 and responses[0].key == least[digest]
        assert all(r.refers_to == least[digest] for r in group if r.record_type == "revisit")
    assert all(r.record_type == "response" and r.refers_to is None for r in rows if r.payload_bytes < 100)
    assert len({r.record_id for r in rows}) == len(rows)


@pytest.mark.parametrize("most", [1, 700, 5000])
def test_tasks_begin_new_archives(spark, most):
    rows = [(i, f"http://a.com/{i}", f"<p>{i % 70} " + "long words " * (i % 13 * 10) + "</p>") for i in range(300)]
    table = pages(spark, rows).coalesce(1)
    folder, warc = new_folder(spark, "test-arc"), new_folder(spark, "test-warc")
    w.write_arc(table, folder, most=most)
    files = sorted(Path(folder).glob("part-*"))
    sizes, found = [], []
    for file in files:
        content = gzip.decompress(file.read_bytes())
        sizes.append(len(content))
        own = list(w.arc_records(file.read_bytes()))
        assert content.startswith(b"filedesc://") and own
        assert all(int(r.headers.get("Offset", r.offset)) == r.offset for r in own)
        found += [r.headers["URL"] for r in own]
    assert sorted(found) == sorted(u for _, u, _ in rows)
    assert len(files) > 10 and max(sizes) <= most + 2200
    w.convert(spark, folder, warc, most=most)
    packed = [gzip.decompress(f.read_bytes()) for f in Path(warc).glob("part-*")]
    assert len(packed) > 10 and all(c.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for c in packed)
    assert max(map(len, packed)) <= most + 3000
    many = {(r.key, r.payload_digest, r.record_type, r.refers_to) for r in w.round_trip(table, most).collect()}
    assert many == {(r.key, r.payload_digest, r.record_type, r.refers_to) for r in w.round_trip(table).collect()}
    assert len(many) == len(rows)


def test_empty_table(spark):
    assert w.round_trip(pages(spark, [])).count() == 0


def test_query_against_sql(spark):
    import testbed.check as check
    from watchlytics.llm.queries import ORACLES, QUERIES

    check.QUERIES.update({"op3_warc": QUERIES["op3_warc"]})
    try:
        assert compare(spark, duckdb_tables(SF), SF, "op3_warc", ORACLES["op3_warc"]) == ""
    finally:
        del check.QUERIES["op3_warc"]


def archive(version, records, end=b"\n"):
    out = w.version_block("old.arc", version, "19970102030405") + b"\n"
    for url, stamp, body in records:
        out += w.arc_header(url, "1.2.3.4", stamp, "text/html", len(body), version) + body + end
    return out


RECORDS = [
    ("http://a.com/with space", "19961113101500", b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n<p>\n\n1 2 3 4 5\n</p>"),
    ("dns:a.com", "1996", b"19961113 a.com. IN A 1.2.3.4\n"),
    ("http://b.com/", "bad", b""),
    ("http://c.com/", "19991331000000", b"HTTP/1.0 200 OK\r\nX: \xff\xfe no end of head"),
    ("http://d.com/", "20010101", b"\x00\xff" * 50),
]


@pytest.mark.parametrize("version", ["1", "2"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_both_versions(version, pack):
    found = list(w.arc_records(pack(archive(version, RECORDS))))
    assert [(r.headers["URL"], r.headers["Archive-date"], r.block) for r in found] == RECORDS
    names = w.FIELDS[version].split(" ")
    assert all(list(r.headers) == names for r in found)


def test_members_packed_one_by_one():
    content = gzip.compress(w.version_block("x", "2", "1999") + b"\n")
    for url, stamp, body in RECORDS:
        content += gzip.compress(w.arc_header(url, "1.2.3.4", stamp, "text/html", len(body), "2") + body + b"\n")
    assert [r.block for r in w.arc_records(content)] == [b for *_, b in RECORDS]


def test_damaged_archives_are_refused():
    whole = archive("1", RECORDS)
    with pytest.raises(ValueError):
        list(w.arc_records(whole[:-30]))
    with pytest.raises(ValueError):
        list(w.arc_records(w.version_block("x", "1", "1999") + b"\nno header line\n"))
    with pytest.raises(ValueError):
        list(w.arc_records(w.version_block("x", "1", "1999").replace(b"1 0 ", b"9 0 ")))


def test_time_stamps():
    assert w.iso_time("19961113101500") == "1996-11-13T10:15:00Z"
    assert w.iso_time("1996") == "1996-01-01T00:00:00Z"
    assert w.iso_time("199613") == w.iso_time("x") == w.iso_time("") == "1970-01-01T00:00:00Z"


def test_foreign_archives_become_warc(spark, tmp_path):
    for version, name in (("1", "a.arc"), ("2", "b.arc.gz")):
        content = archive(version, RECORDS)
        (tmp_path / name).write_bytes(gzip.compress(content) if name.endswith("gz") else content)
    out = new_folder(spark, "test-warc")
    w.convert(spark, str(tmp_path), out)
    found = w.read_warc(spark, out).collect()
    assert len(found) == 2 * len(RECORDS)
    by_url = {(r.url, r.payload_digest) for r in found}
    assert ("http://d.com/", hashlib.sha256(b"\x00\xff" * 50).hexdigest()) in by_url
    assert ("http://a.com/with space", hashlib.sha256(b"<p>\n\n1 2 3 4 5\n</p>").hexdigest()) in by_url
    again = new_folder(spark, "test-warc")
    w.convert(spark, str(tmp_path), again)
    assert {r.record_id for r in w.read_warc(spark, again).collect()} == {r.record_id for r in found}


@pytest.mark.parametrize("version", ["1", "2"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_pages_with_the_url_of_a_version_block(version, pack):
    records = [*RECORDS, ("filedesc://page", "2001", b"HTTP/1.1 200 OK\r\n\r\nx"), ("filedesc://list", "2001", b"1 two three"), RECORDS[0]]
    other = archive("2" if version == "1" else "1", RECORDS)  # archives may be joined, each with its version block
    found = list(w.arc_records(pack(archive(version, records)) + pack(other)))
    assert [(r.headers["URL"], r.headers["Archive-date"], r.block) for r in found] == records + RECORDS


def test_round_trip_of_pages_with_the_url_of_a_version_block(spark):
    rows = [(1, "filedesc://a.arc", "<p>page</p>"), (2, "filedesc://b", None), (3, "http://a.com/", "x")]
    assert sorted(r.key for r in w.round_trip(pages(spark, rows)).collect()) == [1, 2, 3]
