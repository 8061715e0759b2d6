"""SimHash against brute force: fingerprints, links, components, and the document that stays."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_helpers import AWKWARD, SF, clashing, documents, fetch
from watchlytics.llm import components, simhash


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def slow_components(codes, limit=4):
    parent = {c: c for c in codes}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    codes = sorted(codes)
    for i, a in enumerate(codes):
        for b in codes[:i]:
            if (a ^ b).bit_count() <= limit:
                parent[root(a)] = root(b)
    return {c: root(c) for c in codes}


def near_codes(seed, n, centres=6, most=7):
    rng = np.random.default_rng(seed)
    base = rng.integers(0, 2**63, size=centres, dtype=np.uint64)
    codes = base[rng.integers(0, centres, n)].copy()
    for i in range(n):
        for _ in range(rng.integers(0, most)):
            codes[i] ^= np.uint64(1) << np.uint64(rng.integers(0, 64))
    return np.unique(codes)


def sets_of(pairs):
    groups = {}
    for a, b in pairs:
        groups.setdefault(b, set()).add(a)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("text", [None, "", " \n", "A b", "a b c d", "Ab aB ab AB ab ab ab", "É é x y z w"])
def test_small_fingerprints(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_spark_uses_the_same_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three four")).alias("h")).first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest("one two three four", 42)


@pytest.mark.parametrize("seed", range(6))
def test_forest_has_the_components_of_all_links(seed):
    codes = near_codes(seed, 400)
    u, v = simhash.linked_forest(codes, np.zeros(len(codes), int), np.zeros(len(codes), int), 4)
    assert len(u) < len(codes)
    own = {int(c): int(c) for c in codes}

    def root(c):
        while own[c] != c:
            c = own[c]
        return c

    for a, b in zip(u.tolist(), v.tolist()):
        own[root(a)] = root(b)
    assert sets_of((c, root(c)) for c in own) == sets_of(slow_components([int(c) for c in codes]).items())


def test_gray_neighbours_differ_in_one_bit():
    codes = np.arange(256, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert set(np.bitwise_count(ordered[1:] ^ ordered[:-1]).tolist()) == {1}


@pytest.mark.parametrize("chunk", [5, 4096])
def test_components_across_buckets_and_chunks(spark, chunk):
    codes = near_codes(9, 300, centres=4)
    signed = codes.view(np.int64).tolist()
    fps = spark.createDataFrame([(i, c) for i, c in enumerate(signed)], "doc_id long, fp long")
    found = simhash.near_duplicates(fps, "doc_id", chunk=chunk)
    got = {r.doc_id: r.component for r in found.collect()}
    want = slow_components([int(c) for c in codes])
    least = {}
    for i, c in enumerate(codes.tolist()):
        least[want[c]] = min(least.get(want[c], i), i)
    assert got == {i: least[want[c]] for i, c in enumerate(codes.tolist())}


def test_query_on_whole_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    found = simhash.near_duplicates(simhash.fingerprints(docs).select("doc_id", "fp"), "doc_id")
    got = {r.doc_id: (r.h, r.component) for r in found.select("doc_id", "component", simhash.as_hex(F.col("fp")).alias("h")).collect()}
    codes = {i: slow_fingerprint(t) for i, t in fetch(f"SELECT doc_id, text FROM '{SF}/documents.parquet'")}
    roots = slow_components(set(codes.values()))
    least = {}
    for i, c in codes.items():
        least[roots[c]] = min(least.get(roots[c], i), i)
    assert got == {i: (f"{c:016x}", least[roots[c]]) for i, c in codes.items()}


def test_chain_of_links_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7000, 7000)]
    found = components.components(spark.createDataFrame(chain, "u long, v long"))
    got = {r.node: r.root for r in found.collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(50)}, 7000: 7000}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = clashing(documents(spark), "fp", "key", "file", "place", "component", "bucket")
    kept = simhash.near_unique(docs)
    assert kept.columns == docs.columns
    # 1, 2 and 3 have no words; 4, 4, 6 and the nameless row have equal words
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 7, 8, 9]
    assert simhash.near_unique(documents(spark, [])).count() == 0
    nameless = documents(spark, [(None, "a b c", None, None, None)] * 3)
    assert simhash.near_unique(nameless).count() == 1


def test_awkward_rows_have_fingerprints(spark):
    found = simhash.fingerprints(clashing(documents(spark), "FP"))
    assert found.columns[-1] == "fp" and found.count() == len(AWKWARD)
    assert {r.doc_id: r.fp for r in found.collect()}[1] == 0


def test_a_bucket_of_far_more_than_64_chunks(spark):
    """All codes share two blocks; each pair of chunks stays small and no link is lost."""
    rng = np.random.default_rng(8)
    codes = np.unique(rng.integers(0, 1 << 13, 700, dtype=np.uint64))
    nodes = spark.createDataFrame([(int(c),) for c in codes.tolist()], "fp long")
    links = {(r.u, r.v) for r in simhash.near_links(nodes, chunk=6).collect()}
    assert len(codes) / 6 > 100
    own = {int(c): int(c) for c in codes}

    def root(c):
        while own[c] != c:
            c = own[c]
        return c

    for u, v in links:
        own[root(u)] = root(v)
    assert sets_of((c, root(c)) for c in own) == sets_of(slow_components([int(c) for c in codes]).items())
    held = simhash.dealt_out(nodes, 6).groupBy("bucket", "pair").count().agg(F.max("count")).first()[0]
    assert held <= 40  # two chunks of six on average
