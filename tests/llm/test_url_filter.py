"""URL filter: rules against plain Python, trees on labelled URLs they have not seen."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from llm_helpers import clashing, fetch
from watchlytics.llm import url_filter as u

SF = "/root/testdata/sf0.01"
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "HTTP://www.Example.COM/en/x?y=/fr/#z",
    "http://badexample.com/en/", "ftp://a.net/fr/", "http://a.net?x=/fr/", "http://a.net#/es/", "x://y.net/es", "http://com/en/",
    "http://ÄÖ.net/fr/ü", "a://b.com://c.net/fr/", "http://h.org/" + "p/" * 5000, "http://u:p@x.example.com:80/en/1", "http://m.www.example.com/en/1",
    "two\nlines://a.net/es/\nq?z", "://net/fr/",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((i for c in "/?#" if (i := rest.find(c)) >= 0), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?", 1)[0].split("#", 1)[0]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_rules(spark):
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(URLS)], "page_id long, url string")
    found = {r.page_id: r for r in u.judge(clashing(pages, "HOST", "verdict", "u_host", "rule")).collect()}
    assert len(found) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = plain(url)
        r = found[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_whole_pages(spark):
    from watchlytics.llm.queries import op10_url_filters

    found = {r.page_id: r for r in op10_url_filters(spark, SF).collect()}
    rows = fetch(f"SELECT page_id, url FROM '{SF}/pages.parquet'")
    assert len(found) == len(rows)
    for page_id, url in rows:
        host, path, rule, verdict = plain(url)
        r = found[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or r.verdict) and r.verdict in ("allow", "block")


def test_trees_on_urls_not_seen(spark):
    """Learnt from three quarters of the URLs that a rule fits, judged on the rest."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    rows = u.with_features(pages)
    rule, verdict = u.matched(F.col("u_host"), F.col("u_path"))
    rows = rows.withColumn("known", verdict).where("known IS NOT NULL").withColumn("fold", F.pmod(F.xxhash64("page_id"), F.lit(4)))
    rows = u.with_rates(rows, *u.block_rates(rows.where("fold > 0"), "u_", "known"), "u_")
    model = u.train(rows.where("fold > 0"), "u_", "known")
    judged = model.trees.transform(u._vectors(rows.where("fold = 0"), "u_", "features"))
    got = [(r.prediction == 1.0, r.known == "block") for r in judged.select("prediction", "known").collect()]
    share = np.mean([b for _, b in got])
    assert len(got) > 200
    assert np.mean([a == b for a, b in got]) > max(share, 1 - share) + 0.05


def test_features(spark):
    url = "http://a.b.example.com/x1/y2/?p=1&q=22&&#f"
    r = u.with_features(spark.createDataFrame([(url,), (None,), (url,)], "url string")).where("url IS NOT NULL").first()
    counts = Counter(url)
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values())
    assert abs(r.u_entropy - entropy) < 1e-9
    assert (r.u_url_length, r.u_parameters, r.u_path_depth, r.u_has_fragment, r.u_suffix_length) == (len(url), 2.0, 3.0, 1.0, 3.0)
    assert abs(r.u_digit_ratio - sum(c.isdigit() for c in url) / len(url)) < 1e-9
    assert abs(r.u_domain_log_count - math.log1p(2)) < 1e-9


def test_few_or_no_labels(spark):
    schema = "page_id long, url string"
    assert u.judge(spark.createDataFrame([], schema)).count() == 0
    assert [r.verdict for r in u.judge(spark.createDataFrame([(1, None)], schema)).collect()] == ["allow"]
    one = spark.createDataFrame([(1, "http://a.net/fr/"), (2, "http://a.org/")], schema)
    assert {r.verdict for r in u.judge(one).collect()} == {"block"}


def test_no_python_on_the_executors(spark):
    text = u.judge(spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url"))._jdf.queryExecution().toString()
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_a_hot_url_neither_fills_the_bound_nor_goes_missing(spark):
    """A third of the labelled rows is one URL; the weights of the picked rows add up to about all rows."""
    n, most = 6000, 300
    for hot in range(4):
        values = [(0.0 if i < n // 3 else float(i), "block" if i < n // 3 or i % 2 else "allow") for i in range(n)]
        rows = spark.createDataFrame(values, "x double, verdict string")
        rows = rows.select("verdict", *((F.col("x") + hot).alias("u_" + f) for f in u.FEATURES))
        picked = u.weighted(rows, n, "u_", "verdict", most).collect()
        assert len(picked) <= 1.3 * most
        assert [r.weight for r in picked if r.u_url_length == hot] == [n // 3]
        assert abs(sum(r.weight for r in picked) - n) < 0.3 * n
    whole = u.weighted(rows, n, "u_", "verdict", n).collect()
    assert len(whole) == 1 + n - n // 3 and sum(r.weight for r in whole) == n
