"""Quality classifier: held-out accuracy, the discriminant itself, awkward rows."""

import re
import time
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_helpers import AWKWARD, clashing, documents
from watchlytics.llm import quality as q
from watchlytics.llm.common import fold_of, table
from watchlytics.llm.queries import op5_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = op5_quality_classifier(spark, SF)
    labels = table(spark, SF, "labels").where("quality IS NOT NULL")
    rows = found.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.97
    assert found.count() == table(spark, SF, "documents").count()
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_folds_are_crc32(spark):
    import zlib

    df = spark.range(50).withColumn("fold", fold_of(F.col("id")))
    assert all(r.fold == zlib.crc32(str(r.id).encode()) % 4 for r in df.collect())


def test_discriminant_is_the_difference_of_log_densities():
    rng = np.random.default_rng(0)
    x = [rng.normal(size=(300, 3)) @ np.diag([1, 2, 3]), rng.normal(size=(500, 3)) + 1]
    model = q.discriminant(
        np.array([300.0, 500.0]), np.array([v.sum(axis=0) for v in x]), np.array([v.T @ v for v in x]), 0.1, 0.2
    )
    common = sum((v - v.mean(axis=0)).T @ (v - v.mean(axis=0)) for v in x) / 800

    def log_density(point, k):
        own = np.cov(x[k].T, bias=True) * 0.9 + 0.1 * common
        own = 0.8 * own + 0.2 * np.diag(np.diag(own)) + np.eye(3) * q.LEAST_DEVIATION**2
        gap = point - x[k].mean(axis=0)
        return -0.5 * gap @ np.linalg.inv(own) @ gap - 0.5 * np.log(np.linalg.det(own)) + np.log(len(x[k]) / 800)

    for point in rng.normal(size=(10, 3)):
        want = 1 / (1 + np.exp(log_density(point, 0) - log_density(point, 1)))
        assert abs(model.scores(point[None])[0] - want) < 1e-9


def test_fit_sums_in_spark(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, len(q.FEATURES))), rng.integers(0, 2, 40)
    df = spark.createDataFrame([(v.tolist(), int(k)) for v, k in zip(x, y)] + [([0.0] * len(q.FEATURES), None)], "features array<double>, label int")
    model = q.fit(df)
    own = [x[y == k] for k in (0, 1)]
    want = q.discriminant(np.array([len(v) for v in own], float), np.array([v.sum(axis=0) for v in own]), np.array([v.T @ v for v in own]))
    assert np.allclose(model.means, want.means) and np.allclose(model.whiten, want.whiten)


def test_one_class_or_none(spark):
    schema = "features array<double>, label int"
    row = [0.5] * len(q.FEATURES)
    assert q.fit(spark.createDataFrame([], schema)).scores(np.zeros((2, 12))).tolist() == [0.5, 0.5]
    assert q.fit(spark.createDataFrame([(row, 1)], schema)).scores(np.zeros((1, 12))).tolist() == [1.0]


def test_awkward_rows(spark):
    docs = clashing(documents(spark), "FEATURES", "score", "label")
    featured = q.features(docs)
    model = q.train(featured, spark.createDataFrame([(4, 1, 0), (9, 0, 0), (None, 1, 0), (8, None, 1), (99, 1, 1), (3, 0, 0), (7, 1, 0)], "doc_id long, quality int, toxic int"))
    scored = q.score(featured, model)
    assert scored.count() == len(AWKWARD) and scored.where("score IS NULL").count() == 0
    texts = q.score_texts(docs, model, "quality_score")
    assert texts.columns == [*docs.columns, "quality_score"]
    by_id = {}
    for r in texts.collect():
        by_id.setdefault(r.text, set()).add(r.quality_score)
    assert all(len(s) == 1 for s in by_id.values()) and by_id[None] == by_id[""]
    assert q.features(documents(spark, [])).count() == 0


def plainly(text):
    """All statistics, written out one by one."""
    text = text or ""
    words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
    letters = [c for c in text if c.isalpha()]
    marks = [c for c in text if not (c.isalnum() and (c.isalpha() or c.isdigit())) and not c.isspace() and c not in ".,;:?'\"-()"]
    marks = [c for c in marks if not c.isalpha() and not c.isdigit()]

    def share(a, b):
        return np.log((a + 0.5) / (b + 1.0))

    runs = 0  # runs of two marks or more, none of them a sign of prose, that stand before white space or the end
    for is_mark, run in groupby(text + "\n", lambda c: re.match(r"[^\w\s.,;:?!'\")]", c) is not None):
        if is_mark:
            last = len(list(run))
        else:
            first = next(run)
            runs += locals().get("last", 0) >= 2 and first.isspace()
        if not is_mark:
            last = 0
    raw = text.encode()
    return [
        np.log(1 + len(words)),
        share(sum(c.isupper() for c in letters), len(letters)),
        share(len(marks), len(text)),
        share(text.count("|"), len(words)),
        share(text.count("!"), len(words)),
        share(sum(c.isdigit() and not c.isalpha() for c in text), len(text)),
        share(sum(a == b for a, b in zip(words, words[1:])), len(words)),
        share(max((words.count(w) for w in set(words)), default=0), len(words)),
        share(len(words) - len(set(words)), len(words)),
        np.log(1 + len(letters) / len(words)) if words else 0.0,
        share(len(lines) - len(set(lines)), len(lines)),
        share(runs, len(words)),
        share(sum(x.rstrip()[-1] in ".!?:;\"'" for x in lines), len(lines)),
        share(len(raw) - len(text), len(text)),
        share(len(zlib.compress(raw, 1)), len(raw)),
    ]


def test_statistics_against_a_plain_version(spark):
    texts = [t for _, t, *_ in AWKWARD if t is None or len(t) < 10_000]
    texts += [r.text for r in table(spark, SF, "documents").select("text").limit(150).collect() if len(r.text or "") < 5000]
    texts += ["a -- b", "## x ##", "a##b ##\n==", "***!", "!!", "|| |", "##.", "## \n", "A-A --- é\u2003--", "x\n\nx.\n x?\n"]
    for text in texts:
        assert np.allclose(q.statistics(text), plainly(text)), text


@pytest.mark.parametrize("text", ["#" * 1_000_000 + "a", "# " * 500_000, "=" * 500_000 + "." * 500_000, "-=" * 500_000, "a" * 1_000_000])
def test_statistics_take_linear_time(text):
    begin = time.perf_counter()
    q.statistics(text)
    assert time.perf_counter() - begin < 4


def test_shrinkage_follows_the_data():
    rng = np.random.default_rng(2)
    few, many = (q.shrinkage(n, np.cov(rng.normal(size=(n, 6)).T, bias=True)) for n in (12, 100_000))
    assert 0.5 < few[0] < 0.8 and many[0] < 0.001  # 21 parameters
    assert few[1] > many[1] or many[1] == 1.0
    tied = np.full((6, 6), 0.9) + 0.1 * np.eye(6)
    assert q.shrinkage(100_000, tied)[1] < 0.001 < q.shrinkage(10, tied)[1] < 0.5
    assert q.shrinkage(1, np.zeros((3, 3)))[1] == 1.0


def test_training_on_texts(spark):
    """All labelled texts below the bound; above it those that a hash picks, whatever the repeats."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    every = q.train(q.features(docs.select("doc_id", "text")), labels)
    assert np.allclose(q.train_texts(docs, labels).means, every.means)
    twice = q.train_texts(docs, labels.union(labels))
    assert np.allclose(twice.means, every.means) and np.allclose(twice.log_priors, every.log_priors)
    some = q.train_texts(docs, labels, 300)
    assert not np.allclose(some.means, every.means)
    x = np.array([q.statistics(r.text) for r in docs.select("text").limit(200).collect()])
    assert ((some.scores(x) >= 0.7) == (every.scores(x) >= 0.7)).mean() > 0.97
    assert q.train_texts(docs, labels.limit(0)).constant == 0.5
