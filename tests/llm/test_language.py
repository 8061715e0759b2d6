"""Language identification: held-out accuracy, Viterbi against plain loops, awkward rows."""

import numpy as np
import pytest

from llm_helpers import AWKWARD, clashing, documents, fetch
from watchlytics.llm import language as g
from watchlytics.llm.queries import op7_language_id

SF = "/root/testdata/sf0.01"


def slow_viterbi(scores, switch):
    value, back = scores[0].astype(float), []
    for row in scores[1:]:
        step = [max((value[a] - switch * (a != b), -abs(a - b) == 0, -a) for a in range(len(value))) for b in range(len(value))]
        back.append([-s[2] for s in step])
        value = np.array([s[0] for s in step]) + row
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1], float(value.max())


def total(scores, path, switch):
    return sum(scores[t, s] for t, s in enumerate(path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(0)
    lengths = np.array([5, 0, 17, 1, 60, 2])
    scores = -rng.exponential(4, size=(int(lengths.sum()), 3)).astype(np.float32)
    path = g.viterbi(scores, lengths, 3.0)
    at = 0
    for n in lengths.tolist():
        if n:
            part = scores[at : at + n].astype(float)
            best = slow_viterbi(part, 3.0)[1]
            assert abs(total(part, path[at : at + n].tolist(), 3.0) - best) < 1e-3
        at += n


def test_held_out_accuracy(spark):
    found = {r.doc_id: r for r in op7_language_id(spark, SF).collect()}
    langs = fetch(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'")
    held = [(found[i].lang_pred, lang) for i, lang in langs if found[i].held_out and lang]
    assert len(found) == len(langs) and len(held) > 100
    assert np.mean([a == b for a, b in held]) > 0.99


@pytest.fixture(scope="module")
def model(spark):
    rows = [
        (1, "the and of that with for this from they have been", "en", None, 0),
        (2, "der die das und nicht mit ein auch sich auf werden", "de", None, 0),
        (3, "и не что он на я с как это по", "ru", None, 0),
        (4, None, "xx", None, 0),
        (5, "no language here", None, None, 0),
    ]
    return g.learn(documents(spark, rows))


def test_spans_of_mixed_text(spark, model):
    assert model.languages == ["de", "en", "ru"]
    text = "the and of that with for this. 123 der die das und nicht mit ein auch! что это не как"
    [(lang, score, spans)] = g.label_texts([text], model, switch=3.0)
    assert [(text[a:b], x) for a, b, x in spans] == [
        ("the and of that with for this", "en"),
        ("der die das und nicht mit ein auch", "de"),
        ("что это не как", "ru"),
    ]
    assert lang == "de" and 0.3 < score < 0.6


def test_script_narrows_candidates(model):
    assert g.label_texts(["щщщ"], model)[0][0] == "ru"
    assert g.label_texts(["qqq"], model)[0][0] in ("de", "en")


def test_awkward_rows(spark, model):
    docs = clashing(documents(spark), "lang_pred", "SPANS", "score")
    found = g.label_spans(docs, model)
    assert found.count() == len(AWKWARD)
    rows = {r.doc_id: r for r in found.collect()}
    for i in (1, 2, 3):
        assert (rows[i].lang_pred, rows[i].score, rows[i].spans) == ("und", 0.0, [])
    assert rows[7].lang_pred == "en" and 0 < rows[7].score <= 1
    assert g.label_spans(documents(spark, []), model).count() == 0


def test_nothing_learnt(spark):
    nothing = g.learn(documents(spark, [(1, "x", None, None, 0)]))
    assert nothing.languages == []
    assert {r.lang_pred for r in g.label_spans(documents(spark), nothing).collect()} == {"und"}


def many(n):
    rng = np.random.default_rng(7)
    logs = np.log(rng.random((1 << g.BUCKET_BITS, n)) + 1e-3).astype(np.float32)
    return g.Model([f"l{i:03d}" for i in range(n)], logs, np.ones((len(g.SCRIPTS) + 1, n), bool))


def test_slices_change_nothing(monkeypatch):
    model = many(5)
    texts = ["one two_three 4four fünf щщщ, a" * 40, "x" * 3000, "", " .", "a b " * 500 + "é" * 700 + "z"]
    want = g.label_texts(texts, model, 3.0)
    scores = [g.score_words(t, model)[2] for t in texts]
    monkeypatch.setattr(g, "SLICE", 7)
    monkeypatch.setattr(g, "LETTERS_AT_ONCE", 3)
    for a, t in zip(scores, texts):
        assert np.allclose(a, g.score_words(t, model)[2], rtol=1e-4)
    found = g.label_texts(texts, model, 3.0)
    assert [(x, spans) for x, _, spans in found] == [(x, spans) for x, _, spans in want]


def test_scores_are_sums_over_the_letters():
    model = many(3)
    text = "Ab cde, щэ"
    bucket, _, starts, ends, firsts = g.words_of(text)
    s, e, scores = g.score_words(text, model)
    assert [text[a:b] for a, b in zip(s, e)] == ["Ab", "cde", "щэ"]
    for k, (first, n) in enumerate(zip(firsts, e - s)):
        assert np.allclose(scores[k], sum(model.logs[x] for x in bucket[first : first + n]))


def test_long_text_under_many_languages():
    """A million characters under 100 languages: what is held follows the words, not letters times languages."""
    import tracemalloc

    text = "some words of a very long text " * 31_000
    model = many(100)
    tracemalloc.start()
    [(lang, _, _)] = g.label_texts([text], model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    words = len(text.split())
    assert lang.startswith("l") and peak < 2.5 * words * 100 * 4 + 60e6 < 4 * 100 * len(text), peak


def test_learnt_counts_against_plain_ones(spark):
    """Letters and trigrams counted one by one, whatever the slices."""
    rows = [(1, "Abc abc é1x", "a", None, 0), (2, "abc" * 50, "a", None, 0), (3, "щ abc", "b", None, 0)]
    model = g.learn(documents(spark, rows))
    size = 1 << g.BUCKET_BITS
    for k, lang in enumerate(("a", "b")):
        counts, scripts = np.zeros(size), np.zeros(len(g.SCRIPTS) + 1)
        for _, text, own, *_ in rows:
            if own == lang:
                bucket, script, *_ = g.words_of(text)
                for x, y in zip(bucket.tolist(), script.tolist()):
                    counts[x] += 1
                    scripts[y] += 1
        assert np.allclose(model.logs[:, k], np.log((counts + 0.5) / (counts.sum() + 0.5 * size)), rtol=1e-5)
        assert (model.scripts[:, k] == (scripts >= max(1, g.SCRIPT_SHARE * scripts.sum()))).all()
