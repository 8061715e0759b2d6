"""Merge-type SentencePiece against the sentencepiece library, on whole texts, random strings and edge cases."""

import hashlib
import io
import random
import time

import numpy as np
import pytest
import public_tokenizers
import sentencepiece

from llm_helpers import AWKWARD, SF, clashing, documents, fetch
from watchlytics.llm import piece_bpe, queries


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def own():
    return piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))


EDGES = [
    "", " ", "  a", "  ", "a" * 3001, "ab" * 500, "<s></s><unk>", "<0x0A>", "\n", "\n\n x\t", "a▁b", "▁", "▁▁ ▁x", "\x00", "a\x00b",
    "�", "漢字かな", "é‍", "\U0001f600\U0001f600", "12345 67", "　x", " " * 100 + "x" + " " * 33, "é", "‮abc", "it's, (word). -- \"x\"",
]


@pytest.mark.parametrize("text", EDGES + [t for _, t, *_ in AWKWARD if t])
def test_same_ids_and_text_as_the_library(library, own, text):
    want = library.encode(text, add_bos=True, add_eos=True)
    assert own.encode(text) == want
    assert own.decode(want) == library.decode(want)


def test_every_character(library, own):
    texts = ["a" + chr(c) + " " + chr(c) + "1" for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    assert [own.encode(t, False, False) for t in texts] == library.encode(texts)


def test_random_strings(library, own):
    random.seed(11)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, len(library), 13)]
    texts = ["".join(random.choices(" \n.,abcdeilnorst▁éß漢", k=random.randrange(60))) for _ in range(4000)]
    texts += ["".join(random.choices(pieces, k=random.randrange(12))) for _ in range(4000)]
    want = library.encode(texts, add_bos=True, add_eos=True)
    assert [own.encode(t) for t in texts] == want
    assert [own.decode(x) for x in want] == library.decode(want)


def test_random_ids(library, own):
    random.seed(12)
    lists = [[random.choice((0, 1, 2, 259, 28705, random.randrange(3, 259), random.randrange(32000))) for _ in range(random.randrange(9))] for _ in range(5000)]
    assert [own.decode(x) for x in lists] == library.decode(lists)


@pytest.mark.parametrize("options", [{}, {"byte_fallback": True}, {"add_dummy_prefix": False}, {"split_by_whitespace": False}])
def test_other_models(tmp_path, options):
    """Vocabularies made for this test alone: unknown characters, no first space, pieces over spaces."""
    random.seed(13)
    lines = [" ".join(random.choices(["aba", "abba", "bab", "cab", "ab", "b"], k=8)) for _ in range(300)]
    target = io.BytesIO()
    size = 300 if options.get("byte_fallback") else 40
    sentencepiece.SentencePieceTrainer.train(
        sentence_iterator=iter(lines), model_writer=target, model_type="bpe", vocab_size=size, hard_vocab_limit=False, minloglevel=2,
        normalization_rule_name="identity", remove_extra_whitespaces=False, **options,
    )
    library = sentencepiece.SentencePieceProcessor(model_proto=target.getvalue())
    own = piece_bpe.Codec(target.getvalue())
    texts = ["".join(random.choices("aabbc  \nxyé", k=random.randrange(30))) for _ in range(2000)]
    want = library.encode(texts, add_bos=True, add_eos=True)
    assert [own.encode(t) for t in texts] == want
    assert [own.decode(x) for x in want] == library.decode(want)


def test_other_kinds_are_refused(own):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto.FromString(piece_bpe.read_model(piece_bpe.default_model()))
    for change in ("trainer_spec.model_type=1", "normalizer_spec.remove_extra_whitespaces=1"):
        other = sentencepiece_model_pb2.ModelProto.FromString(model.SerializeToString())
        path, value = change.split("=")
        part, field = path.split(".")
        setattr(getattr(other, part), field, int(value))
        with pytest.raises(ValueError):
            piece_bpe.Codec(other.SerializeToString())


@pytest.mark.parametrize("limit", [0, 5, 10**6])
def test_both_agendas_give_the_same(library, monkeypatch, limit):
    monkeypatch.setattr(piece_bpe, "LIST_UP_TO", limit)
    fresh = piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))
    random.seed(14)
    texts = [*EDGES, *("".join(random.choices("aeinrstlo ▁é漢.,", k=random.randrange(40))) for _ in range(2000))]
    assert [fresh.encode(t) for t in texts] == library.encode(texts, add_bos=True, add_eos=True)


@pytest.mark.parametrize("options", [{}, {"FEW": 1}, {"FEW": 1, "LIST_UP_TO": 5}, {"FEW": 1, "SLICE": 100, "STRETCHES": 50, "LONGEST_KEPT": 4}])
def test_texts_side_by_side(own, library, monkeypatch, options):
    for name, value in options.items():
        monkeypatch.setattr(piece_bpe, name, value)
    fresh = piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))
    random.seed(15)
    texts = ["".join(random.choices("aeinrstlo   ▁é漢.,\n", k=random.randrange(200))) for _ in range(3000)] + EDGES
    want = [np.array(x, "<u4").tobytes() for x in library.encode(texts, add_bos=True, add_eos=True)]
    assert fresh.encode_texts(texts) == want
    assert fresh.encode_texts(texts[::-1]) == want[::-1]
    assert fresh.encode_texts([]) == []
    assert len(fresh.memory) <= piece_bpe.STRETCHES // 2 and all(len(s) <= piece_bpe.LONGEST_KEPT for s in fresh.memory)


def test_punctuation_makes_no_new_stretches():
    """Each word is merged once, whatever stands before and behind it, unless a piece reaches over."""
    fresh = piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))
    given, merged = [], fresh.memory.merged
    fresh.memory.merged = lambda stretches: given.extend(stretches) or merged(stretches)
    words = [f"{a}{b}{c}ation" for a in "bdfgl" for b in "aeiou" for c in "mnrst"]
    text = " ".join(word + mark for word in words for mark in ("", ",", "!", "?", "…", ";", "”"))
    fresh.encode(text)
    assert len(given) <= len(words) + 20


@pytest.mark.parametrize("slots", [1, 1 << 13, 1 << 22])
def test_cuts_where_no_piece_reaches_over(library, monkeypatch, slots):
    monkeypatch.setattr(piece_bpe, "SLOTS", slots)
    fresh = piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))
    random.seed(16)
    texts = ["".join(random.choices("aeinrst(),.' \n▁éß漢\U0001f600\x00", k=random.randrange(80))) for _ in range(1000)] + EDGES
    stretches, upto = fresh.cut(texts)
    stretches, begin, sides = stretches.to_pylist(), 0, set()
    for text, end in zip(texts, upto.tolist()):
        own = stretches[begin:end]
        assert "".join(own) == (" " + text if text else "")
        sides |= {(a[-1] + b[0]).replace(" ", "▁") for a, b in zip(own, own[1:])}
        begin = end
    assert end == len(stretches) and (len(sides) > 50 or slots == 1)
    assert not any(side in piece for piece in fresh.ids for side in sides)
    want = library.encode(texts, add_bos=True, add_eos=True)
    packed = [np.array(x, "<u4").tobytes() for x in want]
    assert fresh.encode_texts(texts) == packed
    assert fresh.decode_texts(packed) == library.decode(want)
    assert fresh.encode_texts(["", ""]) == 2 * [packed[texts.index("")]]
    assert fresh.decode_texts([b"", b""]) == ["", ""] and fresh.decode_texts([]) == []


def test_long_stretch_takes_no_square_time(own, library):
    text = "ab" * 150_000
    begin = time.perf_counter()
    found = own.encode(text)
    assert time.perf_counter() - begin < 20
    assert found == library.encode(text, add_bos=True, add_eos=True)


def test_memory_is_bounded(own, monkeypatch):
    monkeypatch.setattr(piece_bpe, "STRETCHES", 10)
    small = piece_bpe.Codec(piece_bpe.read_model(piece_bpe.default_model()))
    text = " ".join(f"word{i} again" for i in range(50))
    assert small.encode(text) == own.encode(text) and len(small.memory) <= 5 and len(small.memory.older) <= 5


def test_query_on_whole_documents(spark, library):
    found = {r.doc_id: r for r in queries.op11_sentencepiece_encoding_and_decoding(spark, SF).collect()}
    rows = fetch(f"SELECT doc_id, coalesce(text, '') FROM '{SF}/documents.parquet'")
    assert len(found) == len(rows)
    for (doc_id, text), ids in zip(rows, library.encode([t for _, t in rows], add_bos=True, add_eos=True)):
        r = found[doc_id]
        assert r.n_tokens == len(ids) and r.agrees
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_check_tells_a_wrong_row(library):
    texts = ["right", "wrong"]
    ids = library.encode(texts, add_bos=True, add_eos=True)
    packed = [np.array(x, "<u4").tobytes() for x in ids]
    packed[1] = packed[1][:-4]
    assert piece_bpe.agreeing(library, texts, packed, texts, True, True) == [True, False]
    assert piece_bpe.agreeing(library, texts[:1], packed[:1], ["other"], True, True) == [False]


def test_round_trip_of_awkward_rows(spark):
    docs = clashing(documents(spark), "IDS", "decoded", "encoded_text", "Agrees")
    encoded = piece_bpe.encode_documents(docs, check=True)
    assert encoded.columns == [*docs.drop("IDS", "Agrees").columns, "ids", "agrees"]
    back = piece_bpe.decode_documents(encoded)
    got = sorted(((r.doc_id or 0, r.text or "", r.decoded) for r in back.collect()), key=repr)
    assert got == sorted(((d or 0, t or "", t or "") for d, t, *_ in AWKWARD), key=repr)
    assert back.where("agrees and encoded_text = 'own encoded_text'").count() == len(AWKWARD)


def test_empty_table_and_null_ids(spark):
    empty = documents(spark, [])
    assert piece_bpe.digest_documents(empty).count() == 0
    assert piece_bpe.decode_documents(piece_bpe.encode_documents(empty, check=True)).count() == 0
    df = spark.createDataFrame([(1, None), (2, []), (3, [1, 2])], "doc_id long, ids array<int>")
    assert {r.decoded for r in piece_bpe.decode_documents(df).collect()} == {""}
