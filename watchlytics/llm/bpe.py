"""Byte-level BPE: encode by a queue of merge ranks over a linked symbol list, decode by vocabulary.

``encode_documents`` adds the token ids of every text, ``decode_documents`` the text
of every id list; both work row by row inside map tasks, nothing is shuffled.
Null text counts as empty and has no tokens. Equal rows give equal results, an empty table gives no rows. A very long text is a
batch of its own; it needs memory in proportion to its length, its longest piece n log n steps.
The vocabulary file is read once on the driver and broadcast: it has a fixed size
that does not depend on the data.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from watchlytics.llm.common import bound_batches, free_name

#: How byte-level vocabularies cut text into pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same for texts below U+0250, with the letters, numbers and white space there spelled out: twice as fast.
LETTERS, NUMBERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
PLAIN_PIECES = re.compile(
    rf" ?[{LETTERS}]+|'(?:[stmd]|re|ve|ll)| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+"
    rf"|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
).findall
BEYOND = re.compile("[^\x00-ɏ]").search
#: Pieces kept with their ids in one worker; the memory is emptied when full, never the result.
MEMORY = 400_000
MEMORY_PIECE = 48


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_vocabulary(path: str) -> dict:
    """Content of a vocabulary file; its path is always a parameter."""
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def byte_symbols() -> list[str]:
    """The character that stands for each byte: printable ones for themselves, others from U+0100 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Memory(dict):
    """Packed ids of the pieces met so far; long pieces are never kept."""

    def __init__(self, merged):
        self.merged = merged

    def __missing__(self, piece: str) -> bytes:
        found = array("I", self.merged(piece.encode())).tobytes()
        if len(piece) <= MEMORY_PIECE:
            if len(self) >= MEMORY:
                self.clear()
            self[piece] = found
        return found


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, content: dict):
        model = content["model"]
        ids = model["vocab"]
        symbols = byte_symbols()
        as_byte = {s: b for b, s in enumerate(symbols)}
        self.size = size = max(ids.values()) + 1
        self.ranks, self.made = {}, []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.made.append(ids[left + right])
            self.ranks.setdefault(ids[left] * size + ids[right], rank)
        self.first = [ids[s] for s in symbols]
        special = {t["content"]: t["id"] for t in content.get("added_tokens") or []}
        self.special = special
        self.strings = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, number in ids.items():
            self.strings[number] = bytes(as_byte[c] for c in token)
        for token, number in special.items():
            self.strings[number] = token.encode()
        names = sorted(special, key=len, reverse=True)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pieces = regex.compile(PIECES).findall
        self.memory = Memory(self.merged)

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one piece: always merge the pair of the lowest rank, the leftmost first."""
        ids = [self.first[b] for b in piece]
        n, size, ranks = len(ids), self.size, self.ranks
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        # A queue entry is rank * n + place of the left symbol.
        queue = [
            rank * n + at
            for at, (a, b) in enumerate(zip(ids, ids[1:]))
            if (rank := ranks.get(a * size + b)) is not None
        ]
        heapify(queue)
        while queue:
            rank, at = divmod(heappop(queue), n)
            right = after[at]
            if right < 0 or ranks.get(ids[at] * size + ids[right]) != rank:
                continue  # stale: one of the two symbols has changed since
            ids[at] = made = self.made[rank]
            ids[right] = -size * size  # merged away: forms no pair any more
            after[at] = beyond = after[right]
            if beyond >= 0:
                before[beyond] = at
                if (rank := ranks.get(made * size + ids[beyond])) is not None:
                    heappush(queue, rank * n + at)
            left = before[at]
            if left >= 0 and (rank := ranks.get(ids[left] * size + made)) is not None:
                heappush(queue, rank * n + left)
        return [x for x in ids if x >= 0]

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for part in self.specials.split(text) if self.specials else (text,):
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
            elif part:
                pieces = self.pieces(part) if BEYOND(part) else PLAIN_PIECES(part)
                out.extend(map(self.memory.__getitem__, pieces))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode_to_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids))

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return self.decode_to_bytes(ids).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


class Shared:
    """A vocabulary broadcast to the workers; each worker builds its codec once."""

    def __init__(self, spark: SparkSession, vocabulary: str | None):
        content = read_vocabulary(vocabulary or default_vocabulary())
        self.name = hashlib.sha256(json.dumps(content, sort_keys=True).encode()).hexdigest()
        self.content = spark.sparkContext.broadcast(content)

    def codec(self) -> Codec:
        if self.name not in _codecs:
            _codecs[self.name] = Codec(self.content.value)
        return _codecs[self.name]


def _lists(parts: list[bytes]) -> pa.ListArray:
    lengths = np.fromiter((len(p) // 4 for p in parts), np.int64, len(parts))
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), "<i4")))


def encode_documents(
    docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None
) -> DataFrame:
    """``docs`` with the column ``ids``, the token ids of ``text`` (array of int, empty for null or empty text).

    A column of ``docs`` with the name ``ids`` is replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, vocabulary)
    kept = [c for c in docs.columns if c.lower() != ids.lower()]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            parts = [own.encode_bytes(t or "") for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, _lists(parts)], names=[*kept, ids])

    given = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text}`").alias(free_name(docs, "encoded_text")))
    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema.add(ids, T.ArrayType(T.IntegerType()))
    return given.mapInArrow(encode, schema)


def decode_documents(
    docs: DataFrame, ids: str = "ids", text: str = "decoded", vocabulary: str | None = None
) -> DataFrame:
    """``docs`` with the column ``text``, decoded from ``ids``; null ids give empty text.

    A column of ``docs`` with the name ``text`` is replaced.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, vocabulary)
    kept = [c for c in docs.columns if c.lower() != text.lower()]
    place = kept.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            texts = [own.decode(x or ()) for x in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(len(kept))), pa.array(texts, pa.string())], names=[*kept, text]
            )

    picked = docs.select(*(F.col(f"`{c}`") for c in kept))
    return picked.mapInArrow(decode, T.StructType([*picked.schema.fields, T.StructField(text, T.StringType())]))


def digest_documents(docs: DataFrame, vocabulary: str | None = None, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """Per row: key, number of tokens, SHA-256 of the ids, SHA-256 of the text decoded from them.

    The digests are taken where the ids are made; decoded texts never leave the worker, ids only ``with_ids``.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, vocabulary)
    given = docs.select(F.col(f"`{key}`"), "text")
    schema = given.select(F.col(f"`{key}`")).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            counts, ids_digests, text_digests, every = [], [], [], []
            for text in batch.column(1):
                packed = own.encode_bytes(text.as_py() or "")
                decoded = own.decode(np.frombuffer(packed, "<u4").tolist())
                counts.append(len(packed) // 4)
                if with_ids:
                    every.append(packed)
                ids_digests.append(hashlib.sha256(packed).hexdigest())
                text_digests.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digests, pa.string()), pa.array(text_digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns + [_lists(every)] * with_ids, names=schema.names)

    return given.mapInArrow(digest, schema)
