"""Benchmark decontamination: an FM-index per shard of training text, searched for all test phrases.

A test phrase (window) is 13 consecutive words of a benchmark item, or the whole item if it is
shorter. Each map task cuts its documents into words, appends their word numbers to a shard and, when the
shard is full, builds its FM-index: suffix array, BWT, wavelet matrix, sampled suffix positions. All
phrases are searched backward at once; occurrences are located by walking back to a sampled position, and
the covered word spans of a document are merged. Documents are never shuffled, and a hot source or
a very long document only fills more shards.

Words that no phrase uses cannot be part of an occurrence; they end a run of words. Runs shorter than
the shortest phrase hold no occurrence and stay out of the index. A long run is indexed in blocks that
overlap by the longest phrase less one word, so every occurrence lies within a block.

Spark cuts the items into words and deals them to blocks of some ``PHRASES_AT_ONCE`` phrases, long items in overlapping parts.
The driver fetches and broadcasts block after block, so it holds one at a time; a task cuts its texts once and searches them for
the phrases of one block after the other. Very long texts fill several shards. Null text
has no words. An item without words has no window. Repeated documents each get their own row; repeated
items each count. An empty benchmark leaves every document clean, empty documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from watchlytics.functions.ordering import range_buckets, rank_and_running_total
from watchlytics.llm.common import bound_batches, discard, stored

WINDOW = 13
#: A document is contaminated from one hit word in so many words on.
SHARE = 20
#: UTF-8 bytes of words: digits, letters in lower case, everything beyond ASCII; the rest separates words.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()
#: Words of one shard, 2 ** SHARD_BITS at most: three such numbers fit 64 bits.
SHARD_BITS = 20
#: Words a block of the index begins anew after, without the overlap.
BLOCK = 96
#: Every so many words of a block the suffix position is stored.
SAMPLE = 8
#: Phrases of a broadcast block of benchmark items (fewer than twice as many; some 7 bytes each, a word).
PHRASES_AT_ONCE = 500_000
#: Bytes of texts that are searched for one block after the other, where there are several.
TEXTS_AT_ONCE = 16 << 20


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split() if text else []


class Phrases:
    """Windows of benchmark items as rows of word numbers (from 1 on), ordered by length."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[int]] = {}
        self.names = [name for name, _ in items]
        for number, (_, item) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item]
            for at in range(max(1, len(ids) - window + 1)) if ids else ():
                found.setdefault(tuple(ids[at : at + window]), set()).add(number)
        self.longest = max(map(len, found), default=0)
        self.shortest = min(map(len, found), default=0)
        self.groups = []  # (phrase numbers, words of these phrases) per length
        self.owners = [sorted(found[p]) for p in found]
        lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.lengths = lengths
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            every = list(found)
            self.groups.append((at, np.array([every[i] for i in at], dtype=np.int64)))


class WaveletMatrix:
    """Rank of a symbol in a prefix, by one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.size = bits, len(symbols)
        self.levels, self.zeros = [], []
        for level in range(bits - 1, -1, -1):
            bit = ((symbols >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(8 + -len(packed) % 8, np.uint8)]).view("<u8")
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)[:-1]])
            self.levels.append((packed, counts))
            zeros = self.size - int(np.count_nonzero(bit))
            self.zeros.append(zeros)
            symbols = np.concatenate([symbols[~bit], symbols[bit]])

    @staticmethod
    def _ones(level, at: np.ndarray) -> np.ndarray:
        packed, counts = level
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return counts[word] + np.bitwise_count(packed[word] & mask)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``symbol`` occurs before position ``at``."""
        start = np.zeros_like(at)
        for number, level in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - number)) & 1).astype(bool)
            ones_start, ones_at = self._ones(level, start), self._ones(level, at)
            zeros = self.zeros[number]
            start = np.where(one, zeros + ones_start, start - ones_start)
            at = np.where(one, zeros + ones_at, at - ones_at)
        return at - start

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at the positions, and their rank there."""
        symbol, start = np.zeros_like(at), np.zeros_like(at)
        for number, level in enumerate(self.levels):
            packed, _ = level
            one = (packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            ones_start, ones_at = self._ones(level, start), self._ones(level, at)
            zeros = self.zeros[number]
            start = np.where(one, zeros + ones_start, start - ones_start)
            at = np.where(one, zeros + ones_at, at - ones_at)
            symbol = (symbol << 1) | one
        return symbol, at - start


def suffix_array(symbols: np.ndarray, longest: int) -> np.ndarray:
    """Order of all suffixes, each read up to its terminator (symbol 0); equal ones by position.

    Prefix doubling; ``longest`` is the length of the longest block with its terminator.
    One 64-bit number holds two ranks and the position, so that plain sorting does.
    """
    n = len(symbols)
    bits = max(1, int(n).bit_length())
    if 3 * bits > 64:
        raise ValueError("a shard has more words than 64-bit keys can order")
    place = np.arange(n, dtype=np.uint64)
    low = np.uint64((1 << bits) - 1)
    # Terminators rank by position, so no comparison goes beyond one.
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + np.count_nonzero(ends)).astype(np.int64)
    _, rank = np.unique(rank, return_inverse=True)
    rank = rank.astype(np.uint64)
    step = 1
    while True:
        following = np.zeros(n, np.uint64)
        following[: n - step] = rank[step:]
        key = (rank << np.uint64(2 * bits)) | (following << np.uint64(bits)) | place
        key.sort()
        order = (key & low).astype(np.int64)
        head = key >> np.uint64(bits)
        new = np.empty(n, np.uint64)
        new[order] = np.concatenate([[0], np.cumsum(head[1:] != head[:-1])]).astype(np.uint64)
        rank = new
        step *= 2
        if step >= longest or int(rank.max()) == n - 1:
            return order


class FmIndex:
    """Index of a shard: symbols 1 and up are words, 0 ends each block."""

    def __init__(self, symbols: np.ndarray, longest: int, sample: int = SAMPLE):
        n = len(symbols)
        order = suffix_array(symbols, longest)
        bwt = symbols[order - 1]
        bits = max(1, int(symbols.max()).bit_length())
        self.matrix = WaveletMatrix(bwt, bits)
        counts = np.bincount(symbols, minlength=(1 << bits) + 1)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        starts = np.concatenate([[True], symbols[:-1] == 0])
        sampled = starts | (np.arange(n) % sample == 0)
        at = sampled[order]
        self.sampled = np.packbits(at, bitorder="little")
        self.sampled_before = np.concatenate([[0], np.cumsum(at)])
        self.positions = order[at]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search: phrases (rows) that occur, with the range of their suffixes."""
        alive = np.arange(len(phrases))
        low = self.first[phrases[:, -1]]
        high = self.first[phrases[:, -1] + 1]
        for column in range(phrases.shape[1] - 2, -1, -1):
            some = low < high
            alive, low, high = alive[some], low[some], high[some]
            if not len(alive):
                break
            symbol = phrases[alive, column]
            low = self.first[symbol] + self.matrix.rank(symbol, low)
            high = self.first[symbol] + self.matrix.rank(symbol, high)
        some = low < high
        return alive[some], low[some], high[some]

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix-array rows: step back to a sampled one and count the steps."""
        found = np.empty(len(rows), np.int64)
        steps = np.zeros(len(rows), np.int64)
        open_, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(open_):
            hit = (self.sampled[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            done = open_[hit]
            found[done] = self.positions[self.sampled_before[at[hit]]] + steps[done]
            open_, at = open_[~hit], at[~hit]
            if len(open_):
                symbol, rank = self.matrix.access(at)
                at = self.first[symbol] + rank
                steps[open_] += 1
        return found


class Shard:
    """Runs of known words of several documents, to be indexed together."""

    def __init__(self, phrases: Phrases, capacity: int):
        self.phrases, self.capacity = phrases, capacity
        self.parts: list[np.ndarray] = []
        self.documents: list[np.ndarray] = []
        self.places: list[np.ndarray] = []
        self.size = 0

    def blocks(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Start and end of the blocks that hold all places a phrase can occur at."""
        phrases = self.phrases
        known = np.concatenate([[False], ids > 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start < phrases.shortest:
                continue
            overlap = phrases.longest - 1
            for at in range(start, max(start + 1, end - overlap), BLOCK):
                yield at, min(end, at + BLOCK + overlap)

    def add(self, document: int, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for start, end in self.blocks(ids):
            if self.size + end - start + 1 > self.capacity:
                yield self.hits()
            self.parts += [ids[start:end], np.zeros(1, np.int64)]
            self.documents.append(np.full(end - start + 1, document, np.int64))
            self.places.append(np.arange(start, end + 1))
            self.size += end - start + 1

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Documents, first words and phrases of all occurrences; empties the shard."""
        none = np.empty(0, np.int64)
        if not self.size:
            return none, none, none
        symbols, phrases = np.concatenate(self.parts), self.phrases
        documents, places = np.concatenate(self.documents), np.concatenate(self.places)
        self.parts, self.documents, self.places, self.size = [], [], [], 0
        index = FmIndex(symbols, BLOCK + phrases.longest)
        out = []
        for numbers, rows in phrases.groups:
            present = np.flatnonzero((rows < 1 << index.matrix.bits).all(axis=1))
            which, low, high = index.search(rows[present])
            if len(which):
                repeats = high - low
                begin = np.repeat(low - np.concatenate([[0], np.cumsum(repeats)[:-1]]), repeats)
                at = index.locate(begin + np.arange(int(repeats.sum())))
                out.append((documents[at], places[at], np.repeat(numbers[present[which]], repeats)))
        if not out:
            return none, none, none
        return tuple(np.concatenate(x) for x in zip(*out))


def spans_of(first: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
    """Merged half-open word spans of occurrences."""
    order = np.argsort(first, kind="stable")
    merged: list[list[int]] = []
    for start, end in zip(first[order].tolist(), (first + lengths)[order].tolist()):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return merged


def search_documents(texts: list[str | None], phrases: Phrases, capacity: int) -> list[tuple]:
    """Number of words, merged spans and item numbers of each text."""
    return search_words([words(t) for t in texts], phrases, capacity)


def search_words(texts: list[list[bytes]], phrases: Phrases, capacity: int) -> list[tuple]:
    """The same for texts that are cut into words already."""
    shard, counts, found = Shard(phrases, capacity), [], []
    number = phrases.vocabulary.get
    for document, own in enumerate(texts):
        counts.append(len(own))
        if phrases.shortest and len(own) >= phrases.shortest:
            ids = np.fromiter(map(number, own, repeat(0)), np.int64, len(own))
            found += shard.add(document, ids)
    found.append(shard.hits())
    documents, places, which = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(documents, kind="stable")
    documents, places, which = documents[order], places[order], which[order]
    cuts = np.searchsorted(documents, np.arange(len(texts) + 1))
    out = []
    for document, n in enumerate(counts):
        a, b = cuts[document], cuts[document + 1]
        if a == b:
            out.append((n, [], []))
            continue
        items = sorted({i for w in np.unique(which[a:b]).tolist() for i in phrases.owners[w]})
        out.append((n, spans_of(places[a:b], phrases.lengths[which[a:b]]), items))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))


def benchmark_blocks(benchmark: DataFrame, window: int, most: int) -> DataFrame:
    """The items in blocks of about ``most`` phrases, stored: ``block``, ``item`` and ``words``, joined by spaces.

    Items are cut into words, and long ones into parts that overlap by a window less one word, by map tasks; the parts
    are dealt to blocks by a running sum of their phrases. A block has fewer than twice ``most``.
    """
    bound_batches(benchmark.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = words(text)
                for part, at in enumerate(range(0, max(1, len(own) - window + 1), most) if own else ()):
                    piece = own[at : at + most + window - 1]
                    rows.append((name or "", part, b" ".join(piece), max(1, len(piece) - window + 1)))
            columns = zip(*rows) if rows else [()] * 4
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["item", "part", "words", "phrases"])

    given = benchmark.select(F.col("item_id").cast("string").alias("item"), "text")
    parts = given.mapInArrow(cut, "item string, part int, words binary, phrases long")
    order = [F.col("item"), F.col("part"), F.xxhash64("words")]
    summed = rank_and_running_total(range_buckets(parts, order), order, "phrases", running="so_far")
    block = F.floor((F.col("so_far") - F.col("phrases")) / most).cast("int")
    return stored(summed.select(block.alias("block"), "item", "words"), "benchmark-blocks")


def find_benchmark_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    phrases_at_once: int = PHRASES_AT_ONCE,
    shard_bits: int = SHARD_BITS,
) -> DataFrame:
    """``docs`` with n_words, spans (merged hit word spans) and items (item ids with occurrences, sorted).

    The result has the columns of ``docs`` except those of these three names. An array of a
    document's items may repeat an id that several items share only once.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    capacity = (1 << shard_bits) - 1
    added = ("n_words", "spans", "items")
    kept = [c for c in docs.columns if c.lower() not in added]
    given = docs.select(*(F.col(f"`{c}`") for c in kept))
    text = kept.index("text")
    blocks = benchmark_blocks(benchmark, window, phrases_at_once)
    number = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    # The driver holds one block at a time, and hands it on; empty blocks lie within parts of the block before.
    contents = []
    for k in range(number):
        rows = [(r.item, bytes(r.words)) for r in blocks.where(F.col("block") == k).select("item", "words").toLocalIterator()]
        if rows or not k:
            contents.append(spark.sparkContext.broadcast(rows))
    discard(spark, blocks)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only: list[Phrases] = []

        def phrases_of(content) -> Phrases:
            if only:
                return only[0]
            phrases = Phrases([(name, joined.split(b" ")) for name, joined in content.value], window)
            if len(contents) == 1:
                only.append(phrases)
            return phrases

        for group in grouped(batches, 0 if len(contents) == 1 else TEXTS_AT_ONCE):
            texts = [words(t) for batch in group for t in batch.column(text).to_pylist()]
            spans: list[list[list[int]]] = [[] for _ in texts]
            items: list[set[str]] = [set() for _ in texts]
            for content in contents:
                phrases = phrases_of(content)
                for at, (_, found, which) in enumerate(search_words(texts, phrases, capacity)):
                    spans[at] = merge_spans(spans[at] + found) if spans[at] and found else spans[at] or found
                    items[at].update(phrases.names[i] for i in which)
            first = 0
            for batch in group:
                part = slice(first, first := first + batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i) for i in range(len(kept))),
                        pa.array([len(t) for t in texts[part]], pa.int64()),
                        pa.array([[{"first": a, "end": b} for a, b in s] for s in spans[part]], pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))),
                        pa.array([sorted(i) for i in items[part]], pa.list_(pa.string())),
                    ],
                    names=[*kept, *added],
                )

    schema = T.StructType([*given.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    return given.mapInArrow(find, schema)


def grouped(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about ``most`` bytes."""
    group: list[pa.RecordBatch] = []
    for batch in batches:
        group.append(batch)
        if sum(b.nbytes for b in group) >= most:
            yield group
            group = []
    if group:
        yield group


def merge_spans(spans: list[list[int]]) -> list[list[int]]:
    first = np.array([a for a, _ in spans], np.int64)
    return spans_of(first, np.array([b for _, b in spans], np.int64) - first)


def judged(found: DataFrame, share: int = SHARE) -> DataFrame:
    """``found`` with n_hit (words in spans) and contaminated (one word in ``share`` or more is hit)."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["first"])
    found = found.withColumn("n_hit", n_hit)
    return found.withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))


def digest_items(ids: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
