"""SentencePiece vocabularies of merge type: encode by a score-ordered agenda of adjacent symbol pairs, decode by pieces.

A text becomes one row of characters, with U+2581 for spaces and one before the text. The agenda holds every
adjacent pair whose joined string is a piece; the highest score comes first, the leftmost among equals. Characters left that are no piece become their bytes. The text is
cut beforehand only where no piece of the vocabulary can reach over: between two characters that stand side by side
in no piece. Cutting, counting the distinct stretches and putting their ids together are done on arrays for many texts at
once; only stretches that are new to a worker are merged.

``encode_documents`` adds the ids of every text, ``decode_documents`` the text of every id list, both in map tasks and
without a shuffle. With ``check=True`` each Arrow batch is also encoded and decoded by the sentencepiece library;
the column ``agrees`` says of each row whether ids and decoded text are the same. The library's results are
never returned.

Null text counts as empty and has only the begin and end ids asked for; null ids decode to empty text. Equal rows
give equal results; an empty table gives no rows; columns named like the added ones are replaced. A very long text is a
batch of its own, needs memory in proportion to its length, and its longest uncut stretch n log n steps.
The model is read on the driver and broadcast: it has a fixed size that does not depend on the data.
"""

from __future__ import annotations

import codecs
import hashlib
from array import array
from collections.abc import Iterable, Iterator
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from watchlytics.llm.bpe import _lists
from watchlytics.llm.common import bound_batches, free_name

MARK = "▁"
#: Fixed values of the model file: the merge type, and the kinds of its pieces.
MERGE_TYPE = 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

# Every byte that is no UTF-8 becomes a replacement character of its own.
codecs.register_error("watchlytics-each-byte", lambda e: ("�" * (e.end - e.start), e.end))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


#: Stretches of up to so many symbols are merged side by side, longer ones by a heap each; so are those of a length that has
#: only a few new stretches. Both give the same.
LIST_UP_TO, FEW = 32, 16
NO_JOIN = 1 << 62
#: Slots of the table of neighbouring characters, a power of two, and the factor that spreads the left ones. Pairs that share a slot
#: are only cut less often, which gives the same ids.
SLOTS, SPREAD = 1 << 22, 8209
#: Characters of the texts cut and merged together, or one longer text: a whole batch, as its stretches are counted once.
SLICE = 8_000_000
#: Stretches kept with their ids in one worker, half of them older; only stretches of up to so many characters.
STRETCHES, LONGEST_KEPT = 1_000_000, 48


class Memory(dict):
    """Packed ids of the stretches met of late; long ones are kept for one slice of texts only.

    Full, it becomes the ``older`` half and begins anew; what is met again comes back from there.
    """

    def __init__(self, merged):
        self.merged, self.older, self.long = merged, {}, []

    def meet(self, stretches: list[str]) -> list[bytes]:
        """Packed ids of all these stretches, which are distinct; they are held until ``shrink``."""
        new = []
        for stretch in stretches:
            if stretch not in self:
                found = self.older.get(stretch)
                if found is None:
                    new.append(stretch)
                else:
                    self[stretch] = found
        self.update(zip(new, self.merged(new)))
        self.long = [s for s in new if len(s) > LONGEST_KEPT]
        return list(map(self.__getitem__, stretches))

    def shrink(self) -> None:
        """Forget the long ones met last, and the older half if there are too many."""
        for stretch in self.long:
            del self[stretch]
        if len(self) > STRETCHES // 2:
            self.older = dict(islice(self.items(), STRETCHES // 2))
            self.clear()


class Codec:
    """Encoder and decoder of one model."""

    def __init__(self, content: bytes):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(content)
        rule, trained = model.normalizer_spec, model.trainer_spec
        if trained.model_type != MERGE_TYPE:
            raise ValueError("the vocabulary is not of merge type")
        if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not rule.escape_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("only models that leave their text as it is are supported")
        kinds = [p.type for p in model.pieces]
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.prefix = MARK if rule.add_dummy_prefix else ""
        self.strips = rule.add_dummy_prefix
        self.bos, self.eos = trained.bos_id, trained.eos_id
        self.unknown = kinds.index(UNKNOWN)
        self.by_bytes = trained.byte_fallback
        self.bytes_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        #: Rank of each piece's score, the highest first: two symbols join if their joined string is here.
        order = {v: r for r, v in enumerate(sorted({p.score for p in model.pieces}, reverse=True))}
        self.ranks = {p.piece: order[p.score] for p in model.pieces if p.type == NORMAL}
        # The same for numbers: any two pieces side by side that make a piece, sorted, with its id and rank.
        self.size = len(kinds)
        pairs = []
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                left, right = self.ids.get(piece[:i]), self.ids.get(piece[i:])
                if left is not None and right is not None:
                    pairs.append((left * self.size + right, self.ids[piece], rank))
        pairs = np.array([*sorted(pairs), (NO_JOIN, 0, 0)], np.int64)
        self.pairs, self.makes, self.costs = (np.ascontiguousarray(c) for c in pairs.T)
        single = {ord(p): i for p, i in self.ids.items() if len(p) == 1}
        self.of_character = np.full(max(single, default=0) + 2, -1, np.int64)  # the last stands for all beyond
        self.of_character[list(single)] = list(single.values())
        strings = []
        for p in model.pieces:
            if p.type == BYTE:
                strings.append(bytes([int(p.piece[3:5], 16)]))
            elif p.type in (UNKNOWN, CONTROL):
                strings.append(trained.unk_surface.encode() if p.type == UNKNOWN else b"")
            else:
                strings.append(p.piece.replace(MARK, " ").encode())
        self.surfaces = pa.array(strings, pa.large_binary())
        self.hidden = np.array([k == CONTROL for k in kinds])
        self.marked = np.array([k == NORMAL and p.piece.startswith(MARK) for k, p in zip(kinds, model.pieces)])
        self.reach = self.reaching()
        self.memory = Memory(self.merged)

    def reaching(self) -> np.ndarray:
        """Table of the slots of any two characters that stand side by side in a piece; a space stands for the mark too."""
        pairs = {pair for p in self.ids for pair in zip(p, p[1:])}
        pairs |= {(a.replace(MARK, " "), b) for a, b in pairs}
        pairs |= {(a, b.replace(MARK, " ")) for a, b in pairs}
        table = np.zeros(SLOTS, bool)
        for left, right in pairs:
            table[(ord(left) * SPREAD + ord(right)) % SLOTS] = True
        return table

    def cut(self, texts: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Stretches of the texts that no piece reaches beyond, in order, and how many there are up to the end of each text."""
        prefix = " " if self.prefix else ""
        joined = "".join([prefix + t if t else "" for t in texts])
        points = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        ends = np.fromiter((len(prefix) + len(t) if t else 0 for t in texts), np.int64, len(texts)).cumsum()
        begins = np.ones(len(points) + 1, bool)  # the last stands for the end of all
        begins[1:-1] = ~self.reach[(points[:-1] * np.uint32(SPREAD) + points[1:]) % np.uint32(len(self.reach))]
        begins[ends] = True
        at = np.flatnonzero(begins)
        if joined.isascii() or not len(points):
            offsets = at
        else:
            widths = np.add(points >= 0x80, 1, dtype=np.uint8) + (points >= 0x800) + (points >= 0x10000)
            offsets = np.concatenate([[0], np.add.reduceat(widths, at[:-1], dtype=np.int64).cumsum()])
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(joined.encode())]
        return pa.Array.from_buffers(pa.large_string(), len(at) - 1, buffers), np.searchsorted(at, ends)

    def merged(self, stretches: list[str]) -> list[bytes]:
        """Packed ids of each stretch: always join the pair of the highest score, the leftmost first."""
        stretches = [s.replace(" ", MARK) for s in stretches]
        out: list[bytes | None] = [None] * len(stretches)
        groups: dict[int, list[int]] = {}
        for i, length in enumerate(map(len, stretches)):
            groups.setdefault(length, []).append(i)
        for length, group in groups.items():
            if length > LIST_UP_TO or len(group) < FEW:
                continue
            characters = np.frombuffer("".join([stretches[i] for i in group]).encode("utf-32-le"), "<u4")
            symbols = self.of_character[np.minimum(characters, len(self.of_character) - 1)].reshape(-1, length)
            known = (symbols >= 0).all(axis=1)
            own = [i for i, k in zip(group, known.tolist()) if k]
            for i, found in zip(own, self.side_by_side(np.ascontiguousarray(symbols[known].T))):
                out[i] = found
        return [array("I", self.by_heap(s)).tobytes() if o is None else o for s, o in zip(stretches, out)]

    def joins(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Agenda entries (rank of the score, then place) of the pairs at ``at``, and the pieces they make."""
        wanted = left * self.size + right
        found = np.searchsorted(self.pairs, wanted)
        return np.where(self.pairs[found] == wanted, self.costs[found] * length + at, NO_JOIN), self.makes[found]

    def side_by_side(self, symbols: np.ndarray) -> list[bytes]:
        """Packed ids of stretches of one length, a column of symbols each.

        Every stretch has an agenda of one entry a pair, and the least entry of each is joined in the same step. Symbols are linked by
        ``after`` and ``before``; one joined to its left neighbour becomes -1 and has no entry any more.
        """
        length, n = symbols.shape
        place = np.arange(length)[:, None]
        after, before = np.repeat(place + 1, n, axis=1), np.repeat(place - 1, n, axis=1)
        agenda, makes = np.full((length, n), NO_JOIN), np.zeros((length, n), np.int64)
        agenda[:-1], makes[:-1] = self.joins(symbols[:-1], symbols[1:], place[:-1], length)
        while True:
            best = agenda.min(axis=0)
            column = np.flatnonzero(best < NO_JOIN)
            if not len(column):
                break
            at = best[column] % length
            right = after[at, column]
            beyond = after[right, column]
            symbols[at, column] = made = makes[at, column]
            symbols[right, column] = -1
            agenda[at, column] = agenda[right, column] = NO_JOIN
            after[at, column] = beyond
            for to_right, near in ((True, beyond), (False, before[at, column])):
                has = np.flatnonzero((near >= 0) & (near < length))
                c, here, other = column[has], at[has], near[has]
                if to_right:
                    before[other, c] = here
                    agenda[here, c], makes[here, c] = self.joins(made[has], symbols[other, c], here, length)
                else:
                    agenda[other, c], makes[other, c] = self.joins(symbols[other, c], made[has], other, length)
        left = symbols.T >= 0
        packed = symbols.T[left].astype("<u4").tobytes()
        ends = (4 * left.sum(axis=1).cumsum()).tolist()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]

    def by_heap(self, stretch: str) -> list[int]:
        """Ids of one stretch by a heap over linked symbols; entries whose symbols have changed since are skipped.

        A symbol joined to its left neighbour becomes empty. An entry is rank of the score * n + place of the left symbol.
        """
        find, symbols, n = self.ranks.get, list(stretch), len(stretch)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[int] = []

        def enter(at: int, right: int) -> None:
            if (rank := find(symbols[at] + symbols[right])) is not None:
                heappush(agenda, rank * n + at)

        for at in range(n - 1):
            enter(at, at + 1)
        while agenda:
            rank, at = divmod(heappop(agenda), n)
            right = after[at]
            if right < 0 or not symbols[at] or find(symbols[at] + symbols[right]) != rank:
                continue
            symbols[at], symbols[right] = symbols[at] + symbols[right], ""
            after[at] = beyond = after[right]
            after[right] = -1
            if beyond >= 0:
                before[beyond] = at
                enter(at, beyond)
            if before[at] >= 0:
                enter(before[at], at)
        out: list[int] = []
        for symbol in filter(None, symbols):
            number = self.ids.get(symbol)
            if number is not None:
                out.append(number)
            elif self.by_bytes:
                out.extend(map(self.bytes_ids.__getitem__, symbol.encode()))
            else:
                out.append(self.unknown)
        return out

    def encode_texts(self, texts: list[str], bos: bool = True, eos: bool = True) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        begin, end = (i.to_bytes(4, "little") if wanted else b"" for i, wanted in ((self.bos, bos), (self.eos, eos)))
        out, first = [], 0
        while first < len(texts):
            last, size = first + 1, len(texts[first])
            while last < len(texts) and size + len(texts[last]) <= SLICE:
                size += len(texts[last])
                last += 1
            for packed in self.slice_ids(texts[first:last]):
                if not self.by_bytes:  # the library makes one id of neighbouring unknown characters
                    ids = np.frombuffer(packed, "<u4")
                    again = np.concatenate([[False], (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)])
                    packed = ids[~again[: len(ids)]].tobytes()
                out.append(begin + packed + end)
            first = last
        return out

    def slice_ids(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text; the texts are cut, and the ids of their stretches put together, in one go."""
        stretches, upto = self.cut(texts)
        coded = stretches.dictionary_encode()
        which = coded.indices.to_numpy()
        packed = self.memory.meet(coded.dictionary.to_pylist())
        self.memory.shrink()
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        count = sizes[which]
        ends = np.concatenate([[0], count.cumsum()])
        place = np.repeat((sizes.cumsum() - sizes)[which] - ends[:-1], count) + np.arange(ends[-1])
        ids = np.frombuffer(b"".join(packed), "<u4")[place].tobytes()
        bounds = [0, *(4 * ends[upto]).tolist()]
        return (ids[a:b] for a, b in zip(bounds, bounds[1:]))

    def encode_bytes(self, text: str, bos: bool = True, eos: bool = True) -> bytes:
        return self.encode_texts([text], bos, eos)[0]

    def encode(self, text: str, bos: bool = True, eos: bool = True) -> list[int]:
        return np.frombuffer(self.encode_bytes(text, bos, eos), "<u4").tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """Text of the ids, without the space that encoding puts first."""
        return self.decode_bytes(array("I", ids).tobytes())

    def decode_bytes(self, packed: bytes) -> str:
        """Text of ids given as little-endian unsigned 32-bit integers."""
        return self.decode_texts([packed])[0]

    def decode_texts(self, packed: list[bytes]) -> list[str]:
        """Text of each list of ids given as little-endian unsigned 32-bit integers."""
        ids = np.frombuffer(b"".join(packed), "<u4")
        surfaces = self.surfaces.take(pa.array(ids))
        _, places, data = (b or pa.py_buffer(bytes(8)) for b in surfaces.buffers())
        places = np.frombuffer(places, np.int64)
        hidden = np.flatnonzero(self.hidden[ids]).tolist()
        out, begin, h = [], 0, 0
        for end in np.fromiter((len(p) // 4 for p in packed), np.int64, len(packed)).cumsum().tolist():
            texts = []  # the bytes of a character never stand around a control id
            while begin < end:
                stop = end
                if h < len(hidden) and hidden[h] < end:
                    stop, h = hidden[h], h + 1
                if begin < stop:
                    text = data[places[begin] : places[stop]].to_pybytes().decode("utf-8", "watchlytics-each-byte")
                    texts.append(text[1:] if self.strips and not texts and self.marked[ids[begin]] else text)
                begin = stop + 1
            out.append("".join(texts))
            begin = end
        return out


_codecs: dict[str, tuple] = {}


class Shared:
    """A model broadcast to the workers; each worker builds its codec, and the library's if asked for, once."""

    def __init__(self, spark: SparkSession, model: str | None):
        content = read_model(model or default_model())
        Codec(content)  # refuses what it does not support before any task runs
        self.name = hashlib.sha256(content).hexdigest()
        self.content = spark.sparkContext.broadcast(content)

    def codec(self) -> Codec:
        if self.name not in _codecs:
            _codecs[self.name] = Codec(self.content.value)
        return _codecs[self.name]

    def library(self):
        key = self.name + " library"
        if key not in _codecs:
            import sentencepiece

            _codecs[key] = sentencepiece.SentencePieceProcessor(model_proto=self.content.value)
        return _codecs[key]


def agreeing(library, texts: list[str], packed: list[bytes], decoded: list[str], bos: bool, eos: bool) -> list[bool]:
    """Whether the library has the same ids, and the same text for them, of each text of a batch."""
    want = library.encode(texts, add_bos=bos, add_eos=eos, num_threads=1)
    back = library.decode(want, num_threads=1) if want else []
    return [array("I", w).tobytes() == p and t == d for w, p, t, d in zip(want, packed, back, decoded)]


def encode_documents(
    docs: DataFrame, text: str = "text", ids: str = "ids", model: str | None = None, bos: bool = True, eos: bool = True, check: bool = False
) -> DataFrame:
    """``docs`` with the column ``ids`` (array of int) of ``text``; with ``check`` also ``agrees``."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, model)
    added = [ids, *(["agrees"] if check else [])]
    kept = [c for c in docs.columns if c.lower() not in {a.lower() for a in added}]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            packed = own.encode_texts(texts, bos, eos)
            columns = [*(batch.column(i) for i in range(len(kept))), _lists(packed)]
            if check:
                decoded = own.decode_texts(packed)
                columns.append(pa.array(agreeing(shared.library(), texts, packed, decoded, bos, eos), pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    picked = [F.col(f"`{c}`") for c in kept]
    given = docs.select(*picked, F.col(f"`{text}`").alias(free_name(docs, "encoded_text")))
    schema = T.StructType([*docs.select(*picked).schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])
    return given.mapInArrow(encode, schema.add("agrees", "boolean") if check else schema)


def decode_documents(docs: DataFrame, ids: str = "ids", text: str = "decoded", model: str | None = None) -> DataFrame:
    """``docs`` with the column ``text``, decoded from ``ids``."""
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, model)
    kept = [c for c in docs.columns if c.lower() != text.lower()]
    place = kept.index(ids)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            texts = pa.array(own.decode_texts([array("I", x or ()).tobytes() for x in batch.column(place).to_pylist()]), pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), texts], names=[*kept, text])

    picked = docs.select(*(F.col(f"`{c}`") for c in kept))
    return picked.mapInArrow(decode, T.StructType([*picked.schema.fields, T.StructField(text, T.StringType())]))


def digest_documents(docs: DataFrame, model: str | None = None, key: str = "doc_id", check: bool = True) -> DataFrame:
    """Per row: key, number of ids, SHA-256 of the ids, SHA-256 of the text decoded from them, agrees (null without ``check``).

    The digests are taken where the ids are made; ids and decoded texts never leave the worker.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    shared = Shared(spark, model)
    given = docs.select(F.col(f"`{key}`"), "text")
    schema = given.select(F.col(f"`{key}`")).schema
    schema = schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string").add("agrees", "boolean")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.codec()
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            packed = own.encode_texts(texts)
            decoded = own.decode_texts(packed)
            agrees = agreeing(shared.library(), texts, packed, decoded, True, True) if check else [None] * len(texts)
            columns = [
                batch.column(0),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                pa.array(agrees, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(digest, schema)
