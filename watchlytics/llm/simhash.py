"""SimHash near-duplicates by a Gray-order hierarchical index.

1. ``fingerprints``: 64 bits per text, from the XXH64 values of its word shingles.
2. Equal fingerprints are one node. Differences of at most ``BITS`` bits leave at least two of ``BLOCKS`` bit blocks
   equal, so each node is dealt out once per pair of blocks, keyed by their bits: all links meet in some bucket.
3. A task sorts the fingerprints of each of its buckets by Gray rank and builds a tree over them: an upper node
   keeps the bits its members share (mask and value). Pairs of nodes are compared from the roots down: differing
   shared bits add up to a lower bound that prunes both groups at once, and when even the bits that are
   not shared cannot exceed the limit, the groups are linked whole.
4. Only a spanning forest of each bucket leaves the task; the components of all forests are the answer.

Buckets above ``CHUNK`` rows are cut into as many chunks as it takes and every pair of chunks is a bucket of its own, so
what a task holds at a time is bounded and no link is lost; a bucket that large is sent once per chunk. A very long text is
hashed in parts, its words are in memory once. Columns named like the added ones are replaced. Text of null counts as empty; texts without words have fingerprint
zero and link like any other. Repeated rows share a fingerprint. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from watchlytics.llm.common import bound_batches, discard, placed, stored
from watchlytics.llm.components import components

SHINGLE = 4
SEED = 42
#: Fingerprints that differ in so many bits or fewer are linked.
BITS = 4
#: Widths of the bit blocks, from the highest bits down; BITS differences leave two of them equal.
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Rows of a chunk, on average. A task holds two at a time, whatever the size of their bucket.
CHUNK = 32_768
#: Children of an index node.
FAN = 8
#: Rows indexed together and node pairs compared together in a task.
SEGMENT = 500_000
PAIRS = 200_000


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is 1 if more than half of the shingles' hashes have it."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)]).tolist()
    n = len(words) - shingle + 1
    counts = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 16):
        high = min(n, low + (1 << 16))
        hashes = [digest(joined[a : b - 1], SEED) for a, b in zip(starts[low:high], starts[low + shingle : high + shingle])]
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of its text as a signed 64-bit integer; a column ``name`` is replaced."""
    bound_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != name.lower()]
    text = kept.index("text")
    given = docs.select(*(F.col(f"`{c}`") for c in kept))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(text)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found.view(np.int64))], names=[*kept, name])

    return given.mapInArrow(make, T.StructType([*given.schema.fields, T.StructField(name, T.LongType())]))


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of a code in the Gray sequence: neighbours there differ in one bit."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Forest:
    """Disjoint sets of row numbers, united many pairs at a time."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.parent[a], self.parent[b]
            apart = a != b
            a, b = a[apart], b[apart]
            if not len(a):
                return
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.parent[self.parent]
                if np.array_equal(up, self.parent):
                    break
                self.parent = up


class GrayTree:
    """Levels of nodes over codes sorted by (group, Gray rank); no node spans two groups."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        n = len(codes)
        every = np.uint64(0xFFFFFFFFFFFFFFFF)
        # per level: shared value, shared mask, first row, first child and end of children, group
        self.levels = [(codes, np.full(n, every), np.arange(n), None, None, groups)]
        while True:
            value, mask, row, _, _, group = self.levels[-1]
            first_of_group = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            if len(first_of_group) == len(group):
                break
            sizes = np.diff(np.append(first_of_group, len(group)))
            within = np.arange(len(group)) - np.repeat(first_of_group, sizes)
            start = np.flatnonzero(within % FAN == 0)
            every_one = np.bitwise_and.reduceat(value, start)
            any_one = np.bitwise_or.reduceat(value, start)
            shared = np.bitwise_and.reduceat(mask, start) & ~(every_one ^ any_one)
            self.levels.append((every_one & shared, shared, row[start], start, np.append(start[1:], len(group)), group[start]))


def linked_forest(codes: np.ndarray, groups: np.ndarray, sides: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (pairs of codes) among codes of the same group that differ in ``limit`` bits or fewer.

    ``sides`` 0 rows are compared with each other; in a group with rows of sides 1 and 2, these are
    compared across.
    """
    order = np.lexsort((gray_rank(codes), sides, groups))
    codes, groups, sides = codes[order], groups[order], sides[order]
    edge = np.concatenate([[True], (groups[1:] != groups[:-1]) | (sides[1:] != sides[:-1])])
    part = np.cumsum(edge) - 1
    tree, forest = GrayTree(codes, part), Forest(len(codes))
    top = len(tree.levels) - 1
    head = np.flatnonzero(edge)
    part_group, part_side = groups[head], sides[head]
    own = np.flatnonzero(part_side == 0)
    across = np.flatnonzero((part_side[:-1] == 1) & (part_side[1:] == 2) & (part_group[:-1] == part_group[1:]))
    # Neighbours in Gray order often are links; what is linked early need not be compared later.
    side_by_side = np.flatnonzero(~edge[1:] & (np.bitwise_count(codes[1:] ^ codes[:-1]) <= limit) & (sides[1:] == 0))
    forest.unite(side_by_side, side_by_side + 1)
    todo = [(top, np.concatenate([own, across]), np.concatenate([own, across + 1]))]
    while todo:
        level, a, b = todo.pop()
        if len(a) > PAIRS:
            todo += [(level, a[i : i + PAIRS], b[i : i + PAIRS]) for i in range(0, len(a), PAIRS)]
            continue
        value, mask, row, start, end, _ = tree.levels[level]
        both = mask[a] & mask[b]
        least = np.bitwise_count((value[a] ^ value[b]) & both)
        near = least <= limit
        if level == 0:
            near &= a != b
            forest.unite(row[a[near]], row[b[near]])
            continue
        a, b, least, both = a[near], b[near], least[near], both[near]
        whole = least + np.bitwise_count(~both) <= limit
        if whole.any():
            # Any two members are near: one node's members all meet the other's first row.
            last = np.append(row[1:], len(codes)) if level else None
            for x, y in ((a[whole], b[whole]), (b[whole], a[whole])):
                size = last[x] - row[x]
                members = np.repeat(row[x] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
                forest.unite(members, np.repeat(row[y], size))
            a, b = a[~whole], b[~whole]
        # Two groups that are one set already can add nothing.
        low = np.minimum.reduceat(forest.parent, row)
        one = low == np.maximum.reduceat(forest.parent, row)
        open_ = ~(one[a] & one[b] & (low[a] == low[b]))
        a, b = a[open_], b[open_]
        left, right = end[a] - start[a], end[b] - start[b]
        count = left * right
        pair = np.repeat(np.arange(len(a)), count)
        place = np.arange(int(count.sum())) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count) if len(a) else np.empty(0, np.int64)
        x = start[a][pair] + place // right[pair]
        y = start[b][pair] + place % right[pair]
        wanted = (a[pair] != b[pair]) | (x <= y)
        if wanted.any():
            todo.append((level - 1, x[wanted], y[wanted]))
    joined = np.flatnonzero(forest.parent != np.arange(len(codes)))
    return codes[joined], codes[forest.parent[joined]]


def _block_keys(fp: Column) -> Column:
    """Keys of all pairs of blocks: number of the pair and the bits of its two blocks."""
    parts, shift = [], 64
    for width in BLOCKS:
        shift -= width
        parts.append((F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long")), width))
    keys = []
    for number, ((a, _), (b, width)) in enumerate(combinations(parts, 2)):
        bits = F.shiftleft(a, width).bitwiseOR(b)
        keys.append(F.shiftleft(F.lit(number).cast("long"), 24).bitwiseOR(bits))
    return F.array(*keys)


def dealt_out(nodes: DataFrame, chunk: int) -> DataFrame:
    """Rows of all pairs of chunks: fp, bucket, pair, and the side a row is on (0: both chunks are the same)."""
    dealt = nodes.select("fp", F.explode(_block_keys(F.col("fp"))).alias("bucket"))
    sizes = dealt.groupBy("bucket").count().where(F.col("count") > chunk)
    sizes = stored(sizes.select("bucket", F.ceil(F.col("count") / chunk).alias("chunks")), "buckets")
    dealt = dealt.join(sizes, "bucket", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1).cast("long")))
    own = F.pmod(F.xxhash64("fp", "bucket"), F.col("chunks"))
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    return dealt.select(
        "fp",
        "bucket",
        (F.least("own", "other") * F.col("chunks") + F.greatest("own", "other")).alias("pair"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).cast("byte").alias("side"),
    )


def near_links(nodes: DataFrame, limit: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` whose components are those of all links of ``limit`` bits or fewer."""
    if limit > len(BLOCKS) - 2:
        raise ValueError("the blocks leave no two equal at so many differing bits")
    dealt = dealt_out(nodes, chunk).repartition("bucket", "pair").sortWithinPartitions("bucket", "pair")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            fp, bucket, pair, side = rows
            fresh = np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])])
            group = np.cumsum(fresh) - 1
            some = np.bincount(group)[group] > 1
            u, v = linked_forest(fp[some].view(np.uint64), group[some], side[some], limit) if some.any() else (fp[:0], fp[:0])
            found = np.unique(np.stack([u.view(np.int64), v.view(np.int64)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            size += batch.num_rows
            if size < SEGMENT:
                continue
            rows = tuple(np.concatenate(x) for x in zip(*held))
            same = (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield links(tuple(x[:cut] for x in rows))
            held, size = [tuple(x[cut:] for x in rows)], len(rows[0]) - cut
        if size:
            yield links(tuple(np.concatenate(x) for x in zip(*held)))

    return dealt.mapInArrow(search, "u long, v long").distinct()


def near_duplicates(fps: DataFrame, key: str, limit: int = BITS, chunk: int = CHUNK) -> DataFrame:
    """``fps`` (columns ``key`` and ``fp``) with ``component``: the smallest key reachable over links.

    Keys are compared as Spark orders them; null keys have a component but do not name one, unless
    nothing else is in it.
    """
    nodes = stored(fps.groupBy("fp").agg(F.min(key).alias("least")), "fingerprints")
    found = components(near_links(nodes, limit, chunk)).select(F.col("node").alias("fp"), "root")
    found = stored(nodes.join(found, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "roots")
    # Written, so that the join shuffles both sides and a large component can be split.
    least = stored(found.groupBy("root").agg(F.min("least").alias("component")), "components")
    return fps.join(found.join(least, "root").select("fp", "component"), "fp")


def near_unique(docs: DataFrame, limit: int = BITS) -> DataFrame:
    """One row of ``docs`` per component: the smallest doc_id, null ids last, then the first of equal ids."""
    rows = placed(docs)
    key = F.struct(F.col("document.doc_id").isNull().alias("nameless"), F.col("document.doc_id"), "file", "place")
    fps = stored(fingerprints(rows.select(key.alias("key"), "document.text")).select("key", "fp"), "simhash")
    found = near_duplicates(fps, "key", limit)
    drop = stored(found.where("key != component").select("key.file", "key.place"), "near-dropped")
    discard(docs.sparkSession, fps)
    return rows.join(drop, ["file", "place"], "left_anti").select("document.*")
