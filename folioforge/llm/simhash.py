"""SimHash near-duplicate removal with BK-trees.

1. A 128-bit SimHash of each document's distinct words, made in one pass.
2. Equal signatures are one node, whatever the number of copies.
3. The codes are put into shards by the value of each of their eight 16-bit
   blocks (of fewer bits where codes are few).  A shard of more than ``LEAF`` codes
   is a BK-tree, whose children are keyed by the integer Hamming distance to their
   parent.
4. The codes of a shard ask, together, the shards whose block value is within one
   bit of their own, in five of the blocks also those at two bits.  In a tree they
   follow only edges within the radius; shards without one, and parts of trees of
   no more than ``LEAF`` codes, are compared as arrays, as at a radius of 20 in 128
   bits a tree of so few rules out next to nothing.
5. The pairs found are united; the least document of each group stays.

Step 4 finds every pair within the radius of 20: either some block has one
difference at most, or all eight have two or more, and then no more than four have
more than two, so one of any five has exactly two.

The trees are broadcast while their counted size is within ``broadcast_bytes``.
Beyond that (they grow with the corpus), shards and the codes that ask them meet
in a shuffle, with the same result: two codes within two bits in a block agree on
one of its three parts (on one of two bytes, where one bit is asked for), so each
code is sent to 21 places.  A place that would hold more than ``HELD`` codes is
made of chunks that meet two by two, so no task grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textscan
from .common import BROADCAST_BYTES, attach, batched, components, forest, free_names, row_key, written

RADIUS = 20
BLOCKS = 8
#: What a code takes in a broadcast forest, in all its trees.
NODE_BYTES = 390
#: Codes that come together in a task, about, at most.
HELD = 2_000_000
#: Codes in a shard, about, at least.
FEW = 16
#: Codes of a shard or of a part of a tree that are compared all at once.
LEAF = 4096
_ONE = np.array([0] + [1 << i for i in range(16)], np.uint16)
_TWO = np.array([1 << i | 1 << j for i in range(16) for j in range(i)], np.uint16)


def _twos(radius: int) -> int:
    """The number of blocks that are also asked at two bits."""
    if not 0 <= radius <= 23:
        raise ValueError("the radius is 23 at most")
    return max(0, radius - 15)


def _masks(block: int, radius: int) -> np.ndarray:
    """The differences in a block at which shards are asked."""
    return np.r_[_ONE, _TWO] if block < _twos(radius) else _ONE


def _parts(block: int, radius: int) -> list[int]:
    """Parts of a block, of which one is the same wherever the mask is one."""
    return [0x001F, 0x03E0, 0xFC00] if block < _twos(radius) else [0x00FF, 0xFF00]


def signatures(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n, 2) uint64 SimHash codes and the number of distinct words.

    Each distinct word votes once on each of 128 bits; a bit is set when more
    than half of the words set it.  Without a word the code is 0.
    """
    codes, counts = np.zeros((len(texts), 2), np.uint64), np.zeros(len(texts), np.int64)
    for at, part in textscan.slices(texts):
        row, h = textscan.distinct(*textscan.words(part)[:2])
        n = np.bincount(row, minlength=len(part))
        counts[at : at + len(part)] = n
        if not len(row):
            continue
        # segments of at most 255 words of one document: their votes fit a byte
        place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        seg = np.flatnonzero(place % 255 == 0)
        votes = np.zeros((len(part), 128), np.int64)
        step = 1 << 15
        for s in range(0, len(seg), step // 64):
            lo, hi = seg[s], seg[s + step // 64] if s + step // 64 < len(seg) else len(row)
            pair = np.stack([h[lo:hi], textscan.mix(h[lo:hi], 7)], 1)
            lanes = np.unpackbits(pair.view(np.uint8).reshape(-1, 16), axis=1).view(np.uint64)
            at_seg = seg[s : s + step // 64]
            sums = np.add.reduceat(lanes, at_seg - lo, axis=0).view(np.uint8)
            own = row[at_seg]
            new = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            votes[own[new]] += np.add.reduceat(sums, new, axis=0, dtype=np.int64)
        codes[at : at + len(part)] = np.packbits(votes * 2 > n[:, None], axis=1).view(np.uint64)
    return codes, counts


class BKForest:
    """One BK-tree for each number in ``tree``, in flat arrays.

    ``kids`` of a node are a run of the node order; a node's ``edge`` is its
    distance to its parent.  A node is followed by all below it, ``size`` codes in
    all with its own.  All trees of a level are built together.
    """

    def __init__(self, codes: np.ndarray, tree: np.ndarray):
        """``tree`` gives each code's tree, a small number; codes may be in many
        trees."""
        order = np.argsort(tree, kind="stable")
        codes, tree, n = codes[order], tree[order], len(order)
        self.keys, roots = np.unique(tree, return_index=True)
        edge, parent = np.zeros(n, np.uint8), np.full(n, -1, np.int64)
        at = np.repeat(roots, np.diff(np.r_[roots, n]))  # where each code has come to
        todo, levels = np.setdiff1d(np.arange(n), roots, assume_unique=True), []
        while len(todo):
            d = hamming(codes[todo], codes[at[todo]])
            # the first to come by an edge becomes the child, the rest go below it
            key = at[todo] * 256 + d
            _, first, which = np.unique(key, return_index=True, return_inverse=True)
            child = todo[first]  # by parent and edge
            parent[child], edge[child] = at[child], d[first]
            at[todo] = child[which]
            levels.append(child)
            todo = todo[np.setdiff1d(np.arange(len(todo)), first, assume_unique=True)]
        size = np.ones(n, np.int64)
        for child in reversed(levels):
            np.add.at(size, parent[child], size[child])
        place = np.zeros(n, np.int64)
        place[roots] = np.cumsum(size[roots]) - size[roots]
        for child in levels:
            before = np.cumsum(size[child]) - size[child]
            first = np.flatnonzero(np.r_[True, np.diff(parent[child]) != 0])
            place[child] = place[parent[child]] + 1 + before - np.repeat(before[first], np.diff(np.r_[first, len(child)]))
        new = np.argsort(place)
        self.codes, self.source, self.edge, self.size = codes[new], order[new], edge[new], size[new]
        self.roots = place[roots]
        parent = np.where(parent[new] >= 0, place[parent[new]], -1)
        has = np.flatnonzero(parent >= 0)
        self.kids = has[np.lexsort((self.edge[has], parent[has]))]
        self.begin = np.searchsorted(parent[self.kids], np.arange(n + 1))

    def search(self, query: np.ndarray, tree: np.ndarray, radius: int, leaf: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row, source code) pairs within the radius; row i searches the tree
        ``tree[i]`` for the code ``query[i]``.  The queries of a tree go down
        together, and only by edges within the radius; of ``leaf`` codes or fewer
        all are compared at once."""
        key, row = np.unique(tree, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        stack = [(np.flatnonzero(row == i), self.roots[at[i]]) for i in range(len(key)) if len(self.keys) and self.keys[at[i]] == key[i]]
        while stack:
            q, node = stack.pop()
            if self.size[node] <= leaf:
                for i, s in close(query[q], self.codes[node : node + self.size[node]], radius):
                    yield q[i], self.source[node + s]
                continue
            d = hamming(query[q], self.codes[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], np.full(int(hit.sum()), self.source[node])
            for kid in self.kids[self.begin[node] : self.begin[node + 1]]:
                near = np.abs(int(self.edge[kid]) - d) <= radius
                if near.any():
                    stack.append((q[near], kid))


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def close(a: np.ndarray, b: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row of ``a``, row of ``b``) pairs within the radius, of all pairs."""
    if not len(a) or not len(b):
        return
    a0, a1, b0, b1 = (np.ascontiguousarray(x[:, k]) for x in (a, b) for k in (0, 1))
    most = 1 << 17  # what is compared at once stays in the cache
    for at in range(0, len(b), most):
        c0, c1 = b0[at : at + most], b1[at : at + most]
        for lo in range(0, len(a), step := max(1, most // len(c0))):
            d = np.bitwise_count(a0[lo : lo + step, None] ^ c0)
            d += np.bitwise_count(a1[lo : lo + step, None] ^ c1)
            hit = np.flatnonzero(d <= radius)
            if len(hit):
                i, j = np.divmod(hit, len(c0))
                yield lo + i, at + j


def _blocks(codes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(codes).view(np.uint16).reshape(len(codes), BLOCKS)


class Shards:
    """Codes by the value of a block, of which as many bits count as leave
    ``FEW`` codes to a shard, about.  Shards of more than ``leaf`` are BK-trees."""

    def __init__(self, codes: np.ndarray, value: np.ndarray, free: int = 0xFFFF, leaf: int | None = None):
        """``free``: the bits in which the values may differ."""
        bits = [1 << i for i in range(16) if free >> i & 1]
        self.keep = sum(bits[max(0, len(bits) - (len(codes) // FEW).bit_length()) :])
        shard = (value & self.keep).astype(np.int64)
        self.order = np.argsort(shard, kind="stable")
        self.codes = codes[self.order]
        n = np.bincount(shard, minlength=1 << 16)
        self.begin = np.r_[0, np.cumsum(n)]
        self.leaf = LEAF if leaf is None else leaf
        self.large = n > self.leaf
        self.trees = None
        if self.large.any():
            at = np.flatnonzero(self.large[shard[self.order]])
            self.trees, self.in_trees = BKForest(self.codes[at], shard[self.order][at]), at

    def pairs(self, query: np.ndarray, value: np.ndarray, masks: np.ndarray, radius: int, own: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) pairs within the radius whose blocks differ by one of
        ``masks``, and others.  ``own``: the queries are the codes, and one of each
        two pairs is enough."""
        masks = np.unique(masks.astype(np.int64) & self.keep)
        shard = (value & self.keep).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        keys, first = np.unique(shard[order], return_index=True)
        for x, lo, hi in zip(keys.tolist(), first.tolist(), np.r_[first[1:], len(order)].tolist()):
            q = order[lo:hi]
            near = x ^ masks
            if own:
                near = near[near >= x]
            n = self.begin[near + 1] - self.begin[near]
            for y in near[self.large[near]].tolist():
                for i, s in self.trees.search(query[q], np.full(len(q), y), radius, self.leaf):
                    yield q[i], self.order[self.in_trees[s]]
            near, n = (z[(n > 0) & ~self.large[near]] for z in (near, n))
            if not len(near):
                continue
            at = np.arange(n.sum()) + np.repeat(self.begin[near] - (np.cumsum(n) - n), n)
            for i, s in close(query[q], self.codes[at], radius):
                yield q[i], self.order[at[s]]


def shard_forest(codes: np.ndarray, leaf: int | None = None) -> list[Shards]:
    """The shards of each block: a code is in one for each."""
    values = _blocks(codes)
    return [Shards(codes, values[:, block], leaf=leaf) for block in range(BLOCKS)]


def forest_pairs(f: list[Shards], codes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, source) pairs of all queries against the shards they may have a
    partner in."""
    values = _blocks(codes)
    for block, shards in enumerate(f):
        yield from shards.pairs(codes, values[:, block], _masks(block, radius), radius)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        codes, n = signatures(b.column(2))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(codes[:, 0].view(np.int64)), pa.array(codes[:, 1].view(np.int64)), pa.array(n)], ["doc_id", "key", "a", "b", "n_words"])


def _codes_of(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = b.column("node").to_numpy(zero_copy_only=False)
    return ids, np.stack([b.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("a", "b")], 1)


def _edges(found: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    us, vs, held = [], [], 0
    for u, v in found:
        other = u != v
        us.append(u[other])
        vs.append(v[other])
        held += int(other.sum())
        if held > 1_000_000:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs, held = [u], [v], 0
    if us:
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _routed(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of codes that were sent to one place (a part of a block and its value,
    and two chunks), from the trees of the whole block there."""
    where_of = [(block, part) for block in range(BLOCKS) for part in _parts(block, radius)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            place, held = None, []
            for b in batches:  # sorted by place
                where = b.column("place").to_numpy(zero_copy_only=False)
                cuts = np.flatnonzero(np.diff(where)) + 1
                for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, len(where)]):
                    if not hi > lo:
                        continue
                    if where[lo] != place:
                        yield from within(place, held)
                        place, held = where[lo], []
                    held.append(b.slice(lo, hi - lo))
            yield from within(place, held)

        def within(place: int | None, held: list[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            if not held or sum(map(len, held)) < 2:
                return
            read = [_codes_of(b) for b in held]
            ids, codes = np.concatenate([p[0] for p in read]), np.concatenate([p[1] for p in read])
            block, same = where_of[int(place) % 65536 // 256]
            value = _blocks(codes)[:, block]
            near = _masks(block, radius)
            near = near[(near & same) == 0]
            for part in _parts(block, radius):  # what an earlier part leaves as it is meets there
                if part == same:
                    break
                near = near[(near & part) != 0]
            for i, s in Shards(codes, value, 0xFFFF & ~same).pairs(codes, value, near, radius, True):
                yield ids[i], ids[s]

        yield from _edges(found())

    return run


def _places(radius: int, chunks: int) -> F.Column:
    """All places of a code: for each part of each block its value, and the chunks
    that the code's own chunk meets."""
    out = []
    for i, (block, part) in enumerate((block, part) for block in range(BLOCKS) for part in _parts(block, radius)):
        low = (part & -part).bit_length() - 1
        bits = F.shiftrightunsigned(F.col("ab"[block // 4]), 16 * (block % 4) + low).bitwiseAND(part >> low)
        out.append(bits.cast("long") + 256 * i)
    own = F.pmod(F.xxhash64("node"), F.lit(chunks))
    meets = F.transform(F.sequence(F.lit(0), F.lit(chunks - 1)), lambda c: F.least(c.cast("long"), own) * chunks + F.greatest(c.cast("long"), own))
    return F.flatten(F.transform(F.array(*out), lambda p: F.transform(meets, lambda m: m * 65536 + p)))


def near_pairs(spark: SparkSession, nodes: DataFrame, radius: int = RADIUS, broadcast_bytes: int = BROADCAST_BYTES, held: int = HELD) -> DataFrame:
    """Edges (u, v) that connect all codes within the radius: in each task the
    pairs found are shrunk to a spanning forest, so groups of thousands give as
    many edges as members.  ``nodes``: a written table (node, a, b) of distinct
    codes."""
    if nodes.count() * NODE_BYTES <= broadcast_bytes:
        parts = nodes.toArrow().combine_chunks().to_batches()
        ids, codes = _codes_of(parts[0]) if parts else (np.zeros(0, np.int64), np.zeros((0, 2), np.uint64))
        shared = spark.sparkContext.broadcast((ids, shard_forest(codes)))

        def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            all_ids, trees = shared.value

            def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
                for b in batches:
                    own, mine = _codes_of(b)
                    for q, s in forest_pairs(trees, mine, radius):
                        yield own[q], all_ids[s]

            yield from _edges(found())

        return nodes.repartition(max(spark.sparkContext.defaultParallelism, 1)).transform(batched).mapInArrow(ask, "u long, v long")
    chunks = max(1, -(-nodes.count() // (32 * held)))  # a part has 32 values or more
    sent = nodes.withColumn("place", F.explode(_places(radius, chunks))).repartition("place").sortWithinPartitions("place")
    return sent.transform(batched).mapInArrow(_routed(radius), "u long, v long")


def near_groups(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, broadcast_bytes: int = BROADCAST_BYTES, text: str = "text") -> DataFrame:
    """(doc_id, key, n_words, n_rows, group_id, keep) for each distinct document.

    A document is a ``doc_id``, an integer, with a text (``key`` is the text's
    digest; NULL text is ''); rows that repeat both are one document, of ``n_rows``
    rows.  Very long texts are read whole; columns besides the two are not read; an
    empty table gives an empty one.  ``group_id`` is the
    least ``doc_id`` of the near-duplicate group and ``keep`` marks one document
    of each group: the least ``doc_id``, then the least key.  Documents without
    a word are in no group and stay.  Rows with a NULL ``doc_id`` are left out.
    """
    made = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), row_key(text).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    made = written(spark, made.transform(batched).mapInArrow(_scan, "doc_id long, key long, a long, b long, n_words long"), "simhash")
    made = made.groupBy("doc_id", "key", "a", "b", "n_words").agg(F.count("*").alias("n_rows"))
    with_words = made.where("n_words > 0")
    nodes = written(spark, with_words.select(F.xxhash64("a", "b").alias("node"), "a", "b").distinct(), "codes")
    roots = components(spark, near_pairs(spark, nodes, radius, broadcast_bytes))
    grouped = with_words.withColumn("node", F.xxhash64("a", "b")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = grouped.groupBy("root").agg(F.min(F.struct("doc_id", "key")).alias("first"))
    out = grouped.join(first, "root").select("doc_id", "key", "n_words", "n_rows", F.col("first.doc_id").alias("group_id"), (F.struct("doc_id", "key") == F.col("first")).alias("keep"))
    return out.unionByName(made.where("n_words = 0").select("doc_id", "key", "n_words", "n_rows", F.col("doc_id").alias("group_id"), F.lit(True).alias("keep")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, without those that
    :func:`near_groups` doesn't keep.  Of rows that repeat ``doc_id`` and text
    one stays (any, where other columns differ); rows with a NULL ``doc_id`` all
    stay, as do documents without a word.  An empty table gives an empty one."""
    groups = written(spark, near_groups(spark, docs, radius, text=text).select("doc_id", "key", "keep", "n_rows"), "groups")
    k, many = free_names(docs, "row_key", "many")
    out = docs.withColumn(k, row_key(text))
    out = attach(out, groups.where(~F.col("keep")).select("doc_id", F.col("key").alias(k)), ["doc_id", k], "left_anti", 64)
    again = groups.where("keep and n_rows > 1").select("doc_id", F.col("key").alias(k), F.lit(True).alias(many))
    if not again.isEmpty():
        out = attach(out, again, ["doc_id", k], "left", 64)
        out = out.where(F.col(many).isNull()).unionByName(out.where(many).dropDuplicates(["doc_id", k])).drop(many)
    return out.select(docs.columns)
