"""Related-document packing.

1. Each document gets a MinHash sketch of its word pairs, in one pass.
2. The nearest-neighbour graph: for each of the sketch's components, documents
   with an equal value come together and all are compared; where they are more
   than ``HELD``, they come together again by sets of two equal components, then
   of three, and so on.  A document keeps the ``NEIGHBOURS`` with the most equal
   components, of the lower node in a tie, as in a comparison of all pairs.
3. Paths: the edges of the whole graph are taken one by one, the nearest first,
   unless an edge would close a ring, give a document a third, or make a path of more
   than ``LONGEST`` times ``REGION`` documents; in distributed rounds that give the
   same.  Each path is walked from its end of the lower node.
4. Windows of ``WINDOW`` words are filled along each path; a document that doesn't
   fit goes on in the next window, so only the last window of a region has room.

Paths, of which documents without neighbours are the shortest, share regions: they
are put one after the other until a region has ``REGION`` documents.  Documents of one
sketch are divided by their digests into as many parts as they have times ``REGION``.
So a region is bounded, however large a component or a group of copies is, and
documents follow each other by the same rule in small and large ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textscan
from .common import attach, batched, components, row_key, written

#: Words in a window.
WINDOW = 2048
SKETCH = 16
NEIGHBOURS = 6
#: Sketches of a group that a task compares with each other; larger groups are
#: split by further components.
HELD = 4096
#: Groups up to this size are compared side by side in arrays.
FEW = 9
#: Equal components that make two documents neighbours, at least.
LEAST = 3
#: Documents in a region, about; the last component or path that it takes may add
#: its own.
REGION = 65_536
#: How many times that a path may have.
LONGEST = 8

_ODD = np.random.default_rng(20240607).integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(n, SKETCH) uint32 MinHash values of the word pairs, and word counts.

    A document of one word is sketched by that word; one without a word has the
    greatest value in every component and no neighbours.
    """
    out, counts = np.full((len(texts), SKETCH), 0xFFFFFFFF, np.uint32), np.zeros(len(texts), np.int64)
    for at, part in textscan.slices(texts):
        row, h, _ = textscan.words(part)
        n = np.bincount(row, minlength=len(part))
        counts[at : at + len(part)] = n
        if not len(row):
            continue
        with np.errstate(over="ignore"):
            pair = h.copy()
            inner = row[1:] == row[:-1]
            pair[:-1][inner] = (h[:-1] * np.uint64(3) + h[1:])[inner]
            last = np.r_[~inner, True] & (n[row] > 1)  # the last word pairs with none
            pair[last] = pair[np.flatnonzero(last) - 1]
            pair = (pair ^ (pair >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            begin = np.flatnonzero(np.r_[True, ~inner])
            own = at + row[begin]
            for k in range(SKETCH):
                out[own, k] = np.minimum.reduceat(((pair * _ODD[k]) >> np.uint64(32)).astype(np.uint32), begin)
    return out, counts


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        s, n = sketches(b.column(2))
        blob = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SKETCH), len(s), [None, pa.py_buffer(np.ascontiguousarray(s.astype(">u4")).tobytes())]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), blob, pa.array(n)], ["doc_id", "key", "sketch", "n_words"])


def _value(s: np.ndarray, mask: int) -> np.ndarray:
    """A 64-bit value that sketches equal in the components of ``mask`` share."""
    h = np.full(len(s), mask, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SKETCH):
            if mask >> k & 1:
                h = (h ^ s[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
    return h.view(np.int64)


def _blob(s: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * SKETCH), len(s), [None, pa.py_buffer(np.ascontiguousarray(s.astype(">u4")).tobytes())]).cast(pa.binary())


def _unblob(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").reshape(-1, SKETCH).astype(np.uint32)


_SENT = "mask int, value long, node long, sketch binary"


def _sent(mask: int, s: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.full(len(s), mask, np.int32)), pa.array(_value(s, mask)), pa.array(node), _blob(s)], ["mask", "value", "node", "sketch"])


def _singles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each component of each sketch."""
    for b in batches:
        s, node = _unblob(b.column(1)), b.column(0).to_numpy(zero_copy_only=False)
        for k in range(SKETCH):
            yield _sent(1 << k, s, node)


def _deeper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows for the sets of components with one more than those that are shared
    by too many.  Only components that are themselves shared by too many are
    added: a pair with an equal component that isn't has been compared there."""
    for b in batches:
        s, node = _unblob(b.column(1)), b.column(0).to_numpy(zero_copy_only=False)
        rows: dict[int, list[int]] = {}
        for i, (masks, hot) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist())):
            for m in {m | 1 << k for m in masks for k in range(SKETCH) if hot >> k & 1 and not m >> k & 1}:
                rows.setdefault(m, []).append(i)
        for m, i in rows.items():
            yield _sent(m, s[i], node[i])


def nearest(s: np.ndarray, neighbours: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, row, equal components): the nearest of each sketch among all of
    them, by the number of equal components, then by row; LEAST at least."""
    m = len(s)
    codes = [np.unique(c, return_inverse=True)[1] for c in s.T]
    codes = [c.astype(np.uint16 if m <= 65536 else np.int64) for c in codes if c.max() + 1 < m]
    us, vs, ms = [], [], []
    for lo in range(0, m, step := max(1, (1 << 20) // m)):
        hi = min(m, lo + step)
        same = np.zeros((hi - lo, m), np.int8)
        for c in codes:
            same += c[lo:hi, None] == c[None, :]
        same[np.arange(hi - lo), np.arange(lo, hi)] = 0
        some = np.flatnonzero(same.max(1) >= LEAST)
        if not len(some):
            continue
        same = same[some]
        score = np.arange(m)[None, :] - same.astype(np.int64) * m
        top = np.argpartition(score, neighbours - 1, 1)[:, :neighbours] if m > neighbours else np.broadcast_to(np.arange(m), score.shape)
        n = np.take_along_axis(same, top, 1)
        ok = n >= LEAST
        us.append(np.broadcast_to((lo + some)[:, None], top.shape)[ok])
        vs.append(top[ok])
        ms.append(n[ok])
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (us, vs, ms))


def _search(neighbours: int, held: int):
    """Edges within the groups of equal (mask, value), whose rows come together in
    order of node; the members of groups of more than ``held`` are sent on, with
    the components in which the whole group is equal.

    A member of such a group is compared with its lowest nodes only: of those that
    share no more with it than the whole group does, no other can be among its
    nearest, and those that share more meet it in a deeper group.
    """

    def edges(u: np.ndarray, v: np.ndarray, m: np.ndarray) -> pa.RecordBatch:
        none = pa.nulls(len(u), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), pa.array(m.astype(np.int32)), none, none, pa.nulls(len(u), pa.int64()), pa.nulls(len(u), pa.binary())], _FOUND_NAMES)

    def sent_on(node: np.ndarray, s: np.ndarray, mask: int, value: int) -> pa.RecordBatch:
        n = len(node)
        return pa.RecordBatch.from_arrays([pa.array(node), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.array(np.full(n, mask, np.int32)), pa.nulls(n, pa.int32()), pa.array(np.full(n, value, np.int64)), _blob(s)], _FOUND_NAMES)

    def with_lowest(node: np.ndarray, s: np.ndarray, low: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        m = (s[:, None, :] == low[1][None, :, :]).sum(2)
        i, j = np.nonzero((m >= LEAST) & (node[:, None] != low[0][None, :]))
        return edges(node[i], low[0][j], m[i, j])

    def closed(mask: int, value: int, equal: np.ndarray) -> pa.RecordBatch:
        """A row that says in which components the whole group is equal."""
        whole = int((equal.astype(np.int64) << np.arange(SKETCH)).sum())
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.array([mask], pa.int32()), pa.array([whole], pa.int32()), pa.array([value], pa.int64()), pa.nulls(1, pa.binary())], _FOUND_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None  # the last group so far
        large = None  # (mask, value, its lowest nodes with their sketches, equal components) of a group that is sent on
        for b in _and_end(batches):
            end = b is None
            if not end and not len(b):
                continue
            now = None if end else [b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False), _unblob(b.column(3))]
            if large is not None:
                more = 0 if end else int(np.argmin(np.r_[(now[0] == large[0]) & (now[1] == large[1]), False]))
                if more:
                    node, s = now[2][:more], now[3][:more]
                    large[3][:] &= (s == large[2][1][0]).all(0)
                    yield sent_on(node, s, large[0], large[1])
                    yield with_lowest(node, s, large[2])
                    now = [x[more:] for x in now]
                if end or len(now[0]):
                    yield closed(large[0], large[1], large[3])
                    large = None
                if end or not len(now[0]):
                    if end and rest is None:
                        return
                    continue
            if rest is not None:
                now = rest if end else [np.concatenate(x) for x in zip(rest, now)]
                rest = None
            if now is None:
                return
            mask, value, node, s = now
            begin = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])])
            size = np.diff(np.r_[begin, len(mask)])
            if not end:
                last = begin[-1]
                if size[-1] > held:
                    low = (node[last : last + neighbours + 1], s[last : last + neighbours + 1])
                    large = (int(mask[last]), int(value[last]), low, (s[last:] == s[last]).all(0))
                    yield sent_on(node[last:], s[last:], large[0], large[1])
                    yield with_lowest(node[last:], s[last:], low)
                else:
                    rest = [x[last:] for x in now]
                begin, size = begin[:-1], size[:-1]
            few = np.repeat(size <= FEW, size)
            group = np.repeat(np.arange(len(size)), size)
            us, vs, ms = [], [], []
            for step in range(1, FEW):
                a = np.flatnonzero(few[:-step] & (group[:-step] == group[step:])) if len(group) > step else np.zeros(0, np.int64)
                if not len(a):
                    break
                m = (s[a] == s[a + step]).sum(1)
                a, m = a[m >= LEAST], m[m >= LEAST]
                us += [node[a], node[a + step]]
                vs += [node[a + step], node[a]]
                ms += [m, m]
            for g in np.flatnonzero(size > FEW):
                at = slice(begin[g], begin[g] + size[g])
                if size[g] > held:
                    low = (node[at][: neighbours + 1], s[at][: neighbours + 1])
                    yield sent_on(node[at], s[at], int(mask[begin[g]]), int(value[begin[g]]))
                    yield with_lowest(node[at], s[at], low)
                    yield closed(int(mask[begin[g]]), int(value[begin[g]]), (s[at] == s[begin[g]]).all(0))
                    continue
                u, v, m = nearest(s[at], neighbours)
                us.append(node[at][u])
                vs.append(node[at][v])
                ms.append(m)
            if us:
                yield edges(*(np.concatenate(x) for x in (us, vs, ms)))

    return run


_FOUND = "u long, v long, same int, mask int, whole int, value long, sketch binary"
_FOUND_NAMES = ["u", "v", "same", "mask", "whole", "value", "sketch"]


def _and_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def neighbour_graph(spark: SparkSession, nodes: DataFrame, neighbours: int = NEIGHBOURS, held: int = HELD) -> DataFrame:
    """(u, v, same): the nearest neighbours of each node of the table ``nodes``
    (node, sketch), by the number of equal components, then by node."""
    sent, pairs, hot = nodes.select("node", "sketch").transform(batched).mapInArrow(_singles, _SENT), None, None
    while True:
        sent = sent.repartition("mask", "value").sortWithinPartitions("mask", "value", "node")
        found = written(spark, sent.transform(batched).mapInArrow(_search(neighbours, held), _FOUND), "found")
        edges = found.where("v IS NOT NULL").select("u", "v", "same")
        pairs = edges if pairs is None else pairs.union(edges)
        closed = found.where("whole IS NOT NULL").select("mask", "value", "whole")
        if closed.isEmpty():
            break
        on = found.where("sketch IS NOT NULL").select(F.col("u").alias("node"), "sketch", "mask", "value").join(closed, ["mask", "value"])
        masks = on.groupBy("node").agg(F.first("sketch").alias("sketch"), F.collect_set("whole").alias("masks"), F.bit_or("mask").alias("own"))
        if hot is None:
            hot = written(spark, masks.select("node", F.col("own").alias("hot")), "hot")
        sent = masks.join(hot, "node").select("node", "sketch", "masks", "hot").transform(batched).mapInArrow(_deeper, _SENT)
    best = F.slice(F.sort_array(F.collect_set(F.struct(-F.col("same"), F.col("v")))), 1, neighbours)
    top = pairs.groupBy("u").agg(best.alias("b")).select("u", F.explode("b").alias("b"))
    return top.select("u", F.col("b.v").alias("v"), (-F.col("b.col1")).alias("same"))


def _join(edges: pd.DataFrame, most: int) -> pd.DataFrame:
    """The edges that paths are joined by, taken in order; a node takes two, and a
    path takes no more than ``most`` documents."""
    e = edges.sort_values(["low", "tie", "u", "v"])
    parent: dict[int, int] = {}
    degree: dict[int, int] = {}
    size: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    taken = []
    for i, (u, v, fu, fv, du, dv, nu, nv) in enumerate(e[["u", "v", "fu", "fv", "du", "dv", "nu", "nv"]].itertuples(index=False, name=None)):
        size.setdefault(fu, nu)
        size.setdefault(fv, nv)
        a, b = top(fu), top(fv)
        if a != b and degree.setdefault(u, du) < 2 and degree.setdefault(v, dv) < 2 and size[a] + size[b] <= most:
            parent[a] = b
            size[b] += size[a]
            degree[u] += 1
            degree[v] += 1
            taken.append(i)
    return e.iloc[taken][["u", "v", "low"]]


def greedy_paths(spark: SparkSession, graph: DataFrame, held: int, weights: DataFrame | None = None, most: int = 1 << 40) -> DataFrame:
    """(u, v, same): the edges of ``graph`` that paths are made of when edges are
    taken one by one, the nearest first, unless they would close a ring, give a
    node a third, or make a path of more than ``most`` documents (``weights``: node,
    docs; 1 by default).

    Edges that come first at both of their paths are taken at once, in rounds, with
    the same result, until no more than ``held`` are left, which one task takes.
    """
    pair = graph.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), (-F.col("same")).alias("low")).distinct()
    for x in "uv":
        of = F.lit(1).cast("long").alias("n" + x)
        pair = pair.withColumn("n" + x, of) if weights is None else pair.join(weights.select(F.col("node").alias(x), F.col("docs").alias("n" + x)), x)
    left = pair.select("u", "v", "low", F.xxhash64("u", "v").alias("tie"), F.col("u").alias("fu"), F.col("v").alias("fv"), F.lit(0).alias("du"), F.lit(0).alias("dv"), "nu", "nv")
    left = written(spark, left.where(F.col("nu") + F.col("nv") <= most), "left")
    taken = []
    while left.count() > held:
        best = left.select(F.explode(F.array("fu", "fv")).alias("f"), F.struct("low", "tie", "u", "v", "fu", "fv", "nu", "nv").alias("e")).groupBy("f").agg(F.min("e").alias("e"))
        now = written(spark, best.groupBy("e").count().where("count = 2").select("e.*"), "taken")
        taken.append(now.select("u", "v", "low"))
        used = now.select(F.explode(F.array("u", "v")).alias("n"))
        moved = now.select(F.explode(F.array("fu", "fv")).alias("f"), F.least("fu", "fv").alias("to"), (F.col("nu") + F.col("nv")).alias("n"))
        for x in "uv":
            left = left.join(used.select(F.col("n").alias(x), F.lit(1).alias("more")), x, "left").withColumn("d" + x, F.col("d" + x) + F.coalesce("more", F.lit(0))).drop("more")
            left = left.join(moved.withColumnRenamed("f", "f" + x), "f" + x, "left").withColumns({"f" + x: F.coalesce("to", "f" + x), "n" + x: F.coalesce("n", "n" + x)}).drop("to", "n")
        left = written(spark, left.where("fu <> fv AND du < 2 AND dv < 2").where(F.col("nu") + F.col("nv") <= most), "left")
    out = left.withColumn("one", F.col("du") * 0).groupBy("one").applyInPandas(lambda e: _join(e, most), "u long, v long, low int")
    for x in taken:
        out = out.union(x)
    return out.select("u", "v", (-F.col("low")).alias("same"))


def walk(node: np.ndarray, u: np.ndarray, v: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(path, place on it) of each node: greedy paths from the nodes of least
    degree.  The graph is taken as undirected; ties go to the lower node."""
    order = np.argsort(node)
    a, b = order[np.searchsorted(node[order], np.r_[u, v])], order[np.searchsorted(node[order], np.r_[v, u])]
    both = np.unique(np.stack([a, b, np.r_[same, same]], 1), axis=0)
    a, b, w = both.T if len(both) else (np.zeros(0, np.int64),) * 3
    degree = np.bincount(a, minlength=len(node))
    near = np.lexsort((node[b], degree[b], -w, a))
    b, begin = b[near].tolist(), np.searchsorted(a[near], np.arange(len(node) + 1)).tolist()
    path, place = [-1] * len(node), [0] * len(node)
    n_paths = 0
    for at in np.lexsort((node, degree)).tolist():
        if path[at] >= 0:
            continue
        step = 0
        while at is not None:
            path[at], place[at] = n_paths, step
            step += 1
            at = next((x for x in b[begin[at] : begin[at + 1]] if path[x] < 0), None)
        n_paths += 1
    return np.array(path, np.int64), np.array(place, np.int64)


def fill(region: int, doc_id: np.ndarray, n_words: np.ndarray, window: int = WINDOW) -> pd.DataFrame:
    """The pieces of the documents, in the given order, window by window."""
    end = np.cumsum(n_words)
    begin = end - n_words
    first, last = begin // window, np.maximum(end - 1, begin) // window
    n = np.where(n_words > 0, last - first + 1, 0)
    who = np.repeat(np.arange(len(n)), n)
    number = np.repeat(first, n) + np.arange(len(who)) - np.repeat(np.cumsum(n) - n, n)
    lo, hi = np.maximum(begin[who], number * window), np.minimum(end[who], (number + 1) * window)
    return pd.DataFrame({"region": region, "window": number, "at": lo - number * window, "doc_id": doc_id[who], "begin_word": lo - begin[who], "end_word": hi - begin[who], "who": who})


def regions(member: DataFrame, region: int) -> DataFrame:
    """(root, region): where the documents of each root go.  Roots are dealt to as
    many buckets as there are 16 regions, and in a bucket, in order, put one after
    the other until a region has ``region`` documents."""
    sizes = member.groupBy("root").agg(F.count("*").alias("docs"))
    buckets = max(1, -(-member.count() // (16 * region)))
    before = Window.partitionBy("bucket").orderBy("root").rowsBetween(Window.unboundedPreceding, -1)
    dealt = sizes.withColumn("bucket", F.pmod(F.xxhash64("root"), F.lit(buckets))).withColumn("at", F.coalesce(F.sum("docs").over(before), F.lit(0)))
    return dealt.select("root", F.concat(F.lit("r"), "bucket", F.lit("."), F.floor(F.col("at") / region)).alias("region"))


def pack(spark: SparkSession, docs: DataFrame, window: int = WINDOW, region: int = REGION, text: str = "text") -> DataFrame:
    """(window_id string, at, doc_id, begin_word, end_word, path, place): which
    words of which document stand from word ``at`` on in which window.

    A document's pieces cover all its words once and in order, however long it is.
    Rows that repeat ``doc_id``, an integer, and text are one document, packed once.
    NULL or empty texts and texts without a word take no room and aren't listed, nor
    are rows with a NULL ``doc_id``.  Columns besides the two are not read; an empty
    table gives an empty one.
    """
    made = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), row_key(text).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    made = written(spark, made.transform(batched).mapInArrow(_scan, "doc_id long, key long, sketch binary, n_words long"), "sketches")
    distinct = made.where("n_words > 0").distinct().withColumn("node", F.xxhash64("sketch"))
    nodes = distinct.groupBy("node").agg(F.first("sketch").alias("sketch"))
    graph = written(spark, neighbour_graph(spark, nodes), "graph")
    member = distinct.select("doc_id", "key", "n_words", "node")
    many = written(spark, member.groupBy("node").agg(F.count("*").alias("docs")).where(F.col("docs") > region), "many")
    if not many.isEmpty():  # all others have one part; the first stays at its node
        part = F.pmod(F.xxhash64("doc_id", "key"), F.ceil(F.col("docs") / region))
        member = attach(member, many, ["node"], "left", 32).withColumn("part", F.coalesce(part, F.lit(0)))
        member = member.withColumn("node", F.when(F.col("part") > 0, F.xxhash64("node", "part")).otherwise(F.col("node"))).drop("docs", "part")
    weights = written(spark, member.groupBy("node").agg(F.count("*").alias("docs")), "weights")
    graph = written(spark, greedy_paths(spark, graph, NEIGHBOURS * REGION, weights, LONGEST * region), "paths")
    roots = components(spark, graph.select("u", "v"))
    member = written(spark, member.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "members")
    packed = member.join(regions(member, region), "root").select("region", "doc_id", "key", "n_words", "node")
    inside = graph.join(packed.select(F.col("node").alias("u"), F.col("region").alias("part")).distinct(), "u").select(F.col("part").alias("region"), "u", "v", "same")

    def run(key: tuple, members: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        node = np.unique(members["node"].to_numpy())
        path, place = walk(node, edges["u"].to_numpy(np.int64), edges["v"].to_numpy(np.int64), edges["same"].to_numpy(np.int64))
        at = np.searchsorted(node, members["node"].to_numpy())
        members = members.assign(path=path[at], place=place[at]).sort_values(["path", "place", "doc_id", "key"], ignore_index=True)
        out = fill(0, members["doc_id"].to_numpy(), members["n_words"].to_numpy(), window)
        who = out["who"].to_numpy()
        out = out.assign(window_id=key[0] + "-" + out["window"].astype(str), path=members["path"].to_numpy()[who], place=members["place"].to_numpy()[who])
        return out[["window_id", "at", "doc_id", "begin_word", "end_word", "path", "place"]]

    return packed.groupBy("region").cogroup(inside.groupBy("region")).applyInPandas(run, "window_id string, at long, doc_id long, begin_word long, end_word long, path long, place long")
