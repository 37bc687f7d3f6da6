"""Embedding near-duplicates by a forest of random-projection trees.

Every node of a tree splits its vectors at the median of their projections on a
random direction of its own; vectors between the quantiles 0.5 - SPILL and
0.5 + SPILL go to both sides.  Vectors that share a leaf in any tree are compared;
pairs of at least the wanted cosine are united.

What goes to the trees is a code of each vector, a byte for a value, with the length
of what the code leaves out.  That length bounds the error of a cosine between
codes, so a pair is surely near, surely not, or is asked of the vectors themselves:
the outcome is that of comparing the vectors.  Vectors of equal codes, which are
surely near, are one point.

Trees are grown in rounds of ``ROUND`` levels.  While a node holds more than
``SUBTREE`` points, its next levels are fitted on about ``SAMPLE`` of its points,
chosen by hash, and all its points take their way through them; from there on, one
task grows the rest of the tree over all points of the node and compares its
leaves.  Splits of the first round are at most 2 ** ROUND for each tree; those of
later rounds stay distributed and are joined to their points.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import attach, batched, components, forest, written

#: The least cosine of near-duplicates.
COSINE = 0.9
TREES = 8
SPILL = 0.05
LEAF = 128
#: Points that one task takes to grow a subtree on.
SUBTREE = 20_000
#: Levels that are fitted at once above the subtrees.
ROUND = 6
#: Points of a node that its next levels are fitted on, about.
SAMPLE = 20_000
_SEED = 1729
#: Bytes of a code besides the values: the scale and the error, as float32.
_TAIL = 8
#: Steps of the scale in a doubling: nearly equal vectors have the same scale.
_STEPS = 8


def direction(tree: int, node: int, dim: int) -> np.ndarray:
    """The direction of a tree's node, the same wherever it is made."""
    return np.random.default_rng([_SEED, tree, node]).standard_normal(dim).astype(np.float32)


def encode(x: np.ndarray) -> np.ndarray:
    """The codes of vectors of length 1: (n, dim + _TAIL) bytes."""
    step = np.ceil(np.log2(np.abs(x).max(1)) * _STEPS)
    scale = (2.0 ** (step / _STEPS) / 127).astype(np.float32)
    q = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
    error = np.sqrt(((x.astype(np.float64) - q * scale[:, None].astype(np.float64)) ** 2).sum(1)) + 1e-6
    tail = np.stack([scale, error.astype(np.float32)], 1)
    return np.concatenate([q.view(np.uint8), tail.view(np.uint8).reshape(len(x), _TAIL)], 1)


def decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, errors) of codes."""
    tail = np.ascontiguousarray(codes[:, -_TAIL:]).view(np.float32)
    return codes[:, :-_TAIL].view(np.int8).astype(np.float32) * tail[:, :1], tail[:, 1]


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equal widths as a matrix, in place."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    off = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[off[0] : off[-1]].reshape(-1, width)


def _binary(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    rows = np.ascontiguousarray(rows)
    width = rows.itemsize * (rows.shape[1] if rows.ndim == 2 else 1)
    off = (np.arange(len(rows) + 1, dtype=np.int64) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(off), pa.py_buffer(rows)])


def halves(p: np.ndarray, lo: float, mid: float, hi: float) -> tuple[np.ndarray, np.ndarray]:
    """Which points go left and right; those in the overlap go both ways."""
    spill = (p >= lo) & (p <= hi) & (lo < hi)
    return (p <= mid) | spill, (p > mid) | spill


Splits = dict[int, tuple[float, float, float]]


def grow(x: np.ndarray, tree: int, at: int, levels: int, spill: float) -> Splits:
    """The splits of the next levels below a node, fitted on the given points."""
    out: Splits = {}
    work = [(at, np.arange(len(x)), levels)]
    while work:
        node, own, left = work.pop()
        if not left or len(own) < 2:
            continue
        p = x[own] @ direction(tree, node, x.shape[1])
        out[node] = tuple(map(float, np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill])))
        for side, kid in zip(halves(p, *out[node]), (2 * node, 2 * node + 1)):
            work.append((kid, own[side], left - 1))
    return out


def descend(x: np.ndarray, tree: int, at: int, splits: Splits) -> Iterator[tuple[int, np.ndarray]]:
    """(node, its points) where the splits end."""
    work = [(at, np.arange(len(x)))]
    while work:
        node, own = work.pop()
        if node not in splits or not len(own):
            if len(own):
                yield node, own
            continue
        left, right = halves(x[own] @ direction(tree, node, x.shape[1]), *splits[node])
        work += [(2 * node + 1, own[right]), (2 * node, own[left])]


def leaf_pairs(x: np.ndarray, error: np.ndarray, cosine: float, leaf: int, spill: float, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, surely) for the pairs that are, or may be, of at least the cosine,
    found in the leaves of one tree.

    A node whose points can't be told apart by a direction is a leaf, compared
    in blocks however large it is.
    """
    work = [np.arange(len(x))]
    while work:
        own = work.pop()
        if len(own) > leaf:
            p = x[own] @ rng.standard_normal(x.shape[1]).astype(np.float32)
            left, right = halves(p, *np.quantile(p, [0.5 - spill, 0.5, 0.5 + spill]))
            if max(left.sum(), right.sum()) < len(own):
                work += [own[left], own[right]]
                continue
        for i in range(0, len(own), 2048):
            a = own[i : i + 2048]
            for j in range(i, len(own), 2048):
                b = own[j : j + 2048]
                s = x[a] @ x[b].T
                bound = error[a][:, None] * (1 + error[b][None, :]) + error[b][None, :]
                u, v = np.nonzero(s + bound >= cosine)
                ok = a[u] < b[v] if i != j else u < v
                u, v = u[ok], v[ok]
                yield a[u], b[v], (s - bound)[u, v] >= cosine


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors of length 1) by length, of those that have a direction."""
    off = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL becomes NaN
    size = np.diff(off)
    size[np.asarray(column.is_null())] = 0
    for dim in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == dim)
        for i in range(0, len(rows), step := max(1, (1 << 18) // dim)):
            own = rows[i : i + step]
            x = values[off[own][:, None] + np.arange(dim)]
            with np.errstate(over="ignore", invalid="ignore"):
                norm = np.sqrt((x * x).sum(1))
            good = np.isfinite(norm) & (norm > 0)
            if good.any():
                yield own[good], (x[good] / norm[good][:, None]).astype(np.float32)


_POINT = "id long, dim int, h1 long, h2 long, code binary, v binary"


def points(df: DataFrame, id_col: str, vector: str, cosine: float = COSINE) -> DataFrame:
    """(id, dim, h1, h2, code, v): the vectors, scaled to length 1; those of one
    digest (h1, h2) are surely nearer to each other than the cosine.

    Vectors that are NULL, empty, zero, or hold a NULL or a value that isn't finite
    have no direction and are left out, as are rows with a NULL id.
    """
    most = math.sqrt(max(0.0, 1 - cosine - 1e-6) / 2)  # two vectors this far from one code are of the cosine

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for rows, x in _vectors(b.column(1)):
                codes = encode(x)
                own = decode(codes)[1] > most
                digest = b"".join(xxhash.xxh3_128_digest((v if far else c[:-4]).tobytes()) for c, v, far in zip(codes, x, own))
                h = np.frombuffer(digest, np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(ids[rows]), pa.array(np.full(len(x), x.shape[1], np.int32)), pa.array(h[:, 0]), pa.array(h[:, 1]), _binary(codes), _binary(x)], ["id", "dim", "h1", "h2", "code", "v"])

    kind = f"array<{df.schema[vector].dataType.elementType.simpleString()}>"
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    return df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast(kind).alias("v")).transform(batched).mapInArrow(run, _POINT)


_GROUP = "tree int, at long, nodes binary, codes binary"


def _group(tree: int, at: int, nodes: np.ndarray, codes: np.ndarray) -> pa.RecordBatch:
    """The points of a batch that are at one node, as one row."""
    return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([at], pa.int64()), _binary(nodes.reshape(1, -1)), _binary(codes.reshape(1, -1))], ["tree", "at", "nodes", "codes"])


def _ungroup(table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, codes) of all rows."""
    n, c = table["nodes"].to_pylist(), table["codes"].to_pylist()
    return np.frombuffer(b"".join(n), np.int64), np.frombuffer(b"".join(c), np.uint8).reshape(-1, dim + _TAIL)


def near_edges(spark: SparkSession, nodes: DataFrame, dim: int, cosine: float = COSINE, trees: int = TREES, spill: float = SPILL, leaf: int = LEAF, subtree: int = SUBTREE, levels_a_round: int = ROUND, sample: int = SAMPLE, every_pair: bool = False) -> DataFrame:
    """(u, v, surely) between the points of the written table ``nodes`` (node, code),
    all of ``dim`` values: a spanning forest of what each task finds, or every pair,
    and the pairs that the codes can't decide."""
    n = nodes.count()
    levels = max(0, math.ceil(math.log2(max(n, 1) / subtree)))
    first = min(levels, levels_a_round)

    def chosen(node: np.ndarray, share: float, seed: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (node.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < share

    def fit(levels_now: int):
        def run(key: tuple, table: pa.Table) -> pa.Table:
            tree, at = key[0].as_py(), key[1].as_py()
            ids, codes = _ungroup(table, dim)
            order = np.argsort(ids)  # the same splits whatever the order of arrival
            made = grow(decode(codes[order])[0], tree, at, levels_now, spill)
            return pa.table({"tree": pa.array([tree], pa.int32()), "at": pa.array([at], pa.int64()), "split": pa.array([list(made)], pa.list_(pa.int64())), "cuts": pa.array([[c for x in made.values() for c in x]], pa.list_(pa.float64()))})

        return run

    def splits_of(split, cuts) -> Splits:
        return {k: (cuts[3 * i], cuts[3 * i + 1], cuts[3 * i + 2]) for i, k in enumerate(split)}

    _SPLITS = "tree int, at long, split array<long>, cuts array<double>"
    every: dict[int, Splits] = {t: {} for t in range(trees)}
    if first:
        share = sample / n

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                node, codes = b.column(0).to_numpy(zero_copy_only=False), _bytes(b.column(1), dim + _TAIL)
                take = chosen(node, share, 0)
                if take.any():
                    for t in range(trees):
                        yield _group(t, 1, node[take], codes[take])

        fitted = nodes.transform(batched).mapInArrow(pick, _GROUP).groupBy("tree", "at").applyInArrow(fit(first), _SPLITS)
        every |= {r["tree"]: splits_of(r["split"], r["cuts"]) for r in fitted.collect()}  # at most 2 ** levels_a_round for each tree
    shared = spark.sparkContext.broadcast(every)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, codes = b.column(0).to_numpy(zero_copy_only=False), _bytes(b.column(1), dim + _TAIL)
            x = decode(codes)[0]
            for t in range(trees):
                for at, own in descend(x, t, 1, shared.value[t]):
                    yield _group(t, at, node[own], codes[own])

    found = nodes.transform(batched).mapInArrow(send, _GROUP)
    left, round_ = levels - first, 0
    while left > 0:
        found = written(spark, found, "groups")
        size = F.sum(F.octet_length("nodes") / F.lit(8)).alias("points")
        large = written(spark, found.groupBy("tree", "at").agg(size).where(F.col("points") > subtree), "large")
        if large.isEmpty():
            break
        now, round_ = min(left, levels_a_round), round_ + 1
        left -= now

        def pick_again(batches: Iterator[pa.RecordBatch], seed: int = round_) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(len(b)):
                    node, codes = _ungroup(b.slice(i, 1), dim)
                    take = chosen(node, sample / b.column("points")[i].as_py(), seed)
                    if take.any():
                        yield _group(b.column("tree")[i].as_py(), b.column("at")[i].as_py(), node[take], codes[take])

        sampled = attach(found, large, ["tree", "at"], "inner", 40).transform(batched).mapInArrow(pick_again, _GROUP)
        fitted = written(spark, sampled.groupBy("tree", "at").applyInArrow(fit(now), _SPLITS), "splits")

        def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(len(b)):
                    tree, at = b.column("tree")[i].as_py(), b.column("at")[i].as_py()
                    node, codes = _ungroup(b.slice(i, 1), dim)
                    splits = splits_of(b.column("split")[i].as_py() or [], b.column("cuts")[i].as_py() or [])
                    for to, own in descend(decode(codes)[0], tree, at, splits):
                        yield _group(tree, to, node[own], codes[own])

        found = attach(found, fitted, ["tree", "at"], "left", 64 << now).transform(batched).mapInArrow(go_on, _GROUP)

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        ids, codes = _ungroup(table, dim)
        order = np.argsort(ids)  # the same tree whatever the order of arrival
        ids = ids[order]
        x, error = decode(codes[order])
        rng = np.random.default_rng([_SEED, 7, key[0].as_py(), key[1].as_py()])
        us, vs, held = [], [], 0
        maybe = [(ids[:0], ids[:0])]
        for u, v, surely in leaf_pairs(x, error, cosine, leaf, spill, rng):
            us.append(ids[u[surely]])
            vs.append(ids[v[surely]])
            maybe.append((ids[u[~surely]], ids[v[~surely]]))
            held += len(us[-1])
            if held > 1_000_000 and not every_pair:
                u, v = forest(np.concatenate(us), np.concatenate(vs))
                us, vs, held = [u], [v], 0
        u, v = (np.concatenate(us), np.concatenate(vs)) if us else (ids[:0], ids[:0])
        a, b = (np.concatenate(y) for y in zip(*maybe))
        if not every_pair:
            u, v = forest(u, v)
            if len(a) and len(u):  # those that are united already need no answer
                o = np.argsort(u)
                top = lambda y: np.where(u[o][i := np.minimum(np.searchsorted(u[o], y), len(u) - 1)] == y, v[o][i], y)
                apart = top(a) != top(b)
                a, b = a[apart], b[apart]
        u, v = np.r_[np.minimum(u, v), np.minimum(a, b)], np.r_[np.maximum(u, v), np.maximum(a, b)]
        return pa.table({"u": u, "v": v, "surely": np.arange(len(u)) < len(u) - len(a)})

    return found.groupBy("tree", "at").applyInArrow(compare, "u long, v long, surely boolean").distinct()


def _asked(spark: SparkSession, own: DataFrame, first: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    """The pairs (u, v) whose vectors are of at least the cosine."""
    need = written(spark, pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().join(first, "node"), "asked")
    vectors = attach(own, need, ["h1", "h2"], "inner", 64).where("id = node").groupBy("h1", "h2", "node").agg(F.first("v").alias("v")).select("node", "v")
    both = pairs.join(vectors.select(F.col("node").alias("u"), F.col("v").alias("x")), "u").join(vectors.select(F.col("node").alias("v"), F.col("v").alias("y")), "v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [bool(np.dot(np.frombuffer(x, np.float32), np.frombuffer(y, np.float32)) >= cosine) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return both.select("u", "v", "x", "y").transform(batched).mapInArrow(run, "u long, v long")


def _edges(spark: SparkSession, own: DataFrame, cosine: float, every_pair: bool, **options) -> tuple[DataFrame, DataFrame]:
    """(the least id of each digest, edges between those)."""
    first = written(spark, own.groupBy("h1", "h2").agg(F.min(F.struct("id", "dim")).alias("m")).select("h1", "h2", F.col("m.id").alias("node"), F.col("m.dim").alias("dim")), "firsts")
    nodes = attach(own.select("h1", "h2", F.col("id").alias("node"), "code", "dim"), first.drop("dim"), ["h1", "h2", "node"], "left_semi", 64)
    nodes = written(spark, nodes.groupBy("h1", "h2", "dim", "node").agg(F.first("code").alias("code")).drop("h1", "h2"), "points")
    out = spark.createDataFrame([], "u long, v long")
    for (dim,) in first.select("dim").distinct().collect():  # the models that made the vectors: a few
        found = written(spark, near_edges(spark, nodes.where(F.col("dim") == dim).select("node", "code"), dim, cosine, every_pair=every_pair, **options), "pairs")
        out = out.union(found.where("surely").select("u", "v"))
        maybe = found.where("not surely").select("u", "v")
        if not maybe.isEmpty():
            out = out.union(_asked(spark, own.where(F.col("dim") == dim), first.where(F.col("dim") == dim).drop("dim"), maybe, cosine))
    return first, out


def near_pairs(spark: SparkSession, df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """Every pair (u, v), u < v, of distinct points of at least the cosine that the
    forest finds; vectors of equal codes are one point, of their least id."""
    own = written(spark, points(df, id_col, vector, cosine), "vectors")
    return _edges(spark, own, cosine, True, **options)[1].distinct()


def near_groups(spark: SparkSession, df: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector: str = "embedding", **options) -> DataFrame:
    """(id, group_id, keep) for every distinct id, an integer; ``group_id`` is the
    least id of its group, and ``keep`` marks that one.

    Vectors without a direction (see :func:`points`) are groups of one.  Vectors
    of different lengths are never near.  An id with several vectors belongs to
    the group of each, which are then one.  Rows with a NULL id are left out, and
    an empty table gives an empty one.  Columns besides the two named are not read.
    """
    own = written(spark, points(df, id_col, vector, cosine), "vectors")
    first, edges = _edges(spark, own, cosine, False, **options)
    same = own.select("id", "h1", "h2").join(first.drop("dim"), ["h1", "h2"]).where("id != node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    roots = components(spark, same.union(edges)).select(F.col("node").alias("id"), "root")
    every = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id")).distinct()
    group = F.coalesce("root", "id")
    return every.join(roots, "id", "left").select(F.col("id").alias(id_col), group.alias("group_id"), (group == F.col("id")).alias("keep"))
