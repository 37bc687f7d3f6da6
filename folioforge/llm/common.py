"""Shared plumbing of the training-data operators: where intermediate tables go,
checked broadcasts, anti-joins that spare the text a shuffle, and connected
components of an edge table."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.udf import BATCH_BYTES, batched  # noqa: F401  # for the operators

#: A side is broadcast only when its counted size is below this.
BROADCAST_BYTES = 32 << 20

_own_dir: list[str] = []
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from ``spark.checkpoint.dir``.

    Only where the session names none (a local test session) is one made in the
    machine's temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _own_dir:
        _own_dir.append("file://" + tempfile.mkdtemp(prefix="folioforge-"))
        atexit.register(shutil.rmtree, _own_dir[0][7:], True)
    return _own_dir[0]


def written(spark: SparkSession, df: DataFrame, tag: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: it cuts the
    lineage, survives the loss of executors and is computed once however often
    it is used.  ``options`` are those of the writer."""
    path = f"{shared_dir(spark)}/folioforge/{tag}-{uuid.uuid4().hex}"
    df.write.options(**options or {}).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete tables that :func:`written` made, by default all of this session:
    to be called when the results that read them have been saved."""
    for p in list(_written if paths is None else paths):
        q = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        q.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(q, True)
        if p in _written:
            _written.remove(p)


def settled(spark: SparkSession, make: Callable[[], DataFrame], tag: str) -> tuple[DataFrame, str]:
    """What ``make`` returns, written, and its path; all else that was written on the
    way to it is deleted."""
    before = set(_written)
    out = written(spark, make(), tag)
    discard(spark, [p for p in _written[:-1] if p not in before])
    return out, _written[-1]


def row_key(text: str = "text") -> F.Column:
    """A digest that tells rows of equal ``doc_id`` but other text apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def set_aside(df: DataFrame, *made: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` whose columns that clash with the ``made`` ones got the prefix
    ``input_``, as often as it takes for the name to be new; and the new names of
    those that were renamed, by the old."""
    taken, renamed = {c.lower() for c in df.columns} | {m.lower() for m in made}, {}
    for c in df.columns:
        if c.lower() in {m.lower() for m in made}:
            new = f"input_{c}"
            while new.lower() in taken:
                new = f"input_{new}"
            taken.add(new.lower())
            renamed[c] = new
    return df.withColumnsRenamed(renamed) if renamed else df, renamed


def small_enough(df: DataFrame, bytes_a_row: int, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` (a written table, so counting reads footers only) may be
    broadcast."""
    return df.count() * bytes_a_row <= limit


def attach(docs: DataFrame, side: DataFrame, on: list[str], how: str, bytes_a_row: int) -> DataFrame:
    """Join ``side`` (a written, narrow table) to wide rows.

    Below the limit the side is broadcast and the text stays where it is; beyond
    it both sides are hashed by key and the narrow one is built into hash
    tables, so that the wide rows are shuffled once and never sorted.
    """
    side = F.broadcast(side) if small_enough(side, bytes_a_row) else side.hint("shuffle_hash")
    return docs.join(side, on, how)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) for the nodes of the edges that aren't their own root; the
    root is the least node.  Union-find by iterated minimum with pointer jumps."""
    if not len(a):
        return a[:0], b[:0]
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[: len(a)], inv[len(a) :]
    parent = np.arange(len(nodes))
    while True:
        px, py = parent[x], parent[y]
        live = px != py
        if not live.any():
            break
        x, y, px, py = x[live], y[live], px[live], py[live]
        np.minimum.at(parent, np.maximum(px, py), np.minimum(px, py))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    own = parent != np.arange(len(nodes))
    return nodes[own], nodes[parent[own]]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    us, vs = [], []
    for b in batches:
        us.append(b.column(0).to_numpy(zero_copy_only=False))
        vs.append(b.column(1).to_numpy(zero_copy_only=False))
        if sum(map(len, us)) > 2_000_000:
            u, v = forest(np.concatenate(us), np.concatenate(vs))
            us, vs = [u], [v]
    if us:
        u, v = forest(np.concatenate(us), np.concatenate(vs))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node that isn't the least of its component.

    ``edges`` has two bigint columns without nulls.  Each partition first
    shrinks its edges to a spanning forest; then large-star and small-star steps
    alternate (Kiveris et al., "Connected Components in MapReduce and Beyond"),
    each a shuffle by node, until the edges no longer change.  Every round is
    written to the shared folder, so its lineage is one read.
    """
    u, v = edges.columns
    now = written(spark, edges.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v")).transform(batched).mapInArrow(_contract, "u long, v long"), "edges")
    by_u = Window.partitionBy("u")
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.withColumn("m", F.least("u", F.min("v").over(by_u))).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = large.where("v < u").withColumn("m", F.min("v").over(by_u))
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u > v").distinct()
        before, now = _written[-1], written(spark, small, "edges")
        discard(spark, [before])
        state = now.agg(F.count("*").alias("n"), F.count_distinct("u").alias("d")).first()
        if state["n"] == state["d"] and now.join(now.select(F.col("u").alias("v")), "v", "left_semi").isEmpty():
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))  # stars only: each node has one parent, which is no child
