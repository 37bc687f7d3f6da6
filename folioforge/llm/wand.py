"""Exact BM25 top-k search with block-max WAND over sharded inverted indexes.

``build`` makes one index for each shard of documents: posting lists by term, cut
into blocks by document range, with the greatest frequency and the least document
length of each block.  ``search`` first sums the statistics of all shards (number
of documents, mean length, document frequencies), then walks every query through
every shard with a cursor on each of its posting lists:

1. The cursors are ordered by where they stand; the bounds of whole lists are added
   up in this order, and where they reach the k-th best score so far is the pivot.
2. The cursors before the pivot move to it, block by block, without a look at their
   postings; the bounds of the blocks there are added up.
3. If these can reach the k-th best score, the postings of the pivot are scored;
   if not, they are passed over.  All cursors at it move on.

Blocks are cut at the same document numbers in all lists, so a pivot is a range of
``BLOCK`` documents, and the blocks of a pivot all end together.  All queries walk
side by side, in arrays.  The k best of a query go with its task from shard to
shard, so later shards begin with a high threshold.  The tasks' results are merged
by score; as all use the global statistics, the outcome is that of scoring
everything.

Terms are compared by digests of 64 bits: among a billion different words, the
chance that any two share one is 3 %.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textscan
from .common import batched, written

K = 10
K1 = 1.2
B = 0.75
#: Documents in a block.
BLOCK = 32
#: Postings after which a shard is closed.
SHARD_POSTINGS = 400_000
#: Terms of the queries that are sent to the tasks at once; more are asked in turn.
ASKED_TERMS = 2_000_000
#: Cursors that walk side by side.
LANES = 32_768
#: Scores are rounded to this many places, and ranked so.
PLACES = 6

_ARRAYS = {"ids": "<i8", "lengths": "<i4", "terms": "<u8", "begins": "<i4", "docs": "<i4", "tfs": "<i4", "block_begins": "<i4", "blocks": "<i4", "block_posts": "<i4", "block_tf": "<i4", "block_length": "<i4"}
#: A shard is a row group by itself: Parquet's readers take the rows of a group
#: together, which here would be all shards of a file.
_ALONE = {"parquet.block.row.count.limit": "1", "parquet.page.row.count.limit": "1"}
_SHARD = "n_docs long, n_words long, " + ", ".join(f"{k} binary" for k in _ARRAYS)


def index(ids: np.ndarray, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a shard's index from its postings."""
    order = np.lexsort((doc, term))
    doc, term, tf = doc[order], term[order], tf[order]
    new = np.ones(len(doc), bool)
    new[1:] = term[1:] != term[:-1]
    begins = np.flatnonzero(new)
    terms, begins = term[begins], np.r_[begins, len(term)]
    block = doc // BLOCK
    new[1:] |= block[1:] != block[:-1]
    posts = np.flatnonzero(new)
    some = len(posts) > 0
    return {
        "ids": ids, "lengths": lengths, "terms": terms, "begins": begins, "docs": doc, "tfs": tf,
        "block_begins": np.searchsorted(posts, begins), "blocks": block[posts], "block_posts": np.r_[posts, len(doc)],
        "block_tf": np.maximum.reduceat(tf, posts) if some else tf, "block_length": np.minimum.reduceat(lengths[doc], posts) if some else tf,
    }


def _blob(a: np.ndarray, kind: str) -> pa.Array:
    """One binary value that holds the array."""
    a = np.ascontiguousarray(a, kind)
    return pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, a.nbytes], np.int32)), pa.py_buffer(a)])


def _array(column: pa.Array, row: int, kind: str) -> np.ndarray:
    """A row's array, in place."""
    return np.frombuffer(column[row].as_buffer(), kind)


def _arrays(b: pa.RecordBatch, row: int) -> dict[str, np.ndarray]:
    """A shard's arrays; frequencies take a byte each where all fit."""
    out = {name: _array(b.column(name), row, "<u1" if name == "tfs" else t) for name, t in _ARRAYS.items()}
    if len(out["tfs"]) != len(out["docs"]):
        out["tfs"] = out["tfs"].view(_ARRAYS["tfs"])
    return out


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    n_docs = n_posts = 0

    def close() -> pa.RecordBatch:
        parts = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        made = index(*parts)
        cols = [pa.array([len(made["ids"])], pa.int64()), pa.array([int(made["lengths"].sum())], pa.int64())]
        made["tfs"] = made["tfs"].astype(np.uint8) if made["tfs"].max(initial=0) < 256 else made["tfs"]
        cols += [_blob(made[k], "<u1" if made[k].dtype == np.uint8 else t) for k, t in _ARRAYS.items()]
        return pa.RecordBatch.from_arrays(cols, ["n_docs", "n_words", *_ARRAYS])

    for b in batches:
        ids = b.column(0).to_numpy(zero_copy_only=False)
        for at, part in textscan.slices(b.column(1)):
            row, h, _ = textscan.words(part)
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (h[1:] != h[:-1])
            first = np.flatnonzero(new)
            tf = np.diff(np.r_[first, len(row)])
            held.append((ids[at : at + len(part)], np.bincount(row, minlength=len(part)), (row[first] + n_docs).astype(np.int32), h[first], tf.astype(np.int32)))
            n_docs += len(part)
            n_posts += len(first)
            if n_posts > SHARD_POSTINGS:
                yield close()
                n_docs = n_posts = 0
    if held:
        yield close()


def build(docs: DataFrame, text: str = "text") -> DataFrame:
    """The shards' indexes, one row each, over all words of all documents.  A NULL
    text has no words; rows with a NULL ``doc_id`` can't be found and aren't
    indexed; a repeated row is a document of its own."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).transform(batched).mapInArrow(_build, _SHARD)


class Shard:
    """Search on one index."""

    def __init__(self, arrays: dict[str, np.ndarray], mean: float):
        self.__dict__.update(arrays)
        self.norm = K1 * (1 - B + B * self.lengths / mean)
        self.n_ranges = -(-len(self.ids) // BLOCK) + 1
        tf = self.block_tf
        self.impact = tf * (K1 + 1) / (tf + K1 * (1 - B + B * self.block_length / mean))
        many = np.diff(self.block_begins)
        self.key = np.repeat(np.arange(len(many), dtype=np.int64), many) * self.n_ranges + self.blocks
        self.bound = np.maximum.reduceat(self.impact, self.block_begins[:-1]) if len(many) else np.zeros(0)
        self.scored = 0

    def walk(self, terms: np.ndarray, idf: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """The k best of each query, in place: ``ids`` and ``scores`` (queries, k),
        by score and then id, hold the best so far (-inf where there is none).
        ``terms`` and ``idf`` (queries, terms) are those of the queries; an idf of
        0 marks a place without a term."""
        if not len(self.terms):
            return
        k, past = ids.shape[1], self.n_ranges
        t = np.searchsorted(self.terms, terms)
        t[t == len(self.terms)] = 0
        here = (self.terms[t] == terms) & (idf > 0)
        most = int(here.sum(1).max(initial=0))
        if not most:
            return
        left = np.argsort(~here, 1, kind="stable")[:, :most]  # the terms that the shard has
        t, w, here = (np.take_along_axis(x, left, 1) for x in (t, idf, here))
        w = np.where(here, w, 0.0)
        list_bound = w * self.bound[t]
        at, end = self.block_begins[t].astype(np.int64), self.block_begins[t + 1].astype(np.int64)
        blocks = np.r_[self.blocks, past].astype(np.int64)
        now = np.where(here, blocks[at], past)
        live = np.flatnonzero(here.any(1))
        while len(live):
            least = scores[live, -1] - 1e-5  # equal scores are told apart by the id
            where = now[live]
            order = np.argsort(where, 1)
            reach = np.cumsum(np.take_along_axis(list_bound[live], order, 1), 1) >= least[:, None]
            pivot = np.take_along_axis(np.take_along_axis(where, order, 1), reach.argmax(1)[:, None], 1)[:, 0]
            on = reach[:, -1] & (pivot < past)
            live, pivot, least, where = live[on], pivot[on], least[on], where[on]
            row, col = np.nonzero(where < pivot[:, None])
            if len(row):
                own = (live[row], col)
                at[own] = np.minimum(np.searchsorted(self.key, t[own] * np.int64(self.n_ranges) + pivot[row]), end[own])
                now[own] = np.where(at[own] < end[own], blocks[at[own]], past)
            row, col = np.nonzero(now[live] == pivot[:, None])
            own = (live[row], col)
            bound = np.bincount(row, w[own] * self.impact[at[own]], len(live))
            can = bound >= least
            take = can[row]
            if take.any():
                self._score(row[take], at[own][take], w[own][take], pivot, live, ids, scores)
            at[own] += 1
            now[own] = np.where(at[own] < end[own], blocks[at[own]], past)

    def _score(self, row: np.ndarray, block: np.ndarray, w: np.ndarray, pivot: np.ndarray, live: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        begin, n = self.block_posts[block], self.block_posts[block + 1] - self.block_posts[block]
        p = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
        tf, d = self.tfs[p], self.docs[p]
        rows, lane = np.unique(row, return_inverse=True)
        self.scored += len(p)
        s = np.bincount(np.repeat(lane, n) * BLOCK + d % BLOCK, np.repeat(w, n) * tf * (K1 + 1) / (tf + self.norm[d]), len(rows) * BLOCK)
        s = np.round(s, PLACES).reshape(-1, BLOCK)
        s[s <= 0] = -np.inf
        better = np.flatnonzero(s.max(1) >= scores[live[rows], -1])
        if not len(better):
            return
        own, k = live[rows[better]], ids.shape[1]
        doc = np.minimum(pivot[rows[better]][:, None] * BLOCK + np.arange(BLOCK), len(self.ids) - 1)
        every_id, every = np.concatenate([ids[own], self.ids[doc]], 1), np.concatenate([scores[own], s[better]], 1)
        by_id = np.argsort(every_id, 1, kind="stable")
        every_id, every = np.take_along_axis(every_id, by_id, 1), np.take_along_axis(every, by_id, 1)
        best = np.argsort(-every, 1, kind="stable")[:, :k]
        ids[own], scores[own] = np.take_along_axis(every_id, best, 1), np.take_along_axis(every, best, 1)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each distinct word of each query."""
    for b in batches:
        for at, part in textscan.slices(b.column(1)):
            row, h = textscan.distinct(*textscan.words(part)[:2])
            yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(part)).take(pa.array(row)), pa.array(h.view(np.int64))], ["q", "term"])


def search(spark: SparkSession, shards: DataFrame, queries: DataFrame, k: int = K, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """(query_id, rank, doc_id, score): the k best documents of each query.

    ``shards`` is a written table of :func:`build`.  Rows with the same query id (an
    integer) are one query of all their words; each distinct word counts once.
    Documents that share no word with it aren't listed; ties go to the lower
    ``doc_id``.  Queries with a NULL id or without a word give no rows, as do no
    documents and an empty table of queries.  Columns besides the id and the text
    are not read.

    Queries of up to ``ASKED_TERMS`` terms in all are sent to the tasks at once;
    more are asked in turns of about that many, each on all shards.
    """
    asked = queries.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("q"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    asked = written(spark, asked.transform(batched).mapInArrow(_terms, "q long, term long").distinct(), "asked")
    turns = max(1, -(-asked.count() // ASKED_TERMS))
    found = spark.createDataFrame([], "query_id long, doc_id long, score double")
    for i in range(turns):
        found = found.union(_ask(spark, shards, asked.where(F.pmod(F.xxhash64("q"), F.lit(turns)) == i), k))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def _ask(spark: SparkSession, shards: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(query_id, doc_id, score): the k best of each task for each query."""
    t = asked.toArrow()  # ASKED_TERMS rows, about
    q, h = t["q"].to_numpy(), t["term"].to_numpy().view(np.uint64)
    order = np.lexsort((h, q))
    q, h = q[order], h[order]
    vocabulary = np.unique(h)
    sent = spark.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(sent.value), np.int64)
        docs = words = 0
        for b in batches:
            for i in range(len(b)):
                docs, words = docs + b.column(0)[i].as_py(), words + b.column(1)[i].as_py()
                terms, begins = _array(b.column(2), i, "<u8"), _array(b.column(3), i, "<i4")
                at = np.searchsorted(terms, sent.value)
                ok = at < len(terms)
                ok[ok] = terms[at[ok]] == sent.value[ok]
                df[ok] += begins[at[ok] + 1] - begins[at[ok]]
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-2, -1, some].astype(np.int32)), pa.array(np.r_[docs, words, df[some]].astype(np.int64))], ["at", "n"])

    totals = {r["at"]: r["n"] for r in shards.select("n_docs", "n_words", "terms", "begins").transform(batched).mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).collect()}
    n_docs, n_words = totals.pop(-2, 0), totals.pop(-1, 0)
    df = np.zeros(len(vocabulary))
    df[list(totals)] = list(totals.values())
    idf = np.log(1 + (n_docs - df + 0.5) / (df + 0.5))[np.searchsorted(vocabulary, h)]
    plan = spark.sparkContext.broadcast((q, h, idf, max(n_words / max(n_docs, 1), 1e-9)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, h, idf, mean = plan.value
        names, begin, n = np.unique(q, return_index=True, return_counts=True)
        ids, scores = np.zeros((len(names), k), np.int64), np.full((len(names), k), -np.inf)
        groups, by_size = [], np.argsort(n, kind="stable")
        while len(by_size):  # queries of like length, padded to the longest
            fit = int(np.searchsorted(np.arange(1, len(by_size) + 1) * n[by_size] > LANES, True))
            own, by_size = by_size[: max(1, fit)], by_size[max(1, fit) :]
            place = begin[own][:, None] + np.arange(n[own].max())
            some = np.arange(n[own].max()) < n[own][:, None]
            groups.append((own, np.where(some, h[np.where(some, place, 0)], np.uint64(0)), np.where(some, idf[np.where(some, place, 0)], 0.0)))
        for b in batches:
            for i in range(len(b)):
                shard = Shard(_arrays(b, i), mean)
                for own, terms, weight in groups:
                    own_ids, own_scores = ids[own], scores[own]
                    shard.walk(terms, weight, own_ids, own_scores)
                    ids[own], scores[own] = own_ids, own_scores
        row, col = np.nonzero(scores > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(names[row]), pa.array(ids[row, col]), pa.array(scores[row, col])], ["query_id", "doc_id", "score"])

    return shards.transform(batched).mapInArrow(run, "query_id long, doc_id long, score double")


def stored(spark: SparkSession, docs: DataFrame, text: str = "text") -> DataFrame:
    """:func:`build`, written to the shared folder."""
    return written(spark, build(docs, text), "index", _ALONE)


def top_k(spark: SparkSession, docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "item_id", text: str = "text") -> DataFrame:
    """Build the index in the shared folder and search it."""
    return search(spark, stored(spark, docs, text), queries, k, id_col, text)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9_\x{80}-\x{10FFFF}]+') AS w FROM documents),
stats AS (SELECT count(*) AS n, sum(len(w)) * 1.0 / count(*) AS mean FROM d),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9_\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
vocabulary AS (SELECT DISTINCT term FROM q),
post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) SEMI JOIN vocabulary USING (term) GROUP BY doc_id, term),
idf AS (SELECT term, ln(1 + ((SELECT n FROM stats) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM post GROUP BY term),
scored AS (SELECT item_id AS query_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / (SELECT mean FROM stats)))), 6) AS score
  FROM q JOIN post USING (term) JOIN idf USING (term) JOIN d USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INT) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
