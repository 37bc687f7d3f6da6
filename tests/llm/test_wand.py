"""BM25 top-k: brute force over all documents, pruning, shards, odd tables."""

import math
import random
from collections import Counter
from glob import glob

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from odd import documents

from folioforge.llm import common, textscan, wand


def terms(text):
    return [int(x) for x in textscan.words(pa.array([text or ""]))[1]]


def brute(docs, queries, k):
    """{(query, rank): (doc, score)} by scoring every document."""
    bags = [(i, Counter(terms(t))) for i, t in docs if i is not None]
    n, mean = len(bags), sum(sum(b.values()) for _, b in bags) / max(1, len(bags))
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for q, text in queries:
        if q is None:
            continue
        own, scored = sorted(set(terms(text))), []
        for i, b in bags:
            hit = [t for t in own if t in b]
            if hit:
                size = sum(b.values())
                s = math.fsum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * b[t] * 2.2 / (b[t] + 1.2 * (0.25 + 0.75 * size / mean)) for t in hit)
                scored.append((-round(s, 6), i))
        for rank, (s, i) in enumerate(sorted(scored)[:k], 1):
            out[q, rank] = (i, -s)
    return out


def corpus(n=1500, seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(2000)]
    weights = [1 / (i + 3) for i in range(2000)]
    docs = [(i * 3 % 4001, " ".join(r.choices(words, weights, k=r.randrange(0, 120)))) for i in range(n)]
    queries = [(i, " ".join(r.choices(words, weights, k=r.randrange(1, 25)))) for i in range(60)] + [(60, ""), (61, None), (None, "w1"), (62, "unheard of"), (63, "w1999")]
    return docs, queries


@pytest.mark.parametrize("parts,k", [(1, 10), (6, 10), (6, 1), (3, 200)])
def test_agrees_with_scoring_everything(spark, monkeypatch, parts, k):
    docs, queries = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in wand.top_k(spark, df, spark.createDataFrame(queries, "item_id long, text string"), k).collect()}
    want = brute(docs, queries, k)
    assert got.keys() == want.keys()
    assert all(abs(got[x][1] - want[x][1]) < 2e-6 for x in want)
    assert sum(got[x][0] == want[x][0] for x in want) >= 0.999 * len(want)  # the last place of a score may round the other way


def test_shards_are_read_one_by_one(spark, monkeypatch):
    """A reader takes the rows of a row group together, so each has one shard."""
    many = wand._build
    monkeypatch.setattr(wand, "_build", lambda batches: (b for one in batches for i in range(0, len(one), 50) for b in many(iter([one.slice(i, 50)]))))
    before = set(common._written)
    shards = wand.stored(spark, spark.createDataFrame(corpus()[0], "doc_id long, text string").coalesce(1))
    path = next(p for p in common._written if p not in before)
    groups = [f.metadata.row_group(i).num_rows for f in map(pq.ParquetFile, glob(f"{path.removeprefix('file://')}/*.parquet")) for i in range(f.metadata.num_row_groups)]
    assert shards.count() == len(groups) >= 30 and set(groups) == {1}


def test_blocks_are_skipped():
    r = np.random.default_rng(1)
    docs = [(i, " ".join(f"c{x}" for x in r.integers(0, 40, 30)) + (" rare rare rare" if i % 997 == 5 else "")) for i in range(6000)]
    rows = [textscan.words(pa.array([t])) for _, t in docs]
    doc = np.concatenate([np.full(len(h), i) for i, (_, h, _) in enumerate(rows)])
    term = np.concatenate([h for _, h, _ in rows])
    pair, tf = np.unique(np.stack([doc.astype(np.uint64), term], 1), axis=0, return_counts=True)
    shard = wand.Shard(wand.index(np.arange(6000), np.array([len(h) for _, h, _ in rows]), pair[:, 0].astype(np.int64), pair[:, 1], tf), 30.0)
    q = np.array(sorted(set(terms("rare c1"))), np.uint64)
    ids, scores = np.zeros((1, 5), np.int64), np.full((1, 5), -np.inf)
    shard.walk(q[None], np.array([[8.0 if t == terms("rare")[0] else 0.1 for t in q]]), ids, scores)
    assert set(ids[0]) <= {i for i in range(6000) if i % 997 == 5} and shard.scored < 800
    again = shard.scored
    shard.walk(q[None], np.array([[8.0 if t == terms("rare")[0] else 0.1 for t in q]]), np.zeros((1, 5), np.int64), np.full((1, 5), 1e9))
    assert shard.scored == again  # a threshold from other shards that nothing here can reach


def test_many_small_shards_turns_and_lanes(spark, monkeypatch):
    docs, queries = corpus(700, 9)
    want = brute(docs, queries, 10)
    monkeypatch.setattr(wand, "SHARD_POSTINGS", 500)
    monkeypatch.setattr(wand, "ASKED_TERMS", 100)
    monkeypatch.setattr(wand, "LANES", 64)
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in wand.top_k(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(queries, "item_id long, text string")).collect()}
    assert got.keys() == want.keys() and all(abs(got[x][1] - want[x][1]) < 2e-6 for x in want)


def test_frequencies_above_a_byte(spark):
    docs = [(1, "a " * 300 + "b"), (2, "a b"), (3, "b " * 70_000)]
    got = {(r["query_id"], r["rank"]): (r["doc_id"], r["score"]) for r in wand.top_k(spark, spark.createDataFrame(docs, "doc_id long, text string").coalesce(1), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect()}
    want = brute(docs, [(1, "a b")], 10)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and all(abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_rows_of_one_query_id_are_one_query(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "c")], "doc_id long, text string")
    q = [(1, "a"), (1, "c"), (1, "a")]
    got = {(r["query_id"], r["doc_id"]) for r in wand.top_k(spark, docs, spark.createDataFrame(q, "item_id long, text string")).collect()}
    assert got == {(1, 1), (1, 2), (1, 3)}


def test_ties_go_to_the_lower_id_over_shards(spark):
    df = spark.createDataFrame([(i, "same words here") for i in range(300, 0, -1)], "doc_id long, text string").repartition(5)
    out = wand.top_k(spark, df, spark.createDataFrame([(1, "words same")], "item_id long, text string")).orderBy("rank").collect()
    assert [r["doc_id"] for r in out] == list(range(1, 11)) and len({r["score"] for r in out}) == 1


def test_odd_tables(spark):
    df = documents(spark)
    q = spark.createDataFrame([(1, "another piece3", "x"), (2, "日本語 é", "y"), (3, "", None), (None, None, None)], "item_id long, text string, score string")
    out = [(r["query_id"], r["rank"], r["doc_id"]) for r in wand.top_k(spark, df, q).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], [(1, "another piece3"), (2, "日本語 é")], 10)
    assert sorted(out) == sorted((a, b, i) for (a, b), (i, _) in want.items())
    assert wand.top_k(spark, df.limit(0), q).count() == 0 and wand.top_k(spark, df, q.limit(0)).count() == 0
