"""Packing: graph, walk and windows against brute force, whole packs, odd tables."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from odd import documents
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import packing, textscan


def brute_walk(node, edges):
    """The same rule with dictionaries."""
    near = defaultdict(dict)
    for u, v, w in edges:
        near[u][v] = near[v][u] = w
    degree = {x: len(near[x]) for x in node}
    left, paths = set(node), []
    for start in sorted(node, key=lambda x: (degree[x], x)):
        if start not in left:
            continue
        path, at = [], start
        while at is not None:
            path.append(at)
            left.discard(at)
            at = min((x for x in near[at] if x in left), key=lambda x: (-near[at][x], degree[x], x), default=None)
        paths.append(path)
    return paths


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 30), st.lists(st.tuples(st.integers(0, 29), st.integers(0, 29), st.integers(3, 16)), max_size=80))
def test_walk_takes_greedy_paths_from_the_least_degree(n, some):
    node = [x * 7 - 50 for x in range(n)]
    edges = {}
    for a, b, w in some:
        if a < b < n:
            edges[node[a], node[b]] = w
    u, v, w = (np.array([e[k] for e in [(a, b, w) for (a, b), w in edges.items()]], np.int64) for k in range(3))
    path, place = packing.walk(np.array(node), u, v, w)
    want = brute_walk(node, [(a, b, w) for (a, b), w in edges.items()])
    assert {(x, int(p), int(q)) for x, p, q in zip(node, path, place)} == {(x, i, j) for i, p in enumerate(want) for j, x in enumerate(p)}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=40), st.integers(1, 33))
def test_fill_covers_every_word_once_and_leaves_no_room(sizes, window):
    out = packing.fill(0, np.arange(len(sizes)), np.array(sizes, np.int64), window)
    flat = [(r.doc_id, k) for r in out.itertuples() for k in range(r.begin_word, r.end_word)]
    assert flat == [(i, k) for i, n in enumerate(sizes) for k in range(n)]
    used = out.assign(n=out["end_word"] - out["begin_word"]).groupby("window")["n"].sum().tolist()
    assert all(n == window for n in used[:-1]) and all(n <= window for n in used)


def slow_sketch(text):
    row, h, _ = textscan.words(pa.array([text]))
    h = [int(x) for x in h]
    m = (1 << 64) - 1
    pair = [(a * 3 + b) & m for a, b in zip(h, h[1:])] or h
    pair = [((p ^ (p >> 29)) * 0xBF58476D1CE4E5B9) & m for p in pair]
    return [min((((p * int(o)) & m) >> 32 for p in pair), default=0xFFFFFFFF) for o in packing._ODD]


def test_sketches_are_minima_over_the_word_pairs():
    texts = ["", "one", "one two", "b a b a", "x " * 999, "Ein Haus am See, ein Haus."]
    s, n = packing.sketches(pa.array(texts))
    assert [x.tolist() for x in s] == [slow_sketch(t) for t in texts] and n.tolist() == [0, 1, 2, 4, 999, 6]


def related(seed=0, topics=60, size=(1, 9)):
    """Documents of a topic share most of their sentences."""
    r = random.Random(seed)
    docs, topic = [], []
    for t in range(topics):
        base = [f"t{t}x{k}" for k in range(260)]
        for _ in range(r.randrange(*size)):
            w = list(base)
            for k in range(0, len(w), r.choice([17, 29, 41])):
                w[k] = f"n{r.randrange(10**6)}"
            docs.append(" ".join(w))
            topic.append(t)
    order = list(range(len(docs)))
    r.shuffle(order)
    return [(i, docs[o]) for i, o in enumerate(order)], [topic[o] for o in order]


def test_neighbour_graph_recall_against_all_pairs(spark):
    docs, _ = related()
    s, _ = packing.sketches(pa.array([t for _, t in docs]))
    same = (s[:, None, :] == s[None, :, :]).sum(-1)
    np.fill_diagonal(same, 0)
    nodes = spark.createDataFrame([(i, bytearray(x.astype(">u4").tobytes())) for i, x in enumerate(s)], "node long, sketch binary")
    got = {(r["u"], r["v"]): r["same"] for r in packing.neighbour_graph(spark, nodes).collect()}
    assert all(same[u, v] == n >= packing.LEAST for (u, v), n in got.items())
    hit = want = 0
    for i in range(len(docs)):
        row = sorted(((-int(same[i, j]), j) for j in range(len(docs)) if same[i, j] >= packing.LEAST))[: packing.NEIGHBOURS]
        want += len(row)
        hit += sum((i, j) in got for _, j in row)
    assert want > 400 and hit >= 0.9 * want


def check_pack(out, words):
    """Every word of every document once and in order; windows without gaps."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append((r["begin_word"], r["end_word"]))
        by_window[r["window_id"]].append((r["at"], r["end_word"] - r["begin_word"]))
    for i, n in words.items():
        at = 0
        for a, b in sorted(by_doc[i]):
            assert a == at and b > a
            at = b
        assert at == n
    for w in by_window.values():
        at = 0
        for a, n in sorted(w):
            assert a == at
            at += n
        assert at <= packing.WINDOW
    return by_doc, by_window


def test_related_documents_share_windows(spark):
    docs, topic = related(1)
    out = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    check_pack(out, {i: len(t.split()) for i, t in docs})
    path = {(r["path"], r["window_id"].rsplit("-", 1)[0]): set() for r in out}
    for r in out:
        path[r["path"], r["window_id"].rsplit("-", 1)[0]].add(topic[r["doc_id"]])
    assert all(len(t) == 1 for t in path.values())  # a path never leaves its topic
    assert len(path) <= len(set(topic)) * 1.3  # and topics are rarely broken up


def test_many_regions_hold_the_same_words(spark):
    docs, _ = related(2)
    out = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string"), region=5).collect()
    check_pack(out, {i: len(t.split()) for i, t in docs})
    assert len({r["window_id"].rsplit("-", 1)[0] for r in out}) > 10


def test_thousands_of_copies(spark):
    docs = [(i, "the same text of nine words stands here again") for i in range(4000)]
    check_pack(packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect(), {i: 9 for i, _ in docs})


def test_odd_tables(spark):
    df = documents(spark)
    words = defaultdict(int)
    for i, t in df.select("doc_id", "text").distinct().collect():
        if i is not None and t:
            words[i] += len(textscan.words(pa.array([t]))[0])
    out = packing.pack(spark, df).collect()
    got = defaultdict(int)
    for r in out:
        got[r["doc_id"]] += r["end_word"] - r["begin_word"]
    assert dict(got) == {i: n for i, n in words.items() if n}
    assert packing.pack(spark, df.limit(0)).count() == 0


def check_exact(spark, s, **kw):
    """The graph is that of a comparison of all pairs."""
    nodes = spark.createDataFrame([(i, bytearray(x.astype(">u4").tobytes())) for i, x in enumerate(s)], "node long, sketch binary")
    got = {(r["u"], r["v"], r["same"]) for r in packing.neighbour_graph(spark, nodes, **kw).collect()}
    want = set()
    for i in range(len(s)):
        same = (s == s[i]).sum(1)
        same[i] = 0
        near = np.lexsort((np.arange(len(s)), -same))[: packing.NEIGHBOURS]
        want |= {(i, int(j), int(same[j])) for j in near if same[j] >= packing.LEAST}
    assert got == want and len(want) > 1000


def in_groups(size, keep, n=2, seed=5):
    """Sketches that keep each value of their group's with the given chance."""
    r = np.random.default_rng(seed)
    s = r.integers(0, 1 << 32, (n * size, packing.SKETCH), np.uint32)
    base = r.integers(0, 1 << 32, (n, packing.SKETCH), np.uint32)
    return np.unique(np.where(r.random(s.shape) < keep, np.repeat(base, size, 0), s), axis=0)


def test_neighbours_in_groups_of_thousands_are_the_nearest(spark):
    check_exact(spark, in_groups(3000, 0.63))


def test_groups_too_large_for_a_task_are_split_without_loss(spark):
    check_exact(spark, in_groups(500, 0.5), held=40)
    s = in_groups(400, 0.2)
    s[:, :7] = s[0, :7]  # seven values that all have
    check_exact(spark, s, held=60)


def test_neighbours_on_a_whole_table_are_the_nearest(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").toArrow().column(0).combine_chunks()
    s, n = packing.sketches(t)
    check_exact(spark, np.unique(s[n > 0], axis=0))


def test_a_large_component_keeps_its_neighbours_on_one_path(spark):
    """One component of 300 documents, each much like those before and after it."""
    docs = [(i, " ".join(f"w{k}" for k in range(i * 40, i * 40 + 400))) for i in range(300)]
    share = {}
    for region in (40, packing.REGION):
        out = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string"), region=region).collect()
        check_pack(out, {i: 400 for i, _ in docs})
        path = {r["doc_id"]: (r["window_id"].rsplit("-", 1)[0], r["path"]) for r in out}
        share[region] = sum(path[i] == path[i + 1] for i in range(299)) / 299
    assert share[40] >= share[packing.REGION] - 0.02 and share[packing.REGION] > 0.5, share


def test_documents_follow_each_other_alike_in_small_and_large_components(spark):
    """Which are next to each other doesn't depend on whether a region holds the
    component."""
    r = random.Random(9)
    docs = [(i, " ".join(f"w{k}" for k in range(i * 40, i * 40 + 400 + r.randrange(90)))) for i in range(300)]
    after = {}
    for region in (40, packing.REGION):
        out = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string"), region=region).collect()
        path = defaultdict(set)
        for x in out:
            path[x["window_id"].rsplit("-", 1)[0], x["path"]].add((x["place"], x["doc_id"]))
        after[region] = {frozenset((a, b)) for p in path.values() for (_, a), (_, b) in zip(sorted(p), sorted(p)[1:])}
    assert after[40] == after[packing.REGION] and len(after[40]) > 150


def test_paths_are_those_of_edges_taken_one_by_one(spark):
    r = random.Random(3)
    edges = {(min(a, b), max(a, b)): r.randrange(3, 17) for a, b in ((r.randrange(150), r.randrange(150)) for _ in range(500)) if a != b}
    graph = spark.createDataFrame([(a, b, w) for (a, b), w in edges.items()], "u long, v long, same int")
    few, all_at_once = (sorted(map(tuple, packing.greedy_paths(spark, graph, held).collect())) for held in (3, 10_000))
    assert few == all_at_once and len(few) > 100
    degree = defaultdict(int)
    for a, b, w in few:
        assert edges[a, b] == w
        degree[a], degree[b] = degree[a] + 1, degree[b] + 1
    assert max(degree.values()) == 2


def test_regions_are_bounded_on_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    out = packing.pack(spark, docs, region=500).selectExpr("split(window_id, '-')[0] region", "doc_id").distinct().groupBy("region").count().collect()
    sizes = [r["count"] for r in out]
    assert max(sizes) <= 2 * 500 and len(sizes) <= 2.5 * sum(sizes) / 500


def test_many_copies_are_no_region_of_one_task(spark):
    docs = [(i, f"the same text of nine words stands here again{' too' * (i % 3 == 0)}") for i in range(3000)]
    out = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string"), region=100).collect()
    check_pack(out, {i: 9 + (i % 3 == 0) for i, _ in docs})
    size = defaultdict(set)
    for r in out:
        size[r["window_id"].split("-")[0]].add(r["doc_id"])
    assert max(map(len, size.values())) <= 250


def test_paths_are_no_longer_than_allowed(spark):
    graph = spark.createDataFrame([(i, i + 1, 5) for i in range(200)], "u long, v long, same int")
    weights = spark.createDataFrame([(i, 1 + i % 3) for i in range(201)], "node long, docs long")
    few, all_at_once = (sorted(map(tuple, packing.greedy_paths(spark, graph, held, weights, 20).collect())) for held in (3, 10_000))
    assert few == all_at_once
    ends, size = {u for u, _, _ in few}, 1
    for i in range(200):
        size = size + 1 + (i + 1) % 3 if i in ends else 1 + (i + 1) % 3
        assert size <= 20
    assert len(few) > 150
