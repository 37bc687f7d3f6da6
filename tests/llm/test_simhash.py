"""SimHash near-duplicates: brute force over all pairs, recall, odd tables."""

import random
import time

import numpy as np
import pyarrow as pa
from odd import documents, rows

from folioforge.llm import simhash
from folioforge.llm.common import components, written

RNG = np.random.default_rng(5)


def planted_codes(n=1500, copies=600, most=20):
    """Random codes, and copies of some with up to ``most`` bits turned."""
    base = RNG.integers(0, 1 << 63, (n, 2), dtype=np.uint64)
    near = base[RNG.integers(0, n, copies)].copy()
    for c in near:
        for bit in RNG.choice(128, RNG.integers(1, most + 1), replace=False):
            c[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    return np.unique(np.concatenate([base, near]), axis=0)


def brute(codes, radius):
    d = np.bitwise_count(codes[:, None, :] ^ codes[None, :, :]).sum(-1)
    return {(int(i), int(j)) for i, j in zip(*np.nonzero(d <= radius)) if i < j}


def found(codes, radius):
    out = set()
    for q, s in simhash.forest_pairs(simhash.shard_forest(codes), codes, radius):
        out |= {(min(a, b), max(a, b)) for a, b in zip(q.tolist(), s.tolist()) if a != b}
    return out


def test_bk_tree_finds_all_within_the_radius():
    codes = planted_codes(400, 200)
    one = simhash.BKForest(codes, np.zeros(len(codes), np.int64))
    got = set()
    for q, s in one.search(codes, np.zeros(len(codes), np.int64), 20):
        got |= {(min(a, b), max(a, b)) for a, b in zip(q.tolist(), s.tolist()) if a != b}
    assert got == brute(codes, 20)


def test_edges_are_distances_to_the_parent():
    codes = planted_codes(100, 50)
    f = simhash.BKForest(codes, np.zeros(len(codes), np.int64))
    for p in range(len(codes)):
        kids = f.kids[f.begin[p] : f.begin[p + 1]]
        assert (simhash.hamming(f.codes[kids], f.codes[p]) == f.edge[kids]).all() and len(set(f.edge[kids].tolist())) == len(kids)


def test_sharded_search_finds_exactly_the_pairs_within_the_radius():
    codes = planted_codes()
    for radius in (0, 15, 17, simhash.RADIUS, 23):
        assert found(codes, radius) == brute(codes, radius)


def test_differences_spread_over_all_blocks():
    """The hardest cases: two differences or more in every block."""
    base = RNG.integers(0, 1 << 63, (300, 2), dtype=np.uint64)
    far = base.copy()
    for c in far:
        for block in range(8):
            for bit in RNG.choice(16, 2 + (block in RNG.choice(8, 4, replace=False)), replace=False)[: 2 if block else 3]:
                c[block // 4] ^= np.uint64(1) << np.uint64(16 * (block % 4) + bit)
    codes = np.concatenate([base, far])
    d = simhash.hamming(base, far)
    assert d.min() > 15
    assert found(codes, 20) == brute(codes, 20)


def test_trees_of_large_shards_find_the_same():
    """Many codes of one value in some blocks, so that shards are trees; parts of them
    are compared at once."""
    codes = planted_codes(900, 900)
    codes[:, 0] &= np.uint64(0xFFFF0000FFFF0003)
    codes = np.unique(codes, axis=0)
    want = brute(codes, 20)
    for leaf in (0, 5, 60, 10**6):
        got = set()
        for q, s in simhash.forest_pairs(simhash.shard_forest(codes, leaf), codes, 20):
            got |= {(min(a, b), max(a, b)) for a, b in zip(q.tolist(), s.tolist()) if a != b}
        assert got == want


def test_pairs_of_many_codes_take_seconds():
    """A place of 60,000 codes: its 60 million pairs took 15 s and more down the trees."""
    codes = RNG.integers(0, 1 << 63, (59_000, 2), dtype=np.uint64)
    codes = np.concatenate([codes, codes[:1000] ^ np.uint64(0x0001000300050100)])
    codes[:, 0] &= np.uint64(0xFFFFFFFFFFFFFFE0)
    place = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(codes), np.int64)), pa.array(np.arange(len(codes)))] + [pa.array(codes[:, k].view(np.int64)) for k in (0, 1)], ["place", "node", "a", "b"])
    began = time.process_time()
    got = {tuple(sorted(p)) for b in simhash._routed(20)(iter([place])) for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert time.process_time() - began < 6
    assert got == {(i, 59_000 + i) for i in range(1000)}


def test_broadcast_and_routed_searches_agree(spark):
    codes = planted_codes(600, 300)
    table = [(i, *map(int, c.view(np.int64))) for i, c in enumerate(codes)]
    nodes = written(spark, spark.createDataFrame(table, "node long, a long, b long"), "nodes")
    by = [rows(components(spark, simhash.near_pairs(spark, nodes, broadcast_bytes=n, held=held))) for n, held in ((1 << 30, 1 << 20), (0, 1 << 20), (0, 10))]
    assert by[0] == by[1] == by[2] and len(by[0]) > 100


def slow_signature(text):
    """Bit by bit, from the same word hashes."""
    row, h, _ = simhash.textscan.words(pa.array([text]))
    h = np.unique(h)
    bits = np.unpackbits(np.stack([h, simhash.textscan.mix(h, 7)], 1).view(np.uint8).reshape(-1, 16), axis=1)
    return np.packbits(bits.sum(0) * 2 > len(h)).view(np.uint64) if len(h) else np.zeros(2, np.uint64)


def test_signatures_are_majority_votes():
    r = random.Random(3)
    texts = ["", "one", "one two", "A a b  B,c", " ".join(f"w{r.randrange(5000)}" for _ in range(4000))] + [" ".join(f"w{r.randrange(400)}" for _ in range(r.randrange(600))) for _ in range(30)]
    codes, n = simhash.signatures(pa.array(texts))
    assert all((codes[i] == slow_signature(t)).all() for i, t in enumerate(texts)) and n[:4].tolist() == [0, 1, 2, 3]


def test_copies_of_documents_are_one_group(spark):
    r = random.Random(11)
    vocabulary = [f"word{i}" for i in range(6000)]
    docs, group = [], []
    for g in range(80):
        words = [r.choice(vocabulary) for _ in range(r.randrange(80, 400))]
        for c in range(r.choice([1, 1, 2, 5])):
            w = list(words)
            for _ in range(len(w) // 100 * (c > 0)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            docs.append((len(docs), " ".join(w)))
            group.append(g)
    out = {x["doc_id"]: x for x in simhash.near_groups(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    first = {g: group.index(g) for g in group}
    right = sum(out[i]["group_id"] == first[g] for i, g in enumerate(group))
    assert all(group[out[i]["group_id"]] == g for i, g in enumerate(group))  # no group mixes originals
    assert right >= 0.97 * len(docs) and sum(x["keep"] for x in out.values()) == len({x["group_id"] for x in out.values()})


def test_odd_tables(spark):
    df = documents(spark)
    kept = simhash.drop_near_duplicates(spark, df)
    assert kept.columns == df.columns
    ids = [x["doc_id"] for x in kept.collect()]
    assert sorted(ids, key=str) == sorted([None, None, 1, 2, 3, 4, 4, 6, 8, -9], key=str)  # 5 and 7 are copies, 10 has the words of -9
    assert kept.where("doc_id = 4").select("text").distinct().count() == 2
    empty = simhash.drop_near_duplicates(spark, df.limit(0))
    assert empty.count() == 0 and empty.columns == df.columns
