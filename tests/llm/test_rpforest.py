"""Embedding near-duplicates: recall against brute force, groups, odd tables."""

import numpy as np

from folioforge.llm import rpforest


def table(spark, x, ids=None):
    return spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(range(len(x)) if ids is None else ids, x)], "vec_id long, embedding array<float>")


def brute(x, cosine):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    i, j = np.nonzero(np.triu(u @ u.T >= cosine, 1))
    return set(zip(i.tolist(), j.tolist()))


def planted(n=3000, copies=1500, dim=48, noise=0.045):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((n, dim))
    near = base[rng.integers(0, n, copies)] + rng.standard_normal((copies, dim)) * noise * rng.uniform(0.5, 6, (copies, 1))
    return np.concatenate([base, near]).astype(np.float32)


def pairs(df):
    return {(r[0], r[1]) for r in df.collect()}


def test_recall_and_no_false_pairs(spark):
    x = planted()
    want = brute(x, rpforest.COSINE)
    got = pairs(rpforest.near_pairs(spark, table(spark, x)))
    assert len(want) > 800 and got <= want | brute(x, rpforest.COSINE - 1e-4) and len(got & want) >= 0.9 * len(want)


def test_upper_levels_of_the_trees_are_distributed_with_the_same_recall(spark):
    x = planted(2000, 1000)
    want = brute(x, rpforest.COSINE)
    got = pairs(rpforest.near_pairs(spark, table(spark, x), subtree=400))  # three levels before the subtrees
    assert len(got & want) >= 0.9 * len(want)


def test_levels_in_rounds_fitted_on_samples(spark):
    x = planted(2000, 1000)
    want = brute(x, rpforest.COSINE)
    got = pairs(rpforest.near_pairs(spark, table(spark, x), subtree=200, levels_a_round=1, sample=150))  # four levels, a round each
    assert got <= want | brute(x, rpforest.COSINE - 1e-4) and len(got & want) >= 0.9 * len(want)


def test_codes_bound_the_error_of_a_cosine():
    rng = np.random.default_rng(4)
    for dim in (1, 3, 64, 1000):
        x = rng.standard_normal((50, dim)) * rng.uniform(0.1, 30, dim)
        x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
        y, e = rpforest.decode(rpforest.encode(x))
        bound = e[:, None] * (1 + e[None, :]) + e[None, :]
        assert (np.abs(x.astype(np.float64) @ x.T - y.astype(np.float64) @ y.T) <= bound + 1e-6).all() and (e < 0.2).all()


def test_pairs_at_the_limit_are_decided_by_the_vectors(spark):
    rng, rows = np.random.default_rng(9), []
    for i in range(200):
        a, b = np.linalg.qr(rng.standard_normal((32, 2)))[0].T
        c = rpforest.COSINE + (1e-4 if i % 2 else -1e-4)
        rows += [a, c * a + np.sqrt(1 - c * c) * b]
    got = pairs(rpforest.near_pairs(spark, table(spark, np.array(rows))))
    assert got == {(2 * i, 2 * i + 1) for i in range(1, 200, 2)}


def test_recall_on_the_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    local = df.select("vec_id", "embedding").toPandas()
    ids, x = local["vec_id"].to_numpy(), np.stack(local["embedding"])
    want = {tuple(sorted((int(ids[i]), int(ids[j])))) for i, j in brute(x, rpforest.COSINE)}
    got = pairs(rpforest.near_pairs(spark, df))
    assert len(got & want) >= 0.9 * len(want)


def test_groups_are_components_of_the_pairs(spark):
    x = planted(600, 400)
    parent = list(range(len(x)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in sorted(pairs(rpforest.near_pairs(spark, table(spark, x)))):
        a, b = root(i), root(j)
        parent[max(a, b)] = min(a, b)
    out = {r["vec_id"]: r for r in rpforest.near_groups(spark, table(spark, x)).collect()}
    assert {i: r["group_id"] for i, r in out.items()} == {i: root(i) for i in range(len(x))}
    assert all(r["keep"] == (i == r["group_id"]) for i, r in out.items())


def test_thousands_of_equal_vectors_are_one_point(spark):
    x = np.ones((5000, 8), np.float32)
    out = rpforest.near_groups(spark, table(spark, x)).selectExpr("count(*)", "count(distinct group_id)", "sum(int(keep))").first()
    assert tuple(out) == (5000, 1, 1)


def test_odd_tables(spark):
    nan, v = float("nan"), [1.0, 0.0, 2.0]
    data = [(1, v, 1, "a"), (1, v, 1, "a"), (2, v, None, "b"), (3, None, 1, "c"), (4, [], 1, "d"), (5, [0.0, 0.0, 0.0], 1, "e"), (6, [1.0, None, 2.0], 1, "f"), (7, [nan, 1.0, 1.0], 1, "g"), (None, v, 1, "h"), (8, [2.0, 0.0, 4.0], 1, None), (9, [1.0, 0.0], 1, "j"), (10, [float("inf"), 0.0, 1.0], 1, "k"), (11, [-1.0, 0.0, -2.0], 1, "l")]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, node int, root string")
    out = {r["vec_id"]: (r["group_id"], r["keep"]) for r in rpforest.near_groups(spark, df).collect()}
    assert out == {1: (1, True), 2: (1, False), 8: (1, False)} | {i: (i, True) for i in (3, 4, 5, 6, 7, 9, 10, 11)}
    assert rpforest.near_groups(spark, df.limit(0)).count() == 0


def test_a_third_in_one_ball_is_no_group_of_one_task(spark):
    x = np.concatenate([planted(1000, 0), np.ones((500, 48)) + np.random.default_rng(1).standard_normal((500, 48)) * 1e-4])
    out = rpforest.near_groups(spark, table(spark, x), subtree=200).collect()
    assert {r["group_id"] for r in out if r["vec_id"] >= 1000} == {1000}


def test_an_id_with_several_vectors(spark):
    a, b = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (3, [0.05, 1.0, 0.0]), (4, [0.0, 0.0, 1.0])], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: r["group_id"] for r in rpforest.near_groups(spark, df).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}
