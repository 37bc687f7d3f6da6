import tempfile

import pytest
from odd import documents

from folioforge.llm.compaction import ShardStore, VersionTaken, arrivals, sharded


@pytest.fixture
def path():
    return "file://" + tempfile.mkdtemp()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_arrivals_are_merged_and_versions_stay_readable(spark, path):
    s = ShardStore(spark, path, target_bytes=300_000, fanout=4, smallest_bytes=1_000)
    every = spark.range(0, 20000).selectExpr("id", "cast(id % 7 as string) s", "if(id % 5 = 0, null, id * 2) n")
    for i in range(6):
        s.append(every.where(f"id % 6 = {i}").repartition(2))
    before = s.manifest()
    assert before["version"] == 6 and len(before["shards"]) == 12
    last = s.compact()
    assert last["version"] > 6 and len(last["shards"]) < 12 and not s.plan(last["shards"])
    assert rows(s.read()) == rows(every) == rows(s.read(6))
    assert len(rows(s.read(1))) == 3334
    assert sum(x["rows"] for x in last["shards"]) == 20000
    assert s.vacuum() > 0 and s.versions() == [last["version"]] and rows(s.read()) == rows(every)


def test_tiers(spark, path):
    s = ShardStore(spark, path, target_bytes=1000, fanout=3, smallest_bytes=10)
    assert [s.tier(n) for n in (0, 9, 10, 29, 30, 89, 90)] == [0, 0, 1, 1, 2, 2, 3]
    shards = [{"path": str(i), "bytes": n, "rows": 1} for i, n in enumerate([5, 5, 5, 100, 100, 900, 40])]
    assert [[x["path"] for x in g] for g in s.plan(shards)] == [["0", "1", "2"]]


def test_a_second_writer_of_a_version_fails(spark, path):
    s = ShardStore(spark, path)
    df = spark.range(5)
    old = s.manifest()
    s.append(df)
    with pytest.raises(VersionTaken):
        s._commit(old, [], [], df.schema.json(), "append")
    assert s.versions() == [1] and s.read().count() == 5


def between(store, action, times=1):
    """Let ``action`` happen just before the next commits of ``store``."""
    commit = store._commit

    def late(*args):
        nonlocal times
        if times:
            times -= 1
            action()
        return commit(*args)

    store._commit = late


def test_an_append_that_comes_second_is_committed_on_top(spark, path):
    s, other = ShardStore(spark, path), ShardStore(spark, path)
    between(s, lambda: other.append(spark.range(5, 8)), 2)
    between_version = s.append(spark.range(5))["version"]
    assert between_version == 3 and s.versions() == [1, 2, 3]
    assert sorted(r[0] for r in s.read().collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 6, 7, 7]


def test_a_merge_after_another_append_keeps_both(spark, path):
    s, other = ShardStore(spark, path), ShardStore(spark, path)
    for i in range(4):
        s.append(spark.range(i, i + 1).coalesce(1))
    between(s, lambda: other.append(spark.range(9, 10).coalesce(1)))
    s.compact()
    assert sorted(r[0] for r in s.read().collect()) == [0, 1, 2, 3, 9] and len(s.manifest()["shards"]) == 2


def test_a_merge_that_another_has_made_is_dropped(spark, path):
    s, other = ShardStore(spark, path), ShardStore(spark, path)
    for i in range(4):
        s.append(spark.range(i, i + 1).coalesce(1))
    between(s, other.compact)
    s.compact()
    assert sorted(r[0] for r in s.read().collect()) == [0, 1, 2, 3] and len(s.manifest()["shards"]) == 1 and s.versions() == [1, 2, 3, 4, 5]


def test_manifests_are_deltas_and_every_version_can_be_read(spark, path):
    s = ShardStore(spark, path)
    for i in range(20):
        s.append(spark.range(i, i + 1).coalesce(1))
    full = [v for v in s.versions() if "shards" in s._read_json(f"{path}/manifests/v{v:010d}.json")]
    assert full == [1, 17] and [len(s.manifest(v)["shards"]) for v in (0, 1, 16, 17, 20)] == [0, 1, 16, 17, 20]
    s.compact()
    assert s.read(7).count() == 7
    s.vacuum(2)
    assert s.versions() == [20, 21] and s.read().count() == s.read(20).count() == 20
    s.append(spark.range(1))
    assert s.read().count() == 21 and s.read(20).count() == 20


def test_arrivals_of_a_table_with_small_targets(spark, path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = arrivals(spark, docs.repartition(5), path, target_bytes=40_000, smallest_bytes=4_000).collect()
    n = [r["rows"] for r in out if r["kind"] == "arrival"]
    assert n == sorted(n) and n[-1] == docs.count() and all(r["ok"] for r in out if r["kind"] == "arrival") and len(n) == 4
    assert ShardStore(spark, path).versions()[-1] > 4  # some were merges


def test_other_columns_are_refused_and_order_is_free(spark, path):
    s = ShardStore(spark, path)
    s.append(spark.createDataFrame([(1, "a")], "a long, b string"))
    s.append(spark.createDataFrame([("b", 2)], "b string, a long"))
    assert rows(s.read()) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        s.append(spark.createDataFrame([("b", 2)], "b string, a int"))


def test_odd_tables(spark, path):
    df = spark.createDataFrame([(None, None, None, None), (1, "", "m", 1), (1, "", "m", 1), (2, "x" * 100_000, None, 2)], "doc_id long, text string, _metadata string, `a.b` int")
    assert rows(sharded(spark, df, path)) == rows(df)
    empty = sharded(spark, df.limit(0), path + "-empty")
    assert empty.count() == 0 and empty.schema.simpleString() == df.schema.simpleString()
    docs = documents(spark)
    made = docs.selectExpr("*", "'en' lang", "'s' source", "length(text) n_chars")
    got = arrivals(spark, made, path + "-arrivals").collect()
    assert sum(r["kind"] == "document" for r in got) == docs.count() and all(r["ok"] for r in got if r["kind"] == "arrival")
    none = arrivals(spark, made.limit(0), path + "-none").collect()
    assert [(r["kind"], r["rows"], r["ok"]) for r in none] == [("arrival", 0, True)] * 4
