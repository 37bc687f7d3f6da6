"""The pipeline: each stage on what its predecessor kept, odd tables."""

import random

import pytest
from odd import clashing, documents, rows

import corpus_pipeline
from folioforge.llm import toxicity
from folioforge.llm.common import written

NAMES = ["toxicity", "simhash_near_dedup", "substring_dedup", "packing"]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES


@pytest.fixture(scope="module")
def planted(tmp_path_factory, spark):
    """200 documents: clean ones, toxic ones, near copies, and a shared passage."""
    r = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: ". ".join(" ".join(r.choice(words) for _ in range(9)).capitalize() for _ in range(n))
    passage = text(8)
    docs, kind = [], {}
    for i in range(200):
        t, k = text(r.randrange(12, 30)), "clean"
        if i % 10 == 3:
            t, k = t.replace(" ", " stupid idiot ", 3), "toxic"
        elif i % 10 == 6:
            t, k = docs[-2][1] + ". Another end", "copy"
        elif i % 10 == 8:
            t, k = f"{t}. {passage}. {text(5)}", "passage"
        docs.append((i, t, "en", f"src{i % 3}", len(t)))
        kind[i] = k
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(kind[i] == "toxic")) for i in range(0, 200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, {x[0]: x[1] for x in docs}, kind, passage


def test_planted_cases(spark, planted):
    d, texts, kind, passage = planted
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, d), name)
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert kept[0] == {i: t for i, t in texts.items() if kind[i] != "toxic"}
    assert kept[1] == {i: t for i, t in texts.items() if kind[i] not in ("toxic", "copy")}
    assert kept[2].keys() == kept[1].keys() and [i for i, t in kept[2].items() if passage in t] == [8]
    assert all(kept[2][i] == texts[i] for i in kept[2] if kind[i] == "clean")
    assert docs.where("n_chars != length(text)").count() == 0
    out = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"] for r in out} == set(kept[2])


def test_run_is_the_stages_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    assert rows(docs) == rows(corpus_pipeline.run(spark, sf_dir))


def test_clean_documents_stay(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = corpus_pipeline.without_toxic(spark, docs, sf_dir)
    clean = docs.join(labels.where("toxic = 0"), "doc_id")
    assert clean.join(kept, "doc_id", "left_anti").count() == 0


def test_odd_tables(spark, sf_dir):
    df = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = written(spark, stage(spark, df, sf_dir), name)
        empty = stage(spark, df.limit(0), sf_dir)
        assert empty.count() == 0 and empty.columns == df.columns
    assert corpus_pipeline.packed(spark, df, sf_dir).count() > 0
    assert toxicity.score(df, toxicity.Lexicon({})).count() == df.count()


def test_the_values_of_clashing_columns_stay(spark, sf_dir):
    docs, names = clashing(spark)
    own = {r["doc_id"]: tuple(r[n] for n in names) for r in docs.collect()}
    left = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(spark, stage(spark, docs, sf_dir), name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        got = {r["doc_id"]: tuple(r[n] for n in names) for r in out.collect()}
        assert got == {i: own[i] for i in got}, name
        left.append(len(got))
        docs = out
    assert left[0] == 39 and left[1] < 39 and left[2] == left[1]
