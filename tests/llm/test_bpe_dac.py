import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import bpe, dac

RANKS = bpe.load()
CODEC = bpe.Codec(RANKS)
WHOLE = tiktoken.Encoding("whole", pat_str=bpe.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def encoded(texts):
    out = []
    for ids, off in CODEC.encode(pa.array(texts, pa.string())):
        out += [ids[off[i] : off[i + 1]].tolist() for i in range(len(off) - 1)]
    return out


CASES = ["", " ", "Hello, world!", "it's  we'll\t\tdon't 'quoted' x's'y", "é'è  　x", "a\n\n b\r\n", "日本語 テスト", "🙂🙂 x🙂y", "1234 5,678.90", "zq§'s §'t", "  lead", "trail  ", "ÀB́c", "<|endoftext|>", "x" * 5000]


def test_fragments_give_what_the_whole_text_gives():
    assert encoded(CASES) == [WHOLE.encode_ordinary(t) for t in CASES]


def test_documents(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    assert encoded(texts) == [WHOLE.encode_ordinary(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aAbz sStTrRvVlLdDmM'\"\n\t .,!?0159éß  §€日🙂"), st.characters(codec="utf-8")), max_size=60), max_size=6))
def test_any_text(texts):
    assert encoded(texts) == [WHOLE.encode_ordinary(t) for t in texts]


def test_cuts_are_in_no_token():
    cut = bpe.certain_cuts(iter(RANKS))
    assert 1000 < cut.sum() < 65536
    assert not any(cut[a * 256 + b] for t in RANKS for a, b in zip(t, t[1:]))


def test_encode_and_decode_rows(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (None, None, "y"), (3, "", None), (4, "long " * 40000, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tokens string")
    out = bpe.decode(spark, bpe.encode(spark, df)).orderBy("doc_id").collect()
    assert [r["decoded"] for r in out] == ["", "a b", "a b", "", "long " * 40000]
    assert all(r["round_trip"] for r in out) and out[1]["input_tokens"] == "x"
    assert bpe.encode(spark, df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**16), st.integers(0, 2**40)), max_size=1500))
def test_codes_give_each_id_back(ids):
    code = dac.encode(np.array(ids, np.int64))
    r = dac.Reader(code)
    assert len(r) == len(ids) and [r[i] for i in range(len(ids))] == ids and r.to_numpy().tolist() == ids


def test_code_layout_and_errors():
    r = dac.Reader(dac.encode(np.array([5, 256, 70000] * 600)))
    assert r[-1] == 70000 and len(r.levels) == 3 and [n for n, *_ in r.levels] == [1800, 1200, 600]
    with pytest.raises(IndexError):
        r[1800]
    with pytest.raises(ValueError):
        dac.encode(np.array([-1]))
    with pytest.raises(ValueError):
        dac.Reader(b"abcdefghijklm")


def test_code_rows(spark):
    df = spark.createDataFrame([(1, [1, 300, None, 2], 1, "a"), (2, None, 0, "b"), (3, [], 0, "c"), (4, [9], 5, "d"), (5, [9], None, "e")], "id long, tokens array<int>, position int, code string")
    out = dac.pick(dac.encode_lists(df)).orderBy("id").collect()
    assert [r["token"] for r in out] == [300, None, None, None, None]
    assert dac.Reader(out[0]["code"]).to_numpy().tolist() == [1, 300, 2]


def test_codes_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in dac.encode_texts(spark, docs).collect():
        want = WHOLE.encode_ordinary(texts[r["doc_id"]])
        got = dac.Reader(r["code"])
        assert len(got) == r["n_tokens"] == len(want) and got.to_numpy().tolist() == want and all(got[i] == want[i] for i in range(0, len(want), 37))
    odd = dac.encode_texts(spark, spark.createDataFrame([(None, None, 1), (2, "", 2)], "doc_id long, text string, code int"))
    assert [r["n_tokens"] for r in odd.collect()] == [0, 0]
