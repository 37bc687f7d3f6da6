"""Substring removal: brute force in Python, planted passages, odd tables."""

import random

import pyarrow as pa
from odd import TEXT, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from folioforge.llm import substring


def brute(docs, min_words=substring.MIN_WORDS):
    """{doc_id: spans}, by a walk through all documents in order of id."""
    seen, out = set(), {}
    for i, t in sorted(docs):
        spans, run = [], []

        def close():
            if sum(n for *_, n in run) >= min_words:
                spans.append((run[0][0], run[-1][1]))
            run.clear()

        for a, b in substring.units(t):
            w = substring.normalise(t[a:b])
            if tuple(w) in seen:
                run.append((a, b, len(w)))
            else:
                seen.add(tuple(w))
                close()
        close()
        out[i] = spans
    return out


def sentences(r, n, words):
    return [" ".join(r.choice(words) for _ in range(r.randrange(4, 14))).capitalize() + r.choice(".!?") for _ in range(n)]


def corpus(seed=1, n=150):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(900)]
    shared = [sentences(r, r.randrange(6, 12), words) for _ in range(8)]
    docs = []
    for i in range(n):
        s = sentences(r, r.randrange(1, 30), words)
        for _ in range(r.choice([0, 0, 1, 2])):
            at = r.randrange(len(s) + 1)
            s[at:at] = r.choice(shared)
        docs.append((i, r.choice([" ", "\n", "  \n\n"]).join(s)))
    return docs


def test_agrees_with_a_walk_in_order(spark):
    docs = corpus()
    out = substring.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(7)).collect()
    want, texts = brute(docs), dict(docs)
    assert {r["doc_id"]: [tuple(x) for x in r["removed"]] for r in out} == want and sum(map(len, want.values())) > 60
    for r in out:
        t, at, left = texts[r["doc_id"]], 0, ""
        for a, b in r["removed"]:
            left, at = left + t[at:a], b
        assert r["text"] == left + t[at:]


def test_min_words(spark):
    docs = corpus(2, 60)
    out = substring.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string"), min_words=1).collect()
    assert {r["doc_id"]: [tuple(x) for x in r["removed"]] for r in out} == brute(docs, 1)


def test_planted_passage_of_over_50_words_goes_and_the_first_copy_stays(spark):
    r = random.Random(4)
    words = [f"v{i}" for i in range(5000)]
    passage = " ".join(sentences(r, 9, words))
    assert len(passage.split()) > 50
    docs = [(i, " ".join([*sentences(r, 5, words), passage, *sentences(r, 5, words)])) for i in range(20)]
    out = {x["doc_id"]: x["text"] for x in substring.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert passage in out[0] and not any(passage in out[i] for i in range(1, 20))
    whole, cut = dict(docs), passage.split()
    assert all(set(whole[i].split()) - set(out[i].split()) <= set(cut) for i in out)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB. \n!?é\t", max_size=60))
def test_units_cover_the_text_from_the_first_word_on(t):
    u = substring.units(t)
    assert all(a < b for a, b in u) and all(x[1] == y[0] for x, y in zip(u, u[1:]))
    assert (not u and not substring.normalise(t)) or (u[-1][1] == len(t) and not substring.normalise(t[: u[0][0]]))
    assert [w for a, b in u for w in substring.normalise(t[a:b])] == substring.normalise(t)


def test_odd_tables(spark):
    df = documents(spark)
    out = substring.dedup(spark, df)
    assert out.columns == ["doc_id", "text", *("input_removed" if c == "removed" else c for c in df.columns[2:]), "removed"]
    got = out.collect()
    assert len(got) == df.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert all(r["text"] == TEXT and not r["removed"] for r in by[4] if r["text"].startswith("A plain")) and len(by[4]) == 4  # repeated rows are one document
    assert by[5][0]["text"] == "" and [tuple(x) for x in by[5][0]["removed"]] == [(0, len(TEXT))]
    assert by[7][0]["text"] == "" and by[6][0]["text"] != "" and by[1][0]["text"] is None and by[2][0]["text"] == ""
    assert sorted(str(r["text"]) for r in by[None]) == sorted([TEXT, "None"])  # can't be ranked: as they are
    empty = substring.dedup(spark, df.limit(0))
    assert empty.count() == 0 and empty.columns == out.columns


def test_rows_that_repeat_in_one_task_keep_their_text(spark):
    docs = [(4, TEXT), (4, TEXT), (5, TEXT), (4, TEXT), (3, "Another text.")]
    got = substring.dedup(spark, spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(3, "Another text."), (4, TEXT), (4, TEXT), (4, TEXT), (5, "")]
