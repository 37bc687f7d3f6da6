"""Toxicity: brute force, folding, exceptions, held-out accuracy, odd tables."""

import random

import pytest
from odd import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.llm import toxicity
from folioforge.llm.toxicity import Lexicon, fold, score_text

LEX = Lexicon({"stupid": 0.8, "trash": 0.6, "ass": 1.0, "vile toad": 2.0}, {"idio": 1.0, "idiot": 1.5}, ("trash can", "stupid question"))
A = LEX.automaton()


def brute(lex, text):
    """Word by word."""
    w = fold(text).split()
    phrases = [e.split() for e in lex.exceptions]
    safe = [(i, i + len(p)) for p in phrases for i in range(len(w)) if w[i : i + len(p)] == p]
    total = hits = 0
    for i in range(len(w)):
        best = 0.0
        for t, x in lex.words.items():
            n = len(t.split())
            if w[i : i + n] == t.split() and not any(a <= i and i + n <= b for a, b in safe):
                best = max(best, x)
        for t, x in lex.stems.items():
            if w[i].startswith(t) and not any(a <= i < b for a, b in safe):
                best = max(best, x)
        total, hits = total + best, hits + (best > 0)
    return (100 * total / (len(w) + toxicity.SMOOTH) if w else 0.0), hits, len(w)


@pytest.mark.parametrize("text", ["Stupid", "stup1d", "ѕtuріd", "ＳＴＵＰＩＤ", "s​tupid", "śtüpïd", "$tup1d", "5tup!d stupid"])
def test_folding_finds_disguised_words(text):
    assert score_text(A, text)[1] == 1


@pytest.mark.parametrize("text", ["tu es un imbécile et un connard", "eres un imbécil, un estúpido y una basura", "du bist ein Trottel und Versager", "y0u are a m0ron and a loser"])
def test_the_file_has_four_languages(text):
    assert score_text(toxicity.load().automaton(), text)[0] >= toxicity.THRESHOLD


@pytest.mark.parametrize("text", ["le train est en retard", "el cubo de basura está lleno", "a degenerate matrix", "the trash can", "un retard de dix minutes"])
def test_exception_phrases_of_the_file(text):
    assert score_text(toxicity.load().automaton(), text)[1] == 0


@pytest.mark.parametrize("text", ["grass class assess", "trash can", "a TRASH  can!", "stupid question", "", "?!", "12 34"])
def test_clean_texts_score_nothing(text):
    assert score_text(A, text)[:2] == (0.0, 0)


def test_length_weights_and_overlaps():
    assert score_text(A, "trash " + "fine " * 99) == (pytest.approx(60 / 140), 1, 100)
    assert score_text(A, "idiots idiotic idiom") == (pytest.approx(100 * 4.0 / 43), 3, 3)
    assert score_text(A, "trash can and trash")[1] == 1 and score_text(A, "you vile toad")[1] == 1


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("stupid trash can ass vile toad idiot idiocy question fine stup1d а".split()), max_size=14), st.sampled_from([" ", ", ", "-", "\n"]))
def test_automaton_agrees_with_brute_force(words, sep):
    text = sep.join(words)
    got, want = score_text(A, text), brute(LEX, text)
    assert got[0] == pytest.approx(want[0]) and got[1:] == want[1:]


def test_held_out_accuracy(spark):
    """Learned on half of the labels, tried on the other half."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lex = toxicity.learn(spark, docs, labels.where("doc_id % 2 = 0"))
    r = toxicity.score(docs, lex).join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "y"), "doc_id").selectExpr("sum(int(toxic and y = 1)) tp", "sum(int(toxic and y = 0)) fp", "sum(int(not toxic and y = 1)) fn", "count(*) n").first()
    for (lang, found, all_) in toxicity.score(docs, lex).join(labels.where("doc_id % 2 = 1 and toxic = 1").select("doc_id"), "doc_id").groupBy("lang").agg(F.sum(F.col("toxic").cast("int")), F.count("*")).collect():
        print("held out", lang, found, "of", all_)
    assert r["n"] > 1500 and r["tp"] >= 0.85 * (r["tp"] + r["fn"]) and r["fp"] <= 0.005 * r["n"]


def test_accents_are_kept_for_stems_that_have_them():
    a = Lexicon({}, {"réê": 1.0, "abc": 1.0}).automaton()
    assert [score_text(a, t)[1] for t in ("réêou", "RÉÊOU x", "reeou", "réelle", "ábc", "re\u0301e\u0302ou")] == [1, 1, 0, 0, 1, 1]


def test_stems_are_learned_by_rate_and_chance_hits_are_not_rejected(spark):
    r = random.Random(0)
    words = [f"{a}{b}{c}" for a in "kmst" for b in ("ana", "olo", "iri") for c in ("pe", "du", "fo", "ga")]
    docs = []
    for i in range(600):
        w = [r.choice(words) for _ in range(r.randrange(30, 200))]
        if i % 6 == 0:
            for _ in range(max(2, len(w) // 40)):
                w[r.randrange(len(w))] = "vurpo" + r.choice(words)
        elif i % 30 == 1:
            w[r.randrange(len(w))] = "vurpokana"
        docs.append((i, " ".join(w), int(i % 6 == 0)))
    df = spark.createDataFrame(docs, "doc_id long, text string, toxic int")
    lex = toxicity.learn(spark, df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert lex.stems.keys() == {"vurp"}
    got = {r["doc_id"]: r["toxic"] for r in toxicity.score(df.drop("toxic"), lex).collect()}
    assert sum(got[i] for i in range(0, 600, 6)) >= 95 and sum(got[i] for i in range(600) if i % 6) <= 2


def test_every_document_is_scored_alike_by_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lex = toxicity.fitted(spark, docs, sf_dir)
    a = lex.automaton()
    for r in toxicity.score(docs, lex).collect():
        s, hits, _ = score_text(a, r["text"])
        assert r["tox_score"] == round(s, 6) and r["tox_hits"] == hits and r["toxic"] == (round(s, 6) >= toxicity.THRESHOLD)


def test_odd_tables(spark):
    df = documents(spark)
    out = toxicity.score(df, LEX)
    assert out.columns == [*("input_toxic" if c == "toxic" else c for c in df.columns), "tox_score", "tox_hits", "toxic"]
    assert out.where("toxic or tox_score is null or tox_hits is null").count() == 0 and out.count() == df.count()
    assert toxicity.score(df.limit(0), LEX).count() == 0
    none = spark.createDataFrame([(None, 1, None), (1, None, None)], "doc_id long, toxic int, quality int")
    assert toxicity.learn(spark, df, none).stems == {} and toxicity.learn(spark, df.limit(0), none.limit(0)).words == toxicity.load().words
    assert score_text(Lexicon({}).automaton(), "stupid") == (0.0, 0, 1)
