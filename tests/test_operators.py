"""Layout, candidate, metric and statistic operators on small tables."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.functions import metrics as M
from folioforge.functions import text as T
from folioforge.operators import assembly as A
from folioforge.operators import candidates as C
from folioforge.operators import layout as L
from folioforge.operators import statistics as S


def lines(spark, texts, pages=None, **more):
    rows = [("d", i, t, 0 if pages is None else pages[i], 100.0 + 14 * i, 72.0, 9.0) for i, t in enumerate(texts)]
    return spark.createDataFrame([tuple(r) for r in rows], "record_id string, pos int, text string, page int, y double, x double, h double").withColumns({k: F.lit(v) for k, v in more.items()})


def value(spark, column, *args):
    names = [f"c{i}" for i in range(len(args))]
    df = spark.range(1).select(*(F.lit(a).alias(n) if not isinstance(a, list) else F.lit(a).cast("array<string>").alias(n) for a, n in zip(args, names)))
    return df.select(column(*(F.col(n) for n in names)).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "f,args,want",
    [
        (T.norm_ws, ("  a   b\x1cc ",), "a b c"), (T.normalize_text, ("  Ünder The-Sea! ",), "nder thesea"), (T.dehyphenate, ("infor- mation",), "information"),
        (T.detect_language, ("the cat is on the mat and it was good",), "en"), (T.detect_language, ("o gato e o rato não se dão com os cães da rua",), "pt"), (T.detect_language, ("zzz",), "unknown"),
        (T.canonical_language, ("por",), "pt"), (T.canonical_language, ("",), "unknown"), (T.is_orcid, ("https://orcid.org/0000-0002-1825-0097",), True), (T.is_citation_doi, ("10.1/x.r2",), False),
        (T.is_figure_caption, ("Figure 2. A map of it",), True), (T.is_figure_caption, ("Fig",), False), (T.is_page_marker, ("3 of 12",), True), (T.normalize_identifier, (" DOI:10.1/ AB ",), "10.1/ab"),
        (T.scalar_match, ("", "x"), None), (T.scalar_match, ("A b", "a  B"), 1), (T.scalar_match, ("a", ""), 0), (T.edit_sim, ("", ""), 1.0), (T.edit_sim, ("ação", "acao"), 0.5), (T.language_match, ("por", "pt"), 1), (T.language_match, ("en", ""), 0),
    ],
)
def test_text_functions(spark, f, args, want):
    assert value(spark, f, *args) == want


def test_null_text_counts_as_empty(spark):
    df = spark.createDataFrame([(None,)], "x string")
    out = df.select(*(f(F.col("x")).alias(f.__name__) for f in (T.norm_ws, T.word_count, T.detect_language, T.is_boilerplate, T.score_abstract))).first()
    assert tuple(out) == ("", 0, "unknown", False, float("-inf"))


def test_running_headers_go_and_anchors_stay(spark):
    texts = ["Journal of Things"] + ["A body line that is longer than a running header and says something of its own, number one."] + ["Journal of Things", "another body line", "Journal of Things", "References", "7", "…"]
    pages = [0, 0, 1, 1, 2, 2, 2, 2]
    assert [r["pos"] for r in L.prune(lines(spark, texts, pages)).orderBy("pos").collect()] == [1, 3, 5]


def test_two_columns_are_read_one_after_the_other(spark):
    rows = [("d", i, f"{'LR'[i % 2]}{i // 2}", 0, 100.0 + 14 * (i // 2), 340.0 if i % 2 else 72.0) for i in range(8)]
    out = L.reading_order(spark.createDataFrame(rows, "record_id string, pos int, text string, page int, y double, x double")).orderBy("rank").collect()
    assert [r["text"] for r in out] == ["L0", "L1", "L2", "L3", "R0", "R1", "R2", "R3"]


def test_abstract_windows(spark):
    text = ["Title", "Abstract", "first part", "second part", "Introduction", "body"]
    out = L.marker_windows(lines(spark, text)).collect()
    assert [(r["block"], r["text"]) for r in out] == [(1, "Abstract: first part second part")]
    assert L.marker_windows(lines(spark, ["x", "y"])).first()["text"] == "x y"


def test_neighbours_by_brute_force(spark):
    r = random.Random(1)
    rows = [("d", i, "t", r.randrange(2), r.choice([100, 101.2, 101.6, 150, 151.4]) + r.random() / 10, 72.0 + r.randrange(5)) for i in range(60)]
    df = spark.createDataFrame([(a, b, c, d, float(e), float(f)) for a, b, c, d, e, f in rows], "record_id string, pos int, text string, page int, y double, x double")
    got = {x["pos"]: x["neighbours"] for x in L.baseline_neighbours(df).collect()}
    assert got == {a[1]: sum(a is not b and a[3] == b[3] and abs(a[4] - b[4]) <= 1.5 for b in rows) for a in rows}


def test_assembly_of_captions_headings_and_references():
    def row(i, text, **k):
        return {"record_id": "d", "pos": i, "text": text, "page": 0, "x": 72.0, "y": 100.0 + 14 * i, "h": 9.0, "font_size": 9.0, "bold": False} | k

    refs = [f"[{i}] Silva A, Lima B. A title of some words number {i}. Journal {i}; 2001." for i in range(1, 121)]
    doc = A.Document([row(0, "1. Introduction", bold=True, font_size=12.0), row(1, "Body text of the paper that goes on and on."), row(2, "Figure 1. A map of the rivers"), row(3, "and of the lakes."), row(5, "References")] + [row(6 + i, t) for i, t in enumerate(refs)])
    got = A.candidates_of(doc)
    assert [r["text"] for r in got if r["kind"] == "figure"] == ["Figure 1. A map of the rivers and of the lakes."]
    assert [r["n"] for r in got if r["kind"] == "reference"] == list(range(1, 121))
    assert any(r["kind"] == "heading" and "Introduction" in r["text"] for r in got)


def test_keep_first_and_selection(spark):
    df = spark.createDataFrame([("d", 0, "A  b"), ("d", 1, "a B"), ("d", 2, "c"), ("e", 0, "a b")], "record_id string, pos int, value string")
    kept = C.keep_first(df, ["record_id"], T.support_key(F.col("value")))
    assert sorted((r["record_id"], r["pos"]) for r in kept.collect()) == [("d", 0), ("d", 2), ("e", 0)]
    assert value(spark, C.select_values, ["a b", "X", "C"], ["A  b", "c", "C"]) == ["A  b", "c"]


def test_budget_stops_at_the_first_overflow(spark):
    df = spark.createDataFrame([("d", i, n) for i, n in enumerate([5, 5, 20, 1])], "record_id string, pos int, n int")
    assert sorted(r["pos"] for r in C.within_budget(df, ["record_id"], F.col("n"), 12).collect()) == [0, 1]


def test_set_and_greedy_metrics(spark):
    pr = lambda f, g, p: tuple(value(spark, f, g, p) or ())
    assert pr(M.set_pr, ["a", "b"], ["b", "c", "d"]) == pytest.approx((1 / 3, 1 / 2, 0.4))
    assert pr(M.set_pr, [], ["x"]) == () and pr(M.set_pr, ["x"], []) == (0.0, 0.0, 0.0)
    gold, pred = ["Introduction", "Methods used", "Results"], ["methods used", "Introductions", "Nothing alike"]
    assert pr(M.section_pr, gold, pred) == pytest.approx((2 / 3, 2 / 3, 2 / 3))
    assert pr(M.authors_pr, ["Ana Lima", "Jo Silva"], ["LIMA, Ana"])[1] == 0.5


def test_signed_rank_by_enumeration():
    r = np.random.default_rng(0)
    for n in (3, 5, 8):
        d = r.permutation(np.arange(1, n + 1)) * r.choice([-1.0, 1.0], n)
        rank = np.abs(d)
        w = min(rank[d > 0].sum(), rank[d < 0].sum())
        ways = [sum(k for k, s in zip(range(1, n + 1), signs) if s) for signs in itertools.product([0, 1], repeat=n)]
        assert S.signed_rank_p(d, np.zeros(n)) == pytest.approx(min(1, 2 * np.mean([x <= w for x in ways])))
    assert S.signed_rank_p(np.ones(20), np.ones(20)) == 1.0 and S.signed_rank_p(np.ones(1), np.zeros(1)) is None
    assert S.signed_rank_p(np.arange(60) % 5 + 1.0, np.zeros(60)) < 1e-8


def test_section_tests(spark):
    df = spark.createDataFrame([("c", i, "m", 0.9, 0.1 + (i % 7) / 100) for i in range(20)] + [("d", 99, "m", 1.0, None)], "corpus string, record_id int, metric string, a double, b double")
    out = {r["section"]: r for r in S.section_tests(df).collect()}
    assert out["c"]["p"] < 0.001 and out["c"]["ci_a"]["low"] == out["c"]["ci_a"]["mean"] == pytest.approx(0.9) and out["overall"]["ci_b"]["low"] < out["overall"]["ci_b"]["high"]
    n = {r["section"]: (r["n_a"], r["n_b"]) for r in S.sections(df).collect()}
    assert n == {"overall": (21, 20), "c": (20, 20), "d": (1, 0)}


def test_catalogue_lookup(spark):
    q = spark.createDataFrame([(1, "The deep blue rivers of the north", 2001), (2, "nothing at all", 2000)], "query_id long, title string, year int")
    c = spark.createDataFrame([(10, "Deep blue rivers of the north", 2002), (11, "Deep blue rivers of the north", 2010), (12, "Shallow lakes", 2001)], "entry_id long, title string, year int")
    assert [(r["query_id"], r["entry_id"]) for r in C.lookup(q, c).collect()] == [(1, 10)]


def test_lookup_by_steps_is_the_ranking_of_all_pairs(spark):
    import random

    rnd = random.Random(5)
    title = lambda: " ".join(rnd.choices("the of and more river water stone north fish deep old new".split(), weights=[9, 9, 9, 9, 3, 3, 3, 3, 1, 1, 1, 1], k=rnd.randint(1, 7)))
    year = lambda: rnd.choice([None, 2000, 2001, 2003, 2010])
    q, c = [(i, title(), year()) for i in range(60)] + [(60, "", None), (61, None, 2000)], [(i, title(), year()) for i in range(150)] + [(150, " ", None)]
    qs, cs = (spark.createDataFrame(v, f"{k} long, title string, year int") for v, k in ((q, "query_id"), (c, "entry_id")))
    score = lambda x, y: len(x & y) / len(x | y) if x | y else 0.0
    words = lambda t: set((t or "").split())
    for least in (0.05, 0.5, 0.8, 1.0):
        want = {}
        for i, t, y in q:
            ranked = sorted((-score(words(t), words(u)), j, z) for j, u, z in c if score(words(t), words(u)) > 0)[:5]
            fit = [(j, -s) for s, j, z in ranked if -s >= least and (y is None or z is None or abs(y - z) <= 1)]
            if fit:
                want[i] = fit[0]
        assert {r["query_id"]: (r["entry_id"], r["score"]) for r in C.lookup(qs, cs, least).collect()} == want
    sets = lambda v, k: spark.createDataFrame([(sorted(w),) for w in {frozenset(words(t)) for _, t, _ in v} if w], f"{k} array<string>")
    a, b = sets(q, "q"), sets(c, "c")
    for least in (0.3, 0.5, 0.75):
        want = {(tuple(x[0]), tuple(y[0])) for x in a.collect() for y in b.collect() if score(set(x[0]), set(y[0])) >= least}
        assert {(tuple(r["q"]), tuple(r["c"])) for r in C.similar_sets(a, b, least).collect()} == want and want


def test_author_matches_is_author_match_of_each_group(spark):
    from folioforge.functions import metrics as M

    gold = spark.createDataFrame([(1, 1, "Ana Lima"), (2, 1, "LIMA, A."), (3, 2, "Ana Lima"), (4, 1, ""), (5, 1, None), (6, None, "Lima"), (7, 1, "Souza dos"), (8, 3, "Lima"), (1, 1, "Ana Lima")], "id long, g int, name string")
    pred = spark.createDataFrame([(1, "lima souza"), (1, "B. Lima"), (2, "Climate"), (2, None), (None, "Lima"), (1, "")], "g int, name string")
    names = pred.groupBy("g").agg(F.collect_list("name").alias("names"))
    want = gold.join(names, "g", "left").select("id", "g", "name", M.author_match(F.col("name"), F.coalesce("names", F.array().cast("array<string>"))).alias("hit"))
    key = lambda r: (r["id"], str(r["name"]))
    assert sorted(M.author_matches(gold, pred, ["g"]).collect(), key=key) == sorted(want.collect(), key=key)
    assert {r["id"] for r in want.where("hit").collect()} == {1, 7}


def test_assemble_streams_documents_of_many_batches(spark):
    rnd = random.Random(3)
    texts = ["Figure 1. A river and its stones.", "1. Rivers", "Table 2. Numbers of stones.", "References", "[1] Lima A. On the small rivers of the north.", "Introduction", "goes on here"]
    rows = [(d, i, rnd.choice(texts), rnd.randint(0, 2), 72.0 * rnd.randint(1, 3), 20.0 * rnd.randint(1, 30), rnd.choice([9.0, 14.0, None]), rnd.random() < 0.3) for d in range(40) for i in range(rnd.randint(1, 12))]
    rnd.shuffle(rows)
    names = "record_id pos text page x y font_size bold".split()
    df = spark.createDataFrame(rows, "record_id long, pos int, text string, page int, x double, y double, font_size double, bold boolean")
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "7")
    try:
        made = A.assemble(df)
        got = sorted((r["record_id"], r["kind"], r["n"], r["text"], r["page"], r["x"], r["y"]) for r in made.collect())
    finally:
        spark.conf.set(limit, usual)
    want = [(d, r["kind"], r["n"], r["text"], r["page"], r["x"], r["y"]) for d in range(40) for r in A.candidates_of(A.Document([dict(zip(names, v)) for v in rows if v[0] == d]))]
    assert got == sorted(want) and len({r[1] for r in got}) == 4
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().executedPlan().toString()


def test_the_line_below_is_the_nearest_of_all(spark):
    rnd = random.Random(4)
    doc = A.Document([dict(pos=i, text="t", page=rnd.randint(0, 1), x=float(rnd.randint(0, 60)), y=float(rnd.randint(0, 20))) for i in range(200)])
    for i, a in enumerate(doc.lines):
        near = [(o.y, j) for j, o in enumerate(doc.lines) if o.page == a.page and o.y > a.y and abs(o.x - a.x) <= 24]
        assert doc.below(i) == (min(near)[1] if near else None)
    assert set(doc.downwards) == {0, 1}


def test_normal_text_is_the_same_by_character_and_by_array(spark):
    import re

    every = [chr(i) for i in [*range(0x3000), *range(0xFF00, 0xFFFF), *range(0x10000, 0x10FFFF, 997), 0x10FFFF]]
    df = spark.createDataFrame([(c,) for c in every], "c string")
    got = df.select("c", (~F.col("c").rlike(T.ABNORMAL)).alias("a"), (~F.col("c").rlike(T.ABNORMAL_WORD)).alias("w"), T.all_normal(F.array(F.lit("x"), F.col("c"), F.lit(None))).alias("n")).collect()
    assert [(r["a"], r["w"], r["n"]) for r in got] == [(bool(re.fullmatch("[a-z0-9' ]", r["c"])), bool(re.fullmatch("[a-z0-9']", r["c"])), bool(re.fullmatch("[a-z0-9']", r["c"]))) for r in got]
    rows = [(["a", "b", "", None, "a"], ["b", "C"]), (["É a", "b"], ["a", " B "]), ([], ["a"]), (None, ["a"])]
    out = spark.createDataFrame(rows, "g array<string>, p array<string>").select(M.keyword_pr(F.col("g"), F.col("p")).alias("m")).collect()
    assert [None if r["m"] is None else (r["m"]["p"], r["m"]["r"]) for r in out] == [(0.5, 0.5), (0.5, 0.5), None, None]  # of "É a" a space is left


def test_front_evidence_and_pruning_move_lines_once(spark):
    rnd = random.Random(6)
    texts = ["Running head", "A line of the text that is long enough to stay where it is in any case, as it has more than ninety characters.", "", "12", "References", "bioRxiv preprint", "ß Strasse", "SS STRASSE"]
    rows = [(d, i, rnd.choice(texts[:3] if d % 4 else texts), i // 3 if d % 5 else 9, rnd.choice([10.0, 300.0, 770.0]), 72.0) for d in range(30) for i in range(rnd.randint(1, 20))]
    df = spark.createDataFrame(rows, "record_id long, pos int, text string, page int, y double, x double")
    from folioforge.plans import enrich

    def kept(own, front):
        own = [A.Line.of(dict(pos=i, text=t, page=p, y=y, x=x)) for _, i, t, p, y, x in own]
        own = ([n for n in own if n.page <= 5] or own) if front else own
        often = enrich.again(own)
        good = [n.pos for n in own if not enrich.is_furniture(n, often, False)]
        return good or ([n.pos for n in own] if front else [])

    for front, made in ((True, L.front_matter_evidence(df)), (False, L.prune(df))):
        want = {(d, i) for d in range(30) for i in kept([r for r in rows if r[0] == d], front)}
        assert {(r["record_id"], r["pos"]) for r in made.collect()} == want and made.columns == df.columns
        assert made.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_containment_is_that_of_all_pairs(spark):
    rnd = random.Random(8)
    words = "river water stone north fish deep old new small great 12 a".split()

    def text():
        return " ".join(rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 12, 25])))

    rows = []
    for g in [*range(12), None]:
        own = [text() for _ in range(rnd.choice([3, 20, 90]))]
        own += [rnd.choice(own)[rnd.randint(0, 4) :][: rnd.randint(1, 40)] for _ in range(len(own) // 2)] + [" ", rnd.choice(own).upper()]
        rows += [(g, p, t) for p, t in enumerate(own)]
    rows += [(0, 1, text()) for _ in range(8)]  # positions that recur
    rnd.shuffle(rows)
    key = lambda t: " ".join(t.lower().split())
    tokens = lambda t: {w for w in key(t).split() if not w.isdigit()}

    def lost(a, b):
        (_, p, t), (_, q, u) = a, b
        x, y = tokens(t), tokens(u)
        return key(t) != key(u) and key(t) in key(u) or p != q and bool(x) and len(y) > len(x) and len(x & y) / len(x) >= 0.9

    want = {}
    for r in rows:
        if key(r[2]) and (r[0] is None or not any(lost(r, o) for o in rows if o[0] == r[0])):
            k = (r[0], key(r[2]))
            want[k] = min(want.get(k, r[1]), r[1])
    df = spark.createDataFrame(rows, "g int, pos int, text string").withColumn("more", F.lit("x"))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(limit)
    spark.conf.set(limit, "13")
    try:
        out = C.without_contained(df, ["g"])
        got = out.collect()
    finally:
        spark.conf.set(limit, usual)
    assert {(r["g"], key(r["text"])): r["pos"] for r in got} == want and len(got) == len(want) and out.columns == df.columns
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
