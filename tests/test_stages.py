"""Parser stages, contexts, settings and reports."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioforge.operators import candidates as C
from folioforge.operators import statistics as S
from folioforge.plans import config, enrich, reports, stages


def test_a_parser_runs_on_what_is_left_and_errors_are_rows(spark):
    docs = spark.createDataFrame([(1, bytearray(b"one")), (2, bytearray(b"two")), (3, None), (4, bytearray(b"bad")), (5, bytearray(b"none"))], "record_id long, content binary")
    done = spark.createDataFrame([(2,)], "record_id long")

    def make():
        def parse(content):
            if content == b"bad":
                raise OSError("broken")
            return "" if content == b"none" else f"<TEI>{content.decode()}"

        return parse

    good, bad = stages.parsed(stages.parse_documents(docs, done, make))
    assert [tuple(r) for r in good.collect()] == [(1, "<TEI>one")]
    assert dict(map(tuple, bad.collect())) == {3: "ValueError: no content", 4: "OSError: broken", 5: "ValueError: not a TEI document: ''"}
    assert stages.as_output("x") == "x"
    with pytest.raises(ValueError):
        stages.as_output("")


def test_connections_are_tried_until_the_patience_ends():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    calls = iter([ConnectionError(), ConnectionError(), "<TEI>"])

    def parse(_):
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert stages.persistent(parse, 60, clock=lambda: now[0], sleep=sleep)(b"") == "<TEI>" and waits == [5.0, 5.0]

    def never(_):
        raise ConnectionError

    with pytest.raises(RuntimeError, match="after 12 s"):
        stages.persistent(never, 12, clock=lambda: now[0], sleep=sleep)(b"")
    assert waits[2:] == [5.0, 5.0, 2.0]


def test_parser_settings():
    assert stages.parser_url() == "http://localhost:8070/api" and stages.parser_url("sciencebeam").endswith(":8071/api")
    assert stages.parser_url("grobid", "o", "s") == "o" and stages.parser_url("grobid", None, "s") == "s"
    assert stages.parser_form("grobid", 1)["consolidateHeader"] == "1" and stages.parser_form("sciencebeam") == {}
    with pytest.raises(ValueError):
        stages.parser_form("other")
    assert stages.layout_command("pdfalto", "a.pdf", "a.xml", 1, 3) == ["pdfalto", "-skipGraphs", "-f", "1", "-l", "3", "a.pdf", "a.xml"]


def test_settings_from_yaml_and_json():
    s = config.load("metrics: [a, b]\nbootstrap: {n_resamples: 50}\ncorpora:\n  x: x.parquet\n  y: {file: y.parquet, id: pid, n: 3}\n")
    assert s.metrics == ("a", "b") and s.bootstrap == config.Bootstrap(50, 0.95) and s.corpora == {"x": config.Corpus("x.parquet"), "y": config.Corpus("y.parquet", "pid", 3)}
    assert config.load('{"seed": 7}').seed == 7 and config.load("") == config.Settings()
    with pytest.raises(ValueError, match="unknown settings: foo"):
        config.load("foo: 1")


@pytest.fixture
def pairs(spark):
    r = np.random.default_rng(1)
    rows = [(f"c{i % 2}", i, m, float(a), float(a) - 0.1 + float(e)) for i in range(40) for m in ("x", "y") for a, e in [(r.uniform(), r.normal() * 0.01)]]
    return spark.createDataFrame([*rows, ("c0", 99, "x", None, 0.5)], "corpus string, record_id long, metric string, a double, b double")


def test_reports(spark, pairs):
    scores = reports.scored(pairs)
    tokens = spark.createDataFrame([("overall", None, 1234, 10, 1244, 3), ("overall", "other", 1000, 10, 1010, 2)], "section string, group string, prompt_tokens long, completion_tokens long, total_tokens long, n_calls long")
    base = spark.createDataFrame([("overall", "x", 0.25, None)], "section string, metric string, delta double, p double")
    text = reports.report(scores, ["x", "y"], baseline=base, tokens=tokens, record={"llm": {"model": "m"}}, errors=[{"error": "A: b"}, {"error": "A: c"}, {"error": None}])
    assert "- **LLM model:** m" in text and "3 document(s) skipped due to errors (A=2, unknown=1)" in text
    assert "<summary><b>overall (N=41) — LLM tokens: 1.2k prompt / 10 completion / 1.2k total, 3 calls</b></summary>" in text
    assert text.index("overall") < text.index("c0 (N=21)") < text.index("c1 (N=20)")
    line = next(x for x in text.split("\n") if x.startswith("| x |"))
    assert "+0.250 | n/a" in line and line.endswith("| 1.0k | 10 |")
    both = reports.side_by_side({"one": scores, "two": reports.scored(pairs.withColumn("a", F.col("a") + 1))}, ["x", "y"], records={"one": {"llm": {"model": "m", "step_lora_map": {"a": "z", "b": "q"}}, "parser_image": "i"}})
    assert "- `one` — model=`m` · LoRA adapters=[q, z] · parser=`i`" in both and "- `two` — (unknown)" in both
    row = next(x for x in both.split("\n") if x.startswith("| y |")).split(" | ")
    assert row[3].startswith("**1.") and not row[2].startswith("**")


def test_report_pieces(spark):
    assert [reports.kilo(n) for n in (0, 999, 1000, 1234)] == ["0", "999", "1.0k", "1.2k"] and reports.signed(None) == "n/a"
    assert reports.run_spec(" a = b=c ") == ("a", "b=c") and reports.tokens_text({}) == ""
    for wrong in ("abc", "=x"):
        with pytest.raises(ValueError):
            reports.run_spec(wrong)
    assert reports.bold_best(["a", "b", "c"], [1.0, None, 1.0]) == ["**a**", "b", "c"] and reports.bold_best(["a"], [math.nan]) == ["a"]
    assert "2.0 calls/doc" in reports.tokens_text({"n_calls": 4}, {"n_calls": 2.0, "total_tokens": 1500})
    assert reports.case_text("r", "m", "a b", {"llm": (0.5, "a c"), "parser": (None, None)}) == "record_id : r\n  llm : m=0.500 | a [-b-] {+c+}\n  parser : m=n/a | reference=a b candidate=None"
    assert spark.range(1).select(reports.pred_key(F.lit("llm_metrics")), reports.label_of(F.lit("llm_pred"))).first()[:] == ("llm_pred", "llm")


def test_root_cause_report(spark):
    s = "struct<title:string,abstract:string,authors:array<string>,keywords:array<string>,publisher:string,date:string,rights:string,identifiers:array<string>>"
    side = ("T", "A" * 30, ["x"], ["k"], "p", "d", "r", ["i"])
    rows = [(i, i, side, ("" if i else "T", *side[1:]), (0.1, 1)) for i in range(4)]
    df = spark.createDataFrame(rows, f"record_id long, pos long, gold {s}, pred {s}, metrics struct<keywords_recall:double,language_match:int>")
    text = reports.root_cause_report(df, {"title_match": 0.25})
    assert "title_match~0.250" in text and "## missing or empty title\n- 1: " in text and text.count("\n- 3: ") == 0 and "## authors missing" not in text


def test_intervals_of_any_number_of_records(spark, pairs):
    got = {(r["section"], r["metric"]): r for r in S.poisson_intervals(pairs).collect()}
    exact = {(r["section"], r["metric"]): r["ci_a"] for r in S.section_tests(pairs).collect()}
    assert got.keys() == exact.keys()
    for k, r in got.items():
        assert r["mean"] == pytest.approx(exact[k]["mean"]) and abs(r["low"] - exact[k]["low"]) < 0.05 and abs(r["high"] - exact[k]["high"]) < 0.05
    again = {(r["section"], r["metric"]): r for r in S.poisson_intervals(pairs.repartition(5)).collect()}
    assert all(again[k]["low"] == pytest.approx(got[k]["low"]) for k in got)


def test_bootstrap_draws_in_the_order_of_the_records(spark):
    v = [0.3, 0.9, 0.1, 0.7]
    df = spark.createDataFrame([("c", i, "m", x, x) for i, x in enumerate(v)], "corpus string, record_id long, metric string, a double, b double")
    rng = np.random.default_rng(0)
    means = [np.array(v)[rng.integers(0, 4, 4)].mean() for _ in range(200)]
    r = S.section_tests(df).where("section = 'overall'").first()
    assert r["ci_a"]["low"] == pytest.approx(np.percentile(means, 2.5)) and r["ci_a"]["high"] == pytest.approx(np.percentile(means, 97.5)) and r["p"] == 1.0
    assert S.section_tests(df.where("record_id = 0")).where("section = 'overall'").first()["p"] is None


def test_a_sample_is_of_each_group_and_stable(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 3 as string) g", "id * 2 x")
    one, two = (S.sample(d, "g", "id", 10) for d in (df, df.repartition(7)))
    assert {r["id"] for r in one.collect()} == {r["id"] for r in two.collect()} and one.groupBy("g").count().where("count = 10").count() == 3
    assert {r["id"] for r in S.sample(df, "g", "id", 10, 1).collect()} != {r["id"] for r in one.collect()} and S.sample(df.where("id < 4"), "g", "id", 10).count() == 4


def test_passages_are_found_wherever_they_stand(spark):
    sources = spark.createDataFrame([(1, "The Quick  brown fox jumps over the lazy dog today"), (2, "xbrown fox jumps over thex"), (3, "one two"), (4, "")], "s long, text string")
    wanted = [(1, "rown fox jumps over th"), (2, "quick brown fox jumps over the lazy dog"), (3, "fox jumps"), (4, "wo"), (5, "brown fox jumps"), (6, ""), (7, "nothing of the kind is here at all")]
    got = {(r[0], r[1]) for r in C.holding(sources, spark.createDataFrame(wanted, "p long, passage string"), "s", "p").collect()}
    text = {1: "the quick brown fox jumps over the lazy dog today", 2: "xbrown fox jumps over thex", 3: "one two", 4: ""}
    assert got == {(p, s) for p, w in wanted if w for s, t in text.items() if w in t}
    assert C.holding(sources, spark.createDataFrame([(1, "")], "p long, passage string"), "s", "p").count() == 0


def test_candidate_functions(spark):
    one = lambda *c: spark.range(1).select(*c).first()[:]
    words = lambda *v: F.array(*map(F.lit, v)).cast("array<string>")
    long_en = "In this study we show that the results of the work are as good as those of the others and that it is for all of us to see in the end of it. " * 2
    mixed = "the of and with this is " * 5 + "el la de los que para " * 5
    assert one(C.block_tokens(F.lit("Ａ b 12 b ﬁn")))[0] == ["a", "b", "fin"]
    assert one(C.near_marker(F.lit("x" * 300 + " Abstract: text"), 50))[0][:1] == "x" and one(C.near_marker(F.lit("x" * 300 + " Abstract: text"), 1000, 0))[0] == "Abstract: text" and one(C.near_marker(F.lit("none here"), 4))[0] == "none"
    best = lambda *v: one(C.best_abstract(words(*v), F.lit("en")))[0]
    assert best() == "" and best(" ", "short one") == "short one" and best("short one", long_en) == long_en and best(mixed, long_en) == long_en
    assert one(C.with_preprint_identifiers(F.lit("a:preprint_7"), words("0000-0001-2345-6789", "10.1/x", "10.1/x", "")))[0] == ["10.1/x", "https://preprints.scielo.org/index.php/scielo/preprint/view/7", "10.1590/SciELOPreprints.7"]
    rec = spark.createDataFrame([(("", ["a"]), ("t", [])), (None, ("u", [" ", "b"]))], "x struct<title:string,authors:array<string>>, y struct<title:string,authors:array<string>>")
    made = C.coalesced(["x", "y"], ["title"], ["authors"])
    assert sorted(map(tuple, rec.select(*(c.alias(k) for k, c in made.items())).collect())) == [("t", ["a"]), ("u", ["b"])]
    target = lambda k, *here: one(C.target_languages(words(*k), words(*here)))[0]
    assert target(["as palavras do que um"], "en") == ["en"] and target(["the study of this"], "es", "en", "pt") == ["es", "pt"] and target([], "en") == [] and target(["xyz"], "es", "en") == ["en", "es"]


def test_model_names(spark):
    names = spark.createDataFrame([("qwen/qwen-2.5-7b",), ("meta/llama-3",), ("other/Qwen_2.5-7B",)], "name string")
    wanted = spark.createDataFrame([("Qwen/Qwen2.5-7B",), ("meta/llama-3",), ("x/LLAMA.3",), ("none/such",)], "wanted string")
    assert dict(map(tuple, C.resolved(wanted, names).collect())) == {"Qwen/Qwen2.5-7B": "qwen/qwen-2.5-7b", "meta/llama-3": "meta/llama-3", "x/LLAMA.3": "meta/llama-3", "none/such": None}
    near = C.closest(names, wanted.where("wanted = 'x/LLAMA.3'").selectExpr("lower(wanted) wanted"), 1).collect()
    assert [(r["name"]) for r in near] == ["meta/llama-3"]


def test_model_calls_on_text():
    lines = enrich.A.Document([{"pos": i, "text": t} for i, t in enumerate(["a gra-", "ph of", "b"])]).lines
    assert enrich.grounded_list(["x", "y", "z"], [[1, 2], "no", [9]], lines) == ["a graph of", "y", "z"] and enrich.grounded_list(["x", " "], [], lines) == ["x"]
    assert enrich.clean_ocr_text(lines, lambda step, m, n: f" {step}  {m[1]['content'].count(chr(10))} ") == "OCR_CLEANUP 2"
    say = lambda step, m, n: '{"translations": {"pt": ["b ", "a"], "es": ["c"]}}'
    assert enrich.translate_keywords(["a", " "], ["pt", "es"], say) == ["a", "b", "c"] and enrich.translate_keywords(["a"], [], None) == ["a"] and enrich.translate_keywords(["a"], ["pt"], lambda *x: "?") == ["a"]
    often = enrich.again(enrich.A.Document([{"pos": i, "text": "Head", "page": i} for i in range(3)]).lines)
    assert often == {"head"}
