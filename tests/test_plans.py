"""The enrichment plan with a scripted model, evaluation, and streams."""

import json

import pytest
from pyspark.sql import functions as F

from folioforge.functions import metrics as M
from folioforge.plans import enrich
from folioforge.streaming import incremental

ABSTRACT = "We measured the small rivers of the north in all of the years for which there are data and found that they are getting smaller in most of the places that were looked at by us."
LINE = "struct<pos:int,text:string,page:int,x:double,y:double,h:double,font_size:double,bold:boolean>"
FIELDS = "struct<title:string,authors:array<string>,abstract:string,keywords:array<string>,identifiers:array<string>,language:string>"


def context(spark, n=1):
    texts = ["On small rivers", "Ana Lima", "Abstract", ABSTRACT, "Keywords: rivers; water; north", "Introduction", "The body of the paper begins in this line and goes on."]
    own = [(i, t, 0, 72.0, 100.0 + 30 * i, 9.0, 9.0, False) for i, t in enumerate(texts)]
    rows = [(f"preprint_{k}", "<teiHeader><title>On small rivers</title></teiHeader>", own, ("On small rivers", ["Ana Lima"], "", ["rivers"], [], "en"), [ABSTRACT]) for k in range(n)]
    return spark.createDataFrame(rows, f"record_id string, header_text string, lines array<{LINE}>, tei_fields {FIELDS}, tei_abstracts array<string>")


SAID = {
    "HEADER_METADATA": {"title": "On small rivers", "authors": ["Ana Lima"], "title_lines": [1]}, "TEI_METADATA": {"title": "On small rivers"}, "ABSTRACT_SELECT": {"abstract": ABSTRACT},
    "KEYWORD_EXTRACT": {"keyword_lists": [{"language": "en", "keywords": ["rivers", "water", "north"]}]}, "KEYWORD_SELECT": {"keywords": ["rivers", "water", "north", "made up"]},
}


def scripting(said):
    """What makes the function that is called; made here, as workers can't import a
    test."""

    def make():
        def chat(step, messages, max_tokens):
            assert step != "KEYWORD_TRANSLATE"
            return "Here it is: " + json.dumps(said.get(step, {}))

        return chat

    return make


def test_header_record_with_a_scripted_model(spark):
    out = enrich.predict(context(spark, 2), scripting(SAID)).orderBy("record_id").collect()
    assert [r["record_id"] for r in out] == ["preprint_0", "preprint_1"] and out[0]["error"] is None
    r = out[0]
    assert r["title"] == "On small rivers" and r["authors"] == ["Ana Lima"] and ABSTRACT in r["abstract"] and set(r["keywords"]) >= {"rivers", "water"} and "made up" not in r["keywords"]


def test_a_model_that_fails_leaves_the_parsers_fields(spark):
    def make():
        def chat(step, messages, max_tokens):
            raise TimeoutError("slow")

        return chat

    r = enrich.predict(context(spark), make).first()
    assert r["error"] is None and r["title"] == "On small rivers" and ABSTRACT in r["abstract"]


def test_a_fatal_call_error_ends_the_job(spark):
    def make():
        def chat(step, messages, max_tokens):
            raise enrich.FatalCallError("no credit")

        return chat

    with pytest.raises(Exception, match="no credit"):
        enrich.predict(context(spark), make).collect()


def test_extraction_of_json():
    assert enrich.answer('x {"a": {"b": 1}} y') == {"a": {"b": 1}} and enrich.answer('{"a": 2}') == {"a": 2}
    assert enrich.select(["b", "zz", "A"], [("s", ["a", "B"]), ("t", ["b"])]) == ["B", "a"]


def test_routes_are_stable():
    m = [{"role": "user", "content": "x"}]
    assert enrich.backend(m, "S", 5) == enrich.backend(list(m), "S", 5) and enrich.backend(m, "S", 5, 1) == (enrich.backend(m, "S", 5) + 1) % 5


def test_evaluation_gates_missing_content(spark):
    kind = "struct<title:string,authors:array<string>,abstract:string,keywords:array<string>,language:string,identifiers:array<string>,body_sections:array<string>>"
    rows = [
        (1, ("A title", ["Ana Lima"], "abs", ["k"], "en", ["doi:10.1/ X"], ["Intro"]), ("a Title", ["A. Lima"], "abs", ["k", "l"], "eng", ["10.1/x"], ["Intro"])),
        (2, ("A title", [], "", [], "", [], None), ("Other", ["Lima A."], "abs", ["k"], "eng", [], ["Intro"])),
    ]
    a, b = M.evaluate(spark.createDataFrame(rows, f"record_id int, pred {kind}, gold {kind}")).orderBy("record_id").collect()
    assert (a["title_match"], a["authors_f1"], a["abstract_f1"], a["keywords_recall"], a["language_match"], a["identifiers_f1"], a["body_section_f1"]) == (1, 1.0, 1.0, 0.5, 1, 1.0, 1.0)
    assert (b["title_match"], b["authors_f1"], b["language_match"], b["identifiers_f1"], b["body_section_f1"]) == (0, 0.0, 0, None, None)


def test_references_are_looked_up_only_where_there_are_none(spark):
    p = spark.createDataFrame([("a", [], []), ("b", ["Has one already"], [])], "record_id string, reference_titles array<string>, reference_dois array<string>")
    bib = spark.createDataFrame([(r, 0, "The deep blue rivers of the north", 2001, "") for r in "ab"] + [("a", 1, "short", 2001, "")], "record_id string, pos int, title string, year int, doi string")
    cat = spark.createDataFrame([(1, "The deep blue rivers of the north", 2001, "10.9/z")], "entry_id long, title string, year int, doi string")
    out = {r["record_id"]: (r["reference_titles"], r["reference_dois"]) for r in enrich.enrich_references(p, bib, cat).collect()}
    assert out == {"a": (["The deep blue rivers of the north"], ["10.9/z"]), "b": (["Has one already"], [])}


def test_stream_takes_each_key_once_and_goes_on(spark, tmp_path):
    src, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        s = incremental.once(incremental.arrivals(spark, src, "id long, ts timestamp, v string"), ["id"], "ts")
        incremental.process(s, lambda b: b.withColumn("n", F.length("v")), out, check).awaitTermination()
        return sorted((r["id"], r["n"]) for r in spark.read.parquet(out).collect())

    t = "2024-01-01 00:00:00"
    spark.createDataFrame([(1, t, "a"), (1, t, "a"), (2, t, "bb")], "id long, ts string, v string").write.mode("append").json(src)
    assert run() == [(1, 1), (2, 2)]
    spark.createDataFrame([(2, t, "bb"), (3, t, "ccc")], "id long, ts string, v string").write.mode("append").json(src)
    assert run() == [(1, 1), (2, 2), (3, 3)]


def test_windowed_usage(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("stage"), "value")
    out = incremental.windowed_usage(e)
    assert out.agg(F.sum("n_calls")).first()[0] == e.count()
