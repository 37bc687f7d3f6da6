"""Document readers, tables and sinks."""

from pyspark.sql import functions as F

from folioforge.sources import sinks, tables, xml

TEI = """<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader xml:lang="en"><fileDesc><titleStmt><title>On small rivers</title></titleStmt>
<sourceDesc><biblStruct><analytic><author><persName><forename>Ana</forename> <surname>Lima</surname></persName></author></analytic><idno type="DOI">10.1234/own.1</idno></biblStruct></sourceDesc></fileDesc>
<profileDesc><textClass><keywords><term>rivers</term><term>water</term></keywords></textClass><abstract><div><p>Rivers are small here and were measured in all of the years that we could find data for.</p></div></abstract></profileDesc></teiHeader>
<text><body><div><head>Introduction</head><p>x <formula>a</formula></p></div><div><head>Methods</head><p>y</p></div>
<figure><head>Figure 1</head><figDesc>A river.</figDesc></figure><figure type="table"><head>Table 1</head><figDesc>Numbers.</figDesc></figure></body>
<back><listBibl><biblStruct><analytic><title level="a">Deep water</title><idno type="DOI">10.5555/abc</idno></analytic></biblStruct><biblStruct><analytic><title level="a">Wide water</title></analytic><note>see 10.5555/def.</note></biblStruct></listBibl></back></text></TEI>"""
DC = """<record xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title>A</dc:title><dc:title>B</dc:title><dc:creator>Lima, Ana</dc:creator><dc:description>N/A</dc:description><dc:description>Text</dc:description><dc:subject xml:lang="pt">rio</dc:subject><dc:subject xml:lang="en">river</dc:subject><dc:subject xml:lang="pt">mar</dc:subject><dc:publisher>none</dc:publisher><dc:identifier>10.1/x</dc:identifier></record>"""
JATS = """<article xml:lang="en"><front><article-meta><article-id pub-id-type="doi">10.7/j</article-id><title-group><article-title>Main</article-title><trans-title>Outra</trans-title></title-group><contrib-group><contrib contrib-type="author"><name><surname>Lima</surname><given-names>Ana</given-names></name></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib></contrib-group><abstract><p>Abs</p></abstract><kwd-group xml:lang="en"><kwd>k1</kwd><kwd>k2</kwd></kwd-group></article-meta></front><body><sec><title>Intro</title><fig><label>Fig 1</label><caption>Cap</caption></fig><disp-formula>x</disp-formula></sec></body><back><ref-list><ref><article-title>Ref one</article-title><pub-id pub-id-type="doi">10.8/r</pub-id></ref><ref><source>Book</source></ref></ref-list></back></article>"""
ALTO = """<alto><Styles><TextStyle ID="s1" FONTSIZE="10" FONTFAMILY="Times"/><TextStyle ID="s2" FONTSIZE="6" FONTSTYLE="superscript"/><TextStyle ID="b" FONTSIZE="14" FONTSTYLE="bold"/></Styles><Layout><Page WIDTH="600" HEIGHT="800">
<TextBlock ID="t2" HPOS="320" VPOS="50" WIDTH="200" HEIGHT="30"><TextLine HPOS="320" VPOS="50" WIDTH="200" HEIGHT="10"><String CONTENT="right" STYLEREFS="s1"/></TextLine></TextBlock>
<TextBlock ID="t1" HPOS="40" VPOS="90" WIDTH="200" HEIGHT="30"><TextLine HPOS="40" VPOS="90" WIDTH="200" HEIGHT="10"><String CONTENT="Heading" STYLEREFS="b"/></TextLine><TextLine HPOS="40" VPOS="105" WIDTH="200" HEIGHT="10"><String CONTENT="left" STYLEREFS="s1"/><String CONTENT="1" STYLEREFS="s2"/><String CONTENT="more" STYLEREFS="s1"/></TextLine><TextLine><String CONTENT=" "/></TextLine></TextBlock></Page></Layout></alto>"""


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "xml string").select(column(F.col("xml")).alias("r")).first()["r"]


def test_tei(spark):
    h = one(spark, xml.read_tei_header, TEI)
    assert (h["title"], h["authors"], h["keywords"], h["language"]) == ("On small rivers", ["Ana Lima"], ["rivers", "water"], "en") and h["abstract"].startswith("Rivers are small")
    c = one(spark, xml.read_tei_content, TEI)
    assert c["body_sections"] == ["Introduction", "Methods"] and c["figure_captions"] == ["Figure 1 A river."] and c["table_captions"] == ["Table 1 Numbers."]
    assert c["reference_dois"] == ["10.5555/abc", "10.5555/def"] and c["reference_titles"] == ["Deep water", "Wide water"] and c["formula_count"] == 1
    assert one(spark, xml.read_tei_abstracts, "<TEI><broken") == [] and one(spark, xml.read_tei_content, "<TEI><broken")["body_sections"] == []
    assert one(spark, xml.header_text, TEI).startswith("<teiHeader") and one(spark, xml.header_text, "no header") == "no header"


def test_gold_by_corpus(spark):
    df = spark.createDataFrame([("x_preprints", DC), ("other", JATS), ("other", "<broken"), ("other", None)], "corpus string, xml string")
    dc, jats, broken, none = (r["g"] for r in df.select(xml.read_gold(F.col("corpus"), F.col("xml")).alias("g")).collect())
    assert dc["titles"] == ["A", "B"] and dc["abstract"] == "Text" and dc["keywords_groups"] == {"pt": ["rio", "mar"], "en": ["river"]} and dc["publisher"] == ""
    assert jats["titles"] == ["Main", "Outra"] and jats["authors"] == ["Ana Lima"] and jats["identifiers"] == ["10.7/j"] and jats["keywords"] == ["k1", "k2"]
    assert jats["body_sections"] == ["Intro"] and jats["figure_captions"] == ["Fig 1 Cap"] and jats["formula_count"] == 1
    assert [tuple(r) for r in jats["reference_records"]] == [("10.8/r", "Ref one"), ("", "Book")]
    assert broken["title"] is None and none["title"] is None


def test_alto(spark):
    df = spark.createDataFrame([(1, ALTO), (2, "<alto/>"), (3, None), (4, "<x")], "record_id long, xml string")
    rows = xml.read_alto(df).orderBy("record_id", "pos").collect()
    assert [(r["record_id"], r["pos"], r["text"], r["block_col"]) for r in rows] == [(1, 0, "Heading", 0), (1, 1, "left more", 0), (1, 2, "right", 1)]
    assert rows[0]["bold"] and rows[0]["font_size"] == 14.0 and rows[0]["is_block_first_line"] and not rows[1]["bold"] and rows[1]["font_family"] == "times" and len(rows[1]["strings"]) == 3


def test_manifests(spark, tmp_path):
    d = str(tmp_path)
    sinks.write_manifest(spark.createDataFrame([("007", "a.pdf", "a.xml", "c")], "record_id string, pdf_path string, xml_path string, corpus string"), f"{d}/m")
    assert [tuple(r) for r in tables.manifest_csv(spark, f"{d}/m").collect()] == [("007", "a.pdf", "a.xml", "c")]
    spark.createDataFrame([(1, b"p", b"<a/>"), (None, b"p", b"<a/>"), (4, b"p", b"<a>\xff</a>"), (2, None, b"<a/>"), (3, b"p", None)], "id long, pdf binary, xml binary").write.parquet(f"{d}/p")
    assert sorted((r["record_id"], r["xml"]) for r in tables.manifest_parquet(spark, f"{d}/p").collect()) == [("1", "<a/>"), ("4", "<a></a>")]
    assert [r["record_id"] for r in tables.binary_files(spark, f"{d}/p", "part-*").collect()]


def test_runs_replace_only_themselves(spark, tmp_path):
    d, schema = str(tmp_path / "t"), "run_sha string, parser string, v int"
    sinks.upsert_run(spark.createDataFrame([("a", "p", 1), ("b", "p", 2)], schema), d)
    sinks.upsert_run(spark.createDataFrame([("a", "p", 3), ("a", "p", 4)], schema), d)
    assert sorted(r["v"] for r in spark.read.parquet(d).collect()) == [2, 3, 4]


def test_resumption_and_errors(spark):
    df = spark.createDataFrame([(1, "c", None), (2, "c", "Timeout: slow"), (3, None, None)], "record_id long, corpus string, error string")
    done, failed = sinks.split_errors(df)
    assert done.columns == ["record_id", "corpus"] and [r["record_id"] for r in failed.collect()] == [2]
    assert sorted(r["record_id"] for r in sinks.pending(df, done.where("record_id = 1"), ["record_id"]).collect()) == [2, 3]
    assert tuple(sinks.run_record(done, failed, mode="smoke").first()) == ("smoke", 2, 1)


def test_json_lines(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1}\n\n{"a": 2, "b": "z"}\n')
    assert sorted(tuple(r) for r in tables.json_lines(spark, str(p), "a long, b string").collect()) == [(1, None), (2, "z")]


def test_alto_with_the_columns_that_are_wanted(spark):
    df = spark.createDataFrame([(1, ALTO), (2, ALTO)], "record_id long, xml string")
    every, some = xml.read_alto(df), xml.read_alto(df, columns=["pos", "text", "bold"])
    assert some.columns == ["pos", "text", "bold", "record_id"] and "strings" in every.columns
    assert sorted(some.collect()) == sorted(every.select(some.columns).collect())
    assert [s["content"] for s in every.where("record_id = 2 and pos = 1").first()["strings"]] == ["left", "1", "more"]


def test_layout_xml_is_made_after_the_only_shuffle(spark, sf_dir):
    from folioforge.plans.catalogue_documents import _alto

    plan = _alto(spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    made = _alto(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CONTENT=" in plan and made.count("Exchange hashpartitioning") == 1


def test_readers_get_batches_of_bounded_bytes(spark):
    from folioforge.functions.udf import BATCH_BYTES, pandas_udf

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        size = pandas_udf("long")(lambda x: x.str.len().groupby(x.index * 0).transform("sum"))
        df = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("x"))
        assert df.select(xml.read_tei_header(F.concat(F.lit("<a>"), "x", F.lit("</a>")))).count() == 300
        assert int(spark.conf.get(name)) == BATCH_BYTES
        assert df.select(size(F.col("x")).alias("n")).agg(F.max("n")).first()[0] <= 2 * BATCH_BYTES
        spark.conf.set(name, "1234567")  # a session's own bound stays
        df.select(size(F.col("x")))
        assert spark.conf.get(name) == "1234567"
    finally:
        spark.conf.set(name, before)
