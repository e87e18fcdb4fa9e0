"""Sections, their boundaries and the arbiter on small literal reports."""

from foliant.operators import sections as S
from foliant.plans import sections as Q
from pyspark.sql import functions as F

BODY = "\n".join(["Industry Structure and Developments", "Outlook", "Risks and Concerns", "Cautionary Statement"] + ["the company sold more of its goods this year " * 4] * 4)


def pages(spark, texts, doc="d"):
    rows = [(doc, k, t) for k, t in enumerate(texts)]
    return S.page_features(spark.createDataFrame(rows, "document_id string, page_no int, text string"), ["document_id", "page_no"])


def terms(spark, text):
    return [(t.line_index, t.text, t.font_signal) for t in pages(spark, [text]).first().terms]


def test_terminator_shape(spark):
    assert terms(spark, "REPORT ON CORPORATE GOVERNANCE\nThe company believes in it.") == [(0, "REPORT ON CORPORATE GOVERNANCE", "all_caps")]
    assert terms(spark, "x\n" * 30 + "\nAnnexure VI\nmore") == [(31, "Annexure VI", "title_case")]
    for line in (
        "details are given in the Corporate Governance Report", "Corporate Governance Report,", "The Directors Report was read out to all of the members.",
        "Our Great Big Old Company Corporate Governance Report", "Corporate Governance Report " + "x" * 80, "the directors report",
    ):
        assert terms(spark, line) == [], line
    assert terms(spark, "x\n" * 30 + "Corporate Governance Report\nmore") == []
    assert terms(spark, "Notice of the 12th Annual General Meeting") and terms(spark, None) == [] and terms(spark, "") == []


def test_pointers_and_titles(spark):
    df = spark.createDataFrame([(x,) for x in (
        "The Management Discussion and Analysis Report is enclosed", "The analysis is given below", "The analysis is given in Annexure A", "MD&A", "Managements' outlook",
        "Directors' Report and Management Discussion", "MANAGEMENT'S DISCUSSION & ANALYSIS")], "x string")
    got = [tuple(r) for r in df.select(S.is_pointer(F.col("x")), S.is_section_title(F.col("x"))).collect()]
    assert got == [(True, True), (False, False), (True, False), (False, True), (False, False), (False, True), (False, True)]


def test_text_heading_and_end(spark):
    texts = ["cover", "contents", "Letter\nto members", "Management Discussion\nand Analysis\n" + BODY, BODY, "Corporate Governance Report\n" + "words " * 50, "last"]
    got = S.locate_text_heading(pages(spark, texts)).collect()
    assert [(r.start_page, r.end_page, r.score, r.terminator) for r in got] == [(3, 4, 60, "Corporate Governance Report")]
    running = ["", "", "Directors' Report\nManagement Discussion and Analysis\n" + BODY, "Directors' Report\n" + BODY, BODY]
    assert [(r.start_page, r.end_page, r.terminator) for r in S.locate_text_heading(pages(spark, running)).collect()] == [(2, 4, None)]
    pointer = ["", "", "Management Discussion and Analysis\nThe report is annexed herewith."]
    assert S.locate_text_heading(pages(spark, pointer)).count() == 0 and S.locate_text_heading(pages(spark, [])).count() == 0


def test_body_run_stops(spark):
    empty = "nothing to see here"
    texts = [empty, BODY, empty, BODY, *[empty] * 20, BODY]
    got = S.locate_body(pages(spark, texts)).collect()
    assert [(r.start_page, r.end_page) for r in got] == [(1, 3)]
    assert S.locate_body(pages(spark, [empty] * 3)).count() == 0


def test_outline_walks(spark):
    prose = BODY + "\n" + "words of the report go on and on " * 30
    p = pages(spark, ["a", "title only", "picture", prose, prose, "end"])
    entries = spark.createDataFrame([("d", "Management Discussion and Analysis", 1), ("d", "Notes", 5), ("d", "Notes", 1)], "document_id string, title string, page_no int")
    size = spark.createDataFrame([("d", 6)], "document_id string, n_pages int")
    got = S.locate_outline(entries, p, size).first()
    assert (got.proposed, got.start_page, got.end_page, got.score, got.walked, got.outcome) == (1, 3, 4, 90, 2, "accepted_with_walk")
    got = S.locate_outline(entries, p.filter("page_no < 3"), size).first()
    assert got.start_page is None and got.outcome == "invalidated"


def test_contents_and_offset(spark):
    toc = "Contents\nChairman Letter ....... 2\nManagement Discussion and Analysis .... 4\nCorporate Governance ..... 6\nprose that ends in 12"
    texts = ["cover", toc, *[f"text\n{k}" for k in range(1, 9)]]
    p = pages(spark, texts)
    size = spark.createDataFrame([("d", 10)], "document_id string, n_pages int")
    got = S.locate_contents(p, size).first()
    assert (got.start_page, got.end_page, got.score, got["offset"]) == (5, 6, 80, 1)
    got = S.locate_contents(pages(spark, texts[:3]), size).first()
    assert got["offset"] == 1 and got.score == 15


def test_arbiter_and_refinement(spark):
    p = pages(spark, [BODY] * 5 + ["x", "Corporate Governance Report"])
    rows = [("d", 0, "outline", 1, 3, 95), ("d", 1, "contents", 3, 4, 80), ("d", 2, "heading", 4, 4, 78), ("e", 0, "outline", 0, 1, 50)]
    c = spark.createDataFrame(rows, "document_id string, ord int, method string, start_page int, end_page int, score int")
    got = {r.document_id: r for r in S.arbiter(c, p).collect()}
    assert (got["d"].method, got["d"].supporters, got["d"].score) == ("outline", 1, 99.0) and (got["e"].words, got["e"].score) == (0, 25.0)
    spans = spark.createDataFrame([("d", 1, 2), ("d", 0, 5)], "document_id string, start_page int, end_page int")
    assert {(r.start_page, r.refined_end) for r in S.refine_end(spans, p).collect()} == {(1, 4), (0, 5)}


def test_texts_are_not_shuffled(spark, data):
    from foliant.plans import catalogue

    for name in ("paragraph_reconstruction", "table_runs", "degenerate_line_runs", "order_quality_doc", "terminator_lines"):
        plan = catalogue.QUERIES[name](spark, data)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan, name
    assert Q.section_arbiter(spark, data).columns[0] == "document_id"


def test_typographic_heading(spark):
    texts = ["cover", "x", "Management Discussion\nand Analysis\n" + BODY, BODY, "Corporate Governance Report"]
    rows = [("d", 2, 0.1, "Management", 20.0, True), ("d", 2, 0.14, "Discussion & Analysis", 20.0, True)]
    rows += [("d", 2, 0.2 + k / 100, "body text", 10.0, False) for k in range(9)] + [("d", 3, 0.5, "MANAGEMENT DISCUSSION AND ANALYSIS", 10.0, None), ("d", 3, 0.6, " ", 9.0, None)]
    lines = spark.createDataFrame(rows, "document_id string, page_no int, y double, text string, size double, bold boolean")
    got = S.locate_typographic(lines, pages(spark, texts)).collect()
    assert [(r.start_page, r.end_page, r.score, r.heading) for r in got] == [(2, 3, 92, "Management Discussion & Analysis")]
    assert S.locate_typographic(lines.limit(0), pages(spark, texts)).count() == 0


def test_prose_without_tables(spark):
    text = "Alpha Ltd 12\nThe com-\npany grew.\n1 2 3\n4 5\n6,7 %\nAfter 9\n\n10 11\nend"
    df = spark.createDataFrame([(text,), (None,)], "t string")
    got = [tuple(r[0]) for r in df.select(S.prose_of(F.col("t"), F.array(F.lit("alpha ltd")))).collect()]
    assert got == [("The company\n grew.\nAfter 9\n10 11\nend", 3), ("", 0)]
