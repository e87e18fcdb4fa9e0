"""Identity, years, eras, reasons and grades on literal cases and against brute force."""

import random

from foliant.functions import similarity as M
from foliant.functions import verdict as V
from foliant.operators import chains
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F


def one(spark, column_of, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("x"))).collect()]


def test_years(spark):
    got = one(spark, V.year_votes, "for 2014-15 and 2014-2016, year ended 31st March, 2015, as at 31 March 2015, FY 2016", "year ended 30th June 2014", "1999-00", None, "")
    assert [(v.year, v.weight) for v in got[0]] == [(2015, 3), (2015, 5), (2015, 2), (2016, 2)]
    assert [(v.year, v.weight) for v in got[1]] == [(2014, 1)] and [v.year for v in got[2]] == [2000] and not got[3] and got[4] == []


def test_tail_and_leaks(spark):
    long = "Cautionary statement first\n" + "line\n" * 20
    assert one(spark, V.tail_is_cautionary, "text\nforward-looking statements", long, "", "actual\nresults may differ") == [True, False, False, True]
    assert one(spark, V.leaks, "Basis for Opinion and we have audited the accompanying", "notice is hereby\ngiven that", "none") == [["auditor_report_leak"], ["agm_notice_leak"], []]


def test_series_and_producers(spark):
    rows = [("IN9155A01020", "TATAMTRDVR", "T"), ("INE1", "X-RE", "Y"), ("INE1", "X", "Y partly paid"), ("INE1", "X", None), ("US1", None, None), (None, None, "Z DVR")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in df.select(V.series_type(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["dvr", "partly_paid", "partly_paid", "ordinary", "other", "dvr"]
    assert one(spark, V.is_reprocessor, "iLovePDF 2", "Acrobat", None) == [True, False, False]


CASE = dict(company_ok=True, year_ok=True, weight=20, leak=0, words=900, share=0.0, orphans=0, producer="x", cautious=True, long_share=0.0, notes=0, score=85, supporters=2)


def verdicts(spark, **change):
    c = {k: F.lit(v) for k, v in {**CASE, **change}.items()}
    reasons = V.reasons(*[c[k] for k in ("company_ok", "year_ok", "weight", "leak", "words", "share", "orphans", "producer", "cautious")])
    grade = V.grade(*[c[k] for k in ("company_ok", "year_ok", "words", "long_share", "share", "orphans", "leak", "notes", "score", "supporters", "producer")])
    r = spark.range(1).select(reasons, grade).first()
    return list(r[0]), r[1]


def test_reasons_and_grades(spark):
    assert verdicts(spark) == ([], "high")
    assert verdicts(spark, producer="Smallpdf") == (["source_shredded"], "medium")
    assert verdicts(spark, company_ok=False, leak=1) == (["identity_unproven", "section_leak"], "low")
    assert verdicts(spark, weight=3, cautious=False) == (["year_unproven", "span_truncated"], "high")
    assert verdicts(spark, share=0.05, orphans=3) == (["order_scrambled"], "medium") and verdicts(spark, share=0.05, orphans=1) == ([], "high")
    assert verdicts(spark, share=0.07, orphans=3)[1] == "low" and verdicts(spark, words=10) == (["too_short"], "low")
    assert verdicts(spark, supporters=1, leak=1)[1] == "medium" and verdicts(spark, supporters=0, score=70)[1] == "medium" and verdicts(spark, supporters=0, score=69)[1] == "low"
    assert verdicts(spark, year_ok=False) == (["year_unproven"], "low")


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", max_size=10), st.text("abc ", max_size=10))
def test_likeness(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert M.common(a, b) == table[-1][-1]
    assert M.token_set(a, b) == M.token_set(b, a) and 0 <= M.partial(a, b) <= 100


def test_name_likeness(spark):
    assert M.token_set("alpha beta", "beta alpha gamma") == 100.0 and M.partial("alpha", "the alpha works") == 100.0
    df = spark.createDataFrame([("alpha foods", ["beta", "alpha food"]), ("", ["x"]), ("y", None)], "a string, b array<string>")
    got = [tuple(r[0]) for r in df.select(M.name_likeness(F.col("a"), F.col("b"))).collect()]
    assert got[0][1] == "alpha food" and got[0][0] > 90 and got[1:] == [(0.0, None), (0.0, None)]


def test_chains(spark):
    rng = random.Random(5)
    edges = {f"s{i}": f"s{rng.randrange(60)}" for i in range(50)} | {"a": "b", "b": "c", "c": "a", "x": None, "q": "q"}
    want = {}
    for old in edges:
        cur, seen = old, [old]
        while edges.get(cur) and edges[cur] != cur and edges[cur] not in seen:
            cur = edges[cur]
            seen.append(cur)
        if cur != old:
            want[old] = (cur, len(seen) - 1)
    df = spark.createDataFrame(list(edges.items()), "o string, n string")
    assert {r.o: (r["last"], r.hops) for r in chains.follow(df, "o", "n").collect()} == want
    assert chains.follow(df.limit(0), "o", "n").count() == 0
