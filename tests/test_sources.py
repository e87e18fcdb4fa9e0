"""Readers, writers, adapters and streams."""

import io
import zipfile

import pytest
from foliant.sources import adapters, files
from foliant.streaming import events
from pyspark.sql import functions as F
from pyspark.sql import types as T


def test_companies_round_trip(spark, tmp_path):
    csv = tmp_path / "c.csv"
    head = ",".join(files.COMPANY.names)
    csv.write_text(f"{head}\nA1,Alpha Ltd,A1,,ALP,,x|y,,large,active,,ordinary,,\nA1,Alpha Limited,A1,,ALP,1,x,,large,active,,ordinary,,\n,none,,,,,,,,,,,,\n")
    got = files.read_companies(spark, str(csv)).collect()
    assert len(got) == 1 and got[0].canonical_name == "Alpha Limited" and got[0].aliases == ["x"]
    assert got[0].cap_band_current == "large" and got[0].exchange == "both" and got[0].alternate_isins == []
    files.write_companies(files.read_companies(spark, str(csv)), str(tmp_path / "out"))
    assert files.read_companies(spark, str(tmp_path / "out")).collect()[0].aliases == ["x"]
    (tmp_path / "bad.csv").write_text("company_id\nA\n")
    with pytest.raises(ValueError, match="columns missing"):
        files.read_companies(spark, str(tmp_path / "bad.csv"))


def test_manifest(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"k":1,"n":1,"v":"a"}\nnot json\n{"k":1,"n":2,"v":"b"}\n{"k":2,"n":1,"v":"c"}\n')
    schema = T.StructType.fromDDL("k int, n int, v string")
    got = sorted((r.k, r.v) for r in files.read_manifest(spark, str(tmp_path / "m.jsonl"), schema, ["k"], "n").filter("k is not null").collect())
    assert got == [(1, "b"), (2, "c")]


def test_snapshot_quarantine_locked(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a"], "FIT"), (2, [], " holdout "), (3, None, None)], "i int, a array<string>, split string")
    files.snapshot(df, str(tmp_path / "s"))
    assert dict(spark.read.parquet(str(tmp_path / "s")).dtypes)["a"] == "string"
    kept, bad = files.split_quarantine(df, F.col("split") == "FIT")
    assert (kept.count(), bad.count()) == (2, 1)
    assert files.read_split(df, "split", "FIT").count() == 1 and files.read_split(df, "split", "HOLDOUT", approved=True).count() == 1
    with pytest.raises(PermissionError):
        files.read_split(df, "split", " holdout")


def test_html_and_markdown(spark):
    html = '<a href="/ar/2019.pdf">Annual <b>Report</b></a> <a href="/x">other</a>'
    got = files.html_links(spark.createDataFrame([("u", html), ("v", None)], "url string, html string")).collect()
    assert [(r.href, r.label, r.year) for r in got] == [("/ar/2019.pdf", "Annual Report", 2019)]
    md = "| a | b |\n|---|---|\n| 1 | 2 |\ntext"
    rows = files.markdown_rows(spark.createDataFrame([(1, md)], "id int, text string")).collect()
    assert [r.cells for r in rows] == [["a", "b"], ["1", "2"]]


def test_adapters(spark):
    def fetch(url):
        if "bad" in url:
            raise OSError("refused")
        return url.encode()

    refs = spark.createDataFrame([("http://a/1",), ("http://a/bad",), ("http://b/2",)], "url string")
    got = {r.url: r for r in adapters.fetch_documents(refs, fetch, attempts=2, pause=0.0).collect()}
    assert bytes(got["http://a/1"].content) == b"http://a/1" and got["http://a/bad"].attempts == 2 and "refused" in got["http://a/bad"].error
    weak, strong = (lambda i, lang: ("weak", 0.4)), (lambda i, lang: ("strong", 0.9))
    pages = spark.createDataFrame([("d", 0, bytearray(b"x"), "eng")], "document_id string, page_no int, image binary, language string")
    assert adapters.recognise_pages(pages, [("w", weak), ("s", strong)], 0.8).first().text == "strong"
    told = {"a": 'so {"start_page": 3, "end_page": 99, "heading": "MD&A", "confidence": 0.5}', "b": '{"start_page": -1}', "c": "no"}
    judged = {r.document_id: r for r in adapters.adjudicate(spark.createDataFrame([(k, k) for k in told], "document_id string, prompt string"), told.get).collect()}
    assert (judged["a"].start_page, judged["a"].end_page, judged["a"].score) == (3, 62, 0.45) and judged["b"].start_page is judged["b"].error is None and "ValueError" in judged["c"].error
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.pdf", "1"), z.writestr("b.pdf", "22"), z.writestr("c.txt", "333")
    zipped = spark.createDataFrame([("p", bytearray(buf.getvalue())), ("q", bytearray(b"no zip"))], "path string, content binary")
    assert {r.path: r.name for r in adapters.unzip_largest(zipped).collect()} == {"p": "b.pdf", "q": None}


def test_stream_drops_late_and_repeated(spark, tmp_path):
    at = lambda m: f"timestamp'2024-01-01 00:00:00' + interval {m} minutes"
    folder = tmp_path / "events.parquet"
    for k, rows in enumerate(([(1, 0), (2, 5), (2, 5)], [(3, 60)], [(4, 1), (5, 61)])):
        sql = " UNION ALL ".join(f"SELECT {i}L AS event_id, {at(m)} AS ts" for i, m in rows)
        spark.sql(sql).coalesce(1).write.mode("append").parquet(str(folder))
    stream = events.read_events(spark, str(tmp_path), files_per_batch=1)
    got = sorted(r.event_id for r in events.drain(events.first_deliveries(stream)).collect())
    assert [x for x in got if x != 4] == [1, 2, 3, 5] and got.count(2) == 1


def test_upserts_keep_the_latest(spark, tmp_path):
    folder = tmp_path / "events.parquet"
    for rows in ([(1, 0, "a"), (2, 5, "b")], [(1, 9, "c"), (3, 1, "d")], [(2, 1, "old"), (None, 1, "n")]):
        sql = " UNION ALL ".join(f"SELECT {'NULL' if i is None else i} AS k, timestamp'2024-01-01' + interval {m} minutes AS ts, '{v}' AS v" for i, m, v in rows)
        spark.sql(sql).selectExpr("cast(k as long) k", "ts", "v").coalesce(1).write.mode("append").parquet(str(folder))
    stream = events.read_events(spark, str(tmp_path), files_per_batch=1)
    got = {(r.k, r.v) for r in events.upsert_latest(stream, "k", ["ts"]).collect()}
    assert got == {(1, "c"), (2, "b"), (3, "d"), (None, "n")}


def test_batch_equals_stream(spark, data):
    from foliant.plans import catalogue

    a, b = (sorted(map(tuple, catalogue.QUERIES[n](spark, data).collect())) for n in ("failure_windows", "stream_failure_windows"))
    assert a == b
