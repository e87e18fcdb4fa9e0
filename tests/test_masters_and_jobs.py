"""Masters of the exchanges, stored answers and the jobs."""

import json

import pytest
from foliant import jobs
from foliant.plans import catalogue
from foliant.sources import masters


def test_masters(spark, tmp_path):
    (tmp_path / "nse.csv").write_text(" symbol ,NAME OF COMPANY, ISIN NUMBER\nOLD,Old Name,I1\nALP,Alpha Ltd, I1 \nNIL,None,\n")
    nse = masters.read_nse_master(spark, str(tmp_path / "nse.csv"))
    assert [(r.isin, r.symbol, r.name_of_company) for r in nse.collect()] == [("I1", "ALP", "Alpha Ltd")]
    rows = [{"ISIN_NUMBER": "I1", "Issuer_Name": "Alpha Limited", "Scrip_Name": "ALPHA", "scrip_id": "ALPHA1", "SCRIP_CD": "500"},
            {"ISIN": "I2", "SCRIP_NAME": "Beta", "Scrip_Code": "501", "Status": "Delisted", "INDUSTRY": "Steel"}, {"ISIN": " ", "Scrip_Name": "none"}]
    (tmp_path / "bse.json").write_text(json.dumps(rows))
    bse = masters.read_bse_master(spark, str(tmp_path / "bse.json"))
    got = {r.isin: (r.name, r.bse_scrip, r.status, r.aliases) for r in bse.collect()}
    assert got == {"I1": ("Alpha Limited", "500", "Active", ["ALPHA", "ALPHA1"]), "I2": ("Beta", "501", "Delisted", [])}
    (tmp_path / "s.csv").write_text("Company,SM_KEY_SYMBOL Old,New,Date\nA,AA,BB,1\nA,BB,ALP,2\nC,X,Y,1\nC,Y,X,2\n")
    older = masters.read_symbol_changes(spark, str(tmp_path / "s.csv"))
    assert {r.symbol: r.older for r in older.collect()} == {"ALP": ["AA", "BB"], "Y": ["X"], "X": ["Y"]}
    large, mid = (spark.createDataFrame([(x,) for x in xs], "isin string") for xs in (("I1", "I2"), ("I2", None)))
    bands = masters.cap_bands([("large", large), ("mid", mid)])
    assert {tuple(r) for r in bands.collect()} == {("I1", "large"), ("I2", "mid")}
    full = {r.company_id: r for r in masters.merge_masters(nse, bse, older, bands).collect()}
    assert full["I1"].exchange == "both" and full["I1"].aliases == "ALPHA|ALPHA1|AA|BB" and full["I1"].cap_band == "large"
    assert full["I2"].exchange == "bse" and full["I2"].canonical_name == "Beta" and full["I2"].status == "delisted"


def test_filings(spark):
    companies = spark.createDataFrame([("C", "ALP", "AA|Alpha")], "company_id string, nse_symbol string, aliases string")
    rows = [("nse", "C", 0, "2018", "2019", "http://h/AR_ALP_2018_2019_1.pdf", None), ("nse", "C", 1, "2018", "2019", "http://h/AR_AA_2018_2019_2.pdf", None),
            ("nse", "C", 2, "2019", "2020", "http://h/AR_XYZ_2019_2020_1.pdf", None), ("nse", "C", 3, "2020", "2021", "http://h/AR_ALP_2019_2020_1.pdf", None),
            ("bse", "C", 4, None, None, "http://b/1.pdf", "Annual Report 2019"), ("bse", "C", 5, None, None, "http://b/2.pdf", "Annual Report 2022"), ("bse", "D", 6, None, None, "u", "2020")]
    answers = spark.createDataFrame(rows, "service string, company_id string, ord int, from_year string, to_year string, url string, label string")
    got = {(r.fy_end, r.url, r.priority) for r in masters.filings(answers, companies).collect()}
    assert got == {(2019, "http://h/AR_ALP_2018_2019_1.pdf", 10), (2022, "http://b/2.pdf", 20)}


def test_jobs(spark, data, tmp_path, capsys):
    assert {q for names in jobs.JOBS.values() for q in names} <= set(catalogue.QUERIES)
    assert jobs.preflight(spark, data) == [] and len(jobs.preflight(spark, str(tmp_path))) == len(jobs.TABLES)
    assert jobs.run(spark, "fetch", data, str(tmp_path)) == list(jobs.JOBS["fetch"])
    assert jobs.run(spark, "fetch", data, str(tmp_path)) == [] and jobs.run(spark, "storage_path", data, str(tmp_path), again=True) == ["storage_path"]
    assert spark.read.parquet(str(tmp_path / "latest_delivery")).count() > 0
    with pytest.raises(ValueError, match="no such job"):
        jobs.run(spark, "nothing", data, str(tmp_path))
    assert jobs.main(["nothing", "--tables", data, "--out", str(tmp_path)]) == 2
    assert jobs.main(["preflight", "--tables", data]) == 0 and "ready" in capsys.readouterr().out
