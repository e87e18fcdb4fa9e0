"""Company masters and stored answers of filing services, read into tables."""

from __future__ import annotations

from functools import reduce

from foliant.operators.chains import follow
from foliant.sources.files import COMPANY
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys under which a security's fields come, by priority.
BSE_KEYS = {
    "isin": ("ISIN_NUMBER", "ISIN"), "issuer": ("Issuer_Name",), "scrip_name": ("Scrip_Name", "SCRIP_NAME"), "scrip_id": ("scrip_id",),
    "bse_scrip": ("SCRIP_CD", "Scrip_Code"), "group": ("GROUP",), "status": ("Status",), "industry": ("Industry", "INDUSTRY"),
}


def _text(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def read_nse_master(spark: SparkSession, path: str) -> DataFrame:
    """An equity list as CSV, header names trimmed and in capitals; of the rows of one ISIN the last stands, blank ISINs are left out."""
    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(*[_text(F.col(f"`{c}`")).alias(c.strip().upper()) for c in raw.columns], F.monotonically_increasing_id().alias("__n"))
    names = [c for c in rows.columns if c != "__n"]
    if "ISIN NUMBER" not in names:
        raise ValueError("columns missing: ISIN NUMBER")
    own = rows.filter("`ISIN NUMBER` is not null").groupBy("`ISIN NUMBER`").agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in names]), "__n").alias("r"))
    return own.select(F.col("ISIN NUMBER").alias("isin"), *[F.col(f"r.`{c}`").alias(c.lower().replace(" ", "_")) for c in names if c != "ISIN NUMBER"])


def read_bse_master(spark: SparkSession, path: str) -> DataFrame:
    """(isin, bse_scrip, name, group, status, industry, aliases) of a JSON list whose fields come under alternative keys.

    The issuer's name stands before the security's, which is then an alias like its short id.
    Missing status is Active; rows without ISIN are left out, of the rows of one the last stands.
    """
    # Keys differ in case only, so each row is a map and not a struct.
    whole = spark.read.option("wholetext", True).text(path)
    rows = whole.select(F.posexplode(F.from_json("value", "array<map<string,string>>")).alias("__n", "m"))
    first = {n: F.coalesce(*[_text(F.try_element_at("m", F.lit(k))) for k in ks]) for n, ks in BSE_KEYS.items()}
    own = rows.select(*[c.alias(n) for n, c in first.items()], "__n").filter("isin is not null")
    last = own.groupBy("isin").agg(F.max_by(F.struct(*[c for c in own.columns if c not in ("isin", "__n")]), "__n").alias("r")).select("isin", "r.*")
    alias = F.when(F.col("issuer").isNotNull() & (F.col("issuer") != F.col("scrip_name")), F.col("scrip_name"))
    return last.select(
        "isin", "bse_scrip", F.coalesce("issuer", "scrip_name").alias("name"), "group", F.coalesce("status", F.lit("Active")).alias("status"), "industry",
        F.array_compact(F.array(alias, F.col("scrip_id"))).alias("aliases"),
    )


def read_symbol_changes(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, older array) of a list of (name, old, new, date): every older symbol of a present one, through all its changes.

    A header line is known by a second field that is no symbol; of several changes of one symbol the
    last in the file counts.
    """
    raw = spark.read.schema("name string, old string, new string, date string").csv(path)
    rows = raw.select(_text("old").alias("old"), _text("new").alias("new"), F.monotonically_increasing_id().alias("n"))
    edges = rows.filter("old rlike '^[A-Z0-9&-]+$' and new is not null").groupBy("old").agg(F.max_by("new", "n").alias("new"))
    return follow(edges, "old", "new").groupBy(F.col("last").alias("symbol")).agg(F.array_sort(F.collect_list("old")).alias("older"))


def cap_bands(lists: list[tuple[str, DataFrame]]) -> DataFrame:
    """(isin, cap_band) of several lists of ISINs, one per band; a later list stands before an earlier one."""
    every = reduce(DataFrame.unionByName, [df.select(_text("isin").alias("isin"), F.lit(k).alias("k"), F.lit(band).alias("band")) for k, (band, df) in enumerate(lists)])
    return every.filter("isin is not null").groupBy("isin").agg(F.max_by("band", "k").alias("cap_band"))


def merge_masters(nse: DataFrame, bse: DataFrame, older: DataFrame, bands: DataFrame) -> DataFrame:
    """The company master of both exchanges' lists (``COMPANY`` columns): an outer join on the ISIN, with older symbols and bands."""
    both = nse.select("isin", F.col("symbol"), F.col("name_of_company").alias("n")).join(bse, "isin", "full")
    full = both.join(older, "symbol", "left").join(bands, "isin", "left")
    exchange = F.when(F.col("symbol").isNotNull() & F.col("bse_scrip").isNotNull(), "both").when(F.col("symbol").isNotNull(), "nse").otherwise("bse")
    none = F.lit(None).cast("string")
    made = {
        "company_id": F.col("isin"), "canonical_name": F.coalesce("n", "name"), "isin": F.col("isin"), "nse_symbol": F.col("symbol"), "bse_scrip": F.col("bse_scrip"),
        "aliases": F.array_join(F.array_distinct(F.concat(F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("older", F.array().cast("array<string>")))), "|"),
        "sector": F.col("industry"), "status": F.lower(F.coalesce("status", F.lit("active"))), "cap_band": F.col("cap_band"), "cap_band_current": F.col("cap_band"), "exchange": exchange,
    }
    return full.select(*[made.get(c, none).alias(c) for c in COMPANY.names])


def filings(answers: DataFrame, companies: DataFrame) -> DataFrame:
    """(company_id, fy_end, url, priority): report files named by stored answers of filing services, one per company and year.

    ``answers`` are (service nse or bse, company_id, ord, from_year, to_year, url, label). A file whose
    name tells another symbol than the company's, now or before, or other years than the answer, is
    rejected. An answer without years takes the year of its label. The first answer of a year stands.
    """
    name = F.upper(F.element_at(F.split("url", "/"), -1))
    told = F.regexp_extract(name, r"^(?:AR_)?(?:[0-9]+_)?([A-Z0-9&-]+)_([0-9]{4})_([0-9]{4})_", 1)
    years = [F.expr(f"try_cast(regexp_extract(upper(element_at(split(url, '/'), -1)), '_([0-9]{{4}})_([0-9]{{4}})_', {k}) AS int)") for k in (1, 2)]
    symbols = companies.select("company_id", F.array_union(F.array(F.upper("nse_symbol")), F.split(F.upper(F.coalesce("aliases", F.lit(""))), r"\|")).alias("symbols"))
    own = answers.join(symbols, "company_id").withColumn("fy_end", F.coalesce(
        F.expr("try_cast(to_year AS int)"), F.expr("try_cast(nullif(regexp_extract(label, '(20[0-9]{2})', 1), '') AS int)")))
    other = ((told != "") & ~F.array_contains("symbols", told)) | (years[1].isNotNull() & (years[1] != F.col("fy_end")))
    kept = own.filter(F.col("fy_end").isNotNull() & ~F.coalesce(other, F.lit(False))).withColumn("priority", F.when(F.col("service") == "nse", 10).otherwise(20))
    best = F.min(F.struct("priority", "ord", "url")).alias("b")
    return kept.groupBy("company_id", "fy_end").agg(best).select("company_id", "fy_end", "b.url", "b.priority")
