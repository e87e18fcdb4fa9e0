"""Readers and writers of the file formats of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The company master; arrays are '|'-lists in CSV.
COMPANY = T.StructType([T.StructField(c, T.StringType()) for c in (
    "company_id", "canonical_name", "isin", "cin", "nse_symbol", "bse_scrip", "aliases", "sector", "cap_band", "status",
    "alternate_isins", "series_type", "exchange", "cap_band_current")])


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """A company CSV with arrays split, empty texts as null and the two cap bands filling each other.

    The last row of a company wins, in the order of the file. Columns are found by name; a header that lacks one
    of COMPANY's raises.
    """
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in COMPANY.names if c not in raw.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    clean = raw.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in COMPANY.names], F.monotonically_increasing_id().alias("__n"))
    last = clean.filter("company_id is not null").groupBy("company_id").agg(F.max_by(F.struct(*COMPANY.names), "__n").alias("r"))
    split = lambda c: F.when(F.col(c).isNull(), F.array().cast("array<string>")).otherwise(F.split(c, r"\|"))
    return last.select("r.*").withColumns({
        "aliases": split("aliases"), "alternate_isins": split("alternate_isins"),
        "cap_band": F.coalesce("cap_band", "cap_band_current"), "cap_band_current": F.coalesce("cap_band_current", "cap_band"),
        "exchange": F.coalesce("exchange", F.when(F.col("nse_symbol").isNotNull() & F.col("bse_scrip").isNotNull(), "both")
                               .when(F.col("nse_symbol").isNotNull(), "nse").when(F.col("bse_scrip").isNotNull(), "bse")),
    })


def write_companies(companies: DataFrame, path: str) -> None:
    """The inverse of ``read_companies``."""
    flat = {c: F.array_join(c, "|") for c in ("aliases", "alternate_isins")}
    companies.withColumns(flat).select(*COMPANY.names).write.mode("overwrite").option("header", True).csv(path)


def read_manifest(spark: SparkSession, path: str, schema: T.StructType, key: list[str], order: str) -> DataFrame:
    """An append-only JSONL manifest: undecodable lines are skipped, the last row of each key stands."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rest = F.struct(*rows.columns)
    return rows.groupBy(*key).agg(F.max_by(rest, F.struct(order, F.xxhash64(rest))).alias("r")).select("r.*")


def append_manifest(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def snapshot(rows: DataFrame, path: str, by: list[str] | None = None) -> None:
    """A flat Parquet snapshot: nested columns become JSON text."""
    nested = [f.name for f in rows.schema if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    flat = rows.withColumns({c: F.to_json(c) for c in nested}) if nested else rows
    writer = flat.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def split_quarantine(rows: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantined) by a condition; a null condition keeps the row."""
    b = F.coalesce(bad, F.lit(False))
    return rows.filter(~b), rows.filter(b)


def read_split(rows: DataFrame, split_col: str, wanted: str, locked: str = "HOLDOUT", approved: bool = False) -> DataFrame:
    """The rows of one split, whatever its notation; asking for the locked one without approval is refused."""
    if wanted.strip().upper() == locked and not approved:
        raise PermissionError(f"the split {locked} is locked")
    return rows.filter(F.upper(F.trim(split_col)) == wanted.strip().upper())


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, length, content) of binary files, each content once, under its first path."""
    files = spark.read.format("binaryFile").load(path)
    own = files.select("path", F.sha2("content", 256).alias("sha256"), "length", "content")
    first = own.groupBy("sha256").agg(F.min("path").alias("path"))
    return own.join(first, ["sha256", "path"], "left_semi")


def html_links(pages: DataFrame, url_col: str = "url", html_col: str = "html", pattern: str = "(?i)annual") -> DataFrame:
    """(url, link_no, href, label, year): anchors of pages whose target or label matches, in order."""
    anchor = r"(?is)<a\s[^>]*?href\s*=\s*[\"']([^\"']+)[\"'][^>]*>(.*?)</a>"
    tags = F.posexplode(F.arrays_zip(
        F.regexp_extract_all(html_col, F.lit(anchor), F.lit(1)).alias("href"), F.regexp_extract_all(html_col, F.lit(anchor), F.lit(2)).alias("label")))
    rows = pages.select(url_col, tags.alias("link_no", "a")).select(url_col, "link_no", "a.href", F.trim(F.regexp_replace("a.label", "<[^>]+>", "")).alias("label"))
    year = F.expr("try_cast(nullif(regexp_extract(concat_ws(' ', label, href), '(20[0-2][0-9])', 1), '') AS int)")
    return rows.filter(F.col("href").rlike(pattern) | F.col("label").rlike(pattern)).withColumn("year", year)


def markdown_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(all columns but the text, row_no, cells): rows of pipe tables, without their ruling lines."""
    lines = F.posexplode(F.split(text_col, "\r?\n")).alias("row_no", "line")
    rows = docs.select(*[c for c in docs.columns if c != text_col], lines).filter(F.col("line").rlike(r"^\s*\|.*\|\s*$") & ~F.col("line").rlike(r"^[\s|:\-]+$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"\|"), lambda c: F.trim(c))
    return rows.select(*[c for c in docs.columns if c != text_col], "row_no", cells.alias("cells"))
