"""Coverage of the company by year panel: funnel, losses, sources, resumption."""

from __future__ import annotations

from foliant.functions.text import era3
from foliant.session import table
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STAGES = ("expected", "discovered", "stored", "profiled", "located", "accepted")
YEARS = (2010, 2025)
_FIELDS = ("company_id", "fiscal_year", "sha256", "page_count", "producer", "split", "source_locator", "ingested_at")
GOOD_HASH = "^[0-9a-f]{64}$"


def _hash(c):
    return F.lower(F.trim(c))


def panel(companies: DataFrame) -> DataFrame:
    """Every company in every expected year, with its strata."""
    own = companies.groupBy("company_id").agg(
        F.max(F.coalesce("cap_band_current", "cap_band", F.lit("unknown"))).alias("cap_band"),
        F.max(F.coalesce("exchange", F.lit("unknown"))).alias("exchange"),
    )
    years = F.explode(F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1])))
    return own.select("*", years.alias("fy")).withColumn("era", era3(F.col("fy")))


def stage_table(spark, d) -> DataFrame:
    """One row per expected company-year: did it reach each stage, and where it failed first.

    The sides are reduced to one row per document or company-year before they are joined, so no
    join multiplies rows; stages are not nested and are reported as they are.
    """
    companies, records, census, raw = (table(spark, d, n) for n in ("cohort_companies", "doc_records", "page_census", "raw_records"))
    profiled = census.groupBy("document_id").agg(F.lit(True).alias("has_pages"))
    located = (
        raw.groupBy("document_id").agg(F.bool_or(F.upper(F.trim("presence_state")) == "PRESENT").alias("is_located"))
    )
    docs = records.groupBy("document_id", "company_id", "fiscal_year").agg(
        F.bool_or(_hash(F.col("sha256")).rlike(GOOD_HASH)).alias("is_stored"),
        F.bool_or(F.coalesce("sha256_verified", F.lit(False)) & F.col("split").isNotNull()).alias("is_accepted"),
    )
    reached = (
        docs.join(profiled, "document_id", "left")
        .join(located, "document_id", "left")
        .groupBy("company_id", F.col("fiscal_year").alias("fy"))
        .agg(
            F.lit(True).alias("discovered"),
            F.bool_or(F.coalesce("is_stored", F.lit(False))).alias("stored"),
            F.bool_or(F.coalesce("has_pages", F.lit(False))).alias("profiled"),
            F.bool_or(F.coalesce("is_located", F.lit(False))).alias("located"),
            F.bool_or(F.coalesce("is_accepted", F.lit(False))).alias("accepted"),
        )
    )
    out = panel(companies).join(reached, ["company_id", "fy"], "left")
    out = out.withColumn("expected", F.lit(True)).fillna(False, subset=list(STAGES[1:]))
    first = F.coalesce(*[F.when(~F.col(s), F.lit(s)) for s in STAGES[1:]])
    reason = (
        F.when(F.col("first_failed") == "discovered", F.when(F.col("fy") < 2013, "before_archive").otherwise("no_filing"))
        .when(F.col("first_failed") == "stored", "bad_hash")
        .when(F.col("first_failed") == "located", F.when(F.col("profiled"), "no_section"))
        .when(F.col("first_failed") == "accepted", "unverified")
    )
    return out.withColumn("first_failed", first).withColumn("reason", reason)


_BASE = """
WITH own AS (SELECT company_id, max(coalesce(cap_band_current, cap_band, 'unknown')) AS cap_band,
    max(coalesce(exchange, 'unknown')) AS exchange FROM cohort_companies GROUP BY 1),
panel AS (SELECT company_id, cap_band, exchange, CAST(fy AS INT) AS fy,
    CASE WHEN fy < 2014 THEN '2010-2013' WHEN fy < 2019 THEN '2014-2018' ELSE '2019-2025' END AS era
    FROM own, range(2010, 2026) t(fy)),
docs AS (SELECT document_id, company_id, fiscal_year, bool_or(regexp_matches(lower(trim(sha256)), '^[0-9a-f]{64}$')) AS is_stored,
    bool_or(coalesce(sha256_verified, false) AND split IS NOT NULL) AS is_accepted FROM doc_records GROUP BY ALL),
loc AS (SELECT document_id, bool_or(upper(trim(presence_state)) = 'PRESENT') AS is_located FROM raw_records GROUP BY 1),
pro AS (SELECT DISTINCT document_id FROM page_census),
reached AS (SELECT company_id, fiscal_year AS fy, true AS discovered, bool_or(coalesce(is_stored, false)) AS stored,
    bool_or(pro.document_id IS NOT NULL) AS profiled, bool_or(coalesce(is_located, false)) AS located,
    bool_or(coalesce(is_accepted, false)) AS accepted
    FROM docs LEFT JOIN pro USING (document_id) LEFT JOIN loc USING (document_id) GROUP BY ALL),
st0 AS (SELECT panel.*, true AS expected, coalesce(discovered, false) AS discovered, coalesce(stored, false) AS stored,
    coalesce(profiled, false) AS profiled, coalesce(located, false) AS located, coalesce(accepted, false) AS accepted
    FROM panel LEFT JOIN reached USING (company_id, fy)),
st1 AS (SELECT *, CASE WHEN NOT discovered THEN 'discovered' WHEN NOT stored THEN 'stored' WHEN NOT profiled THEN 'profiled'
    WHEN NOT located THEN 'located' WHEN NOT accepted THEN 'accepted' END AS first_failed FROM st0),
st AS (SELECT *, CASE WHEN first_failed = 'discovered' THEN CASE WHEN fy < 2013 THEN 'before_archive' ELSE 'no_filing' END
    WHEN first_failed = 'stored' THEN 'bad_hash' WHEN first_failed = 'located' THEN CASE WHEN profiled THEN 'no_section' END
    WHEN first_failed = 'accepted' THEN 'unverified' END AS reason FROM st1)
"""


def _counts():
    return [F.count_if(F.col(s)).alias(s) for s in STAGES]


_COUNTS = ", ".join(f"count_if({s}) AS {s}" for s in STAGES)


def coverage_funnel(spark, d):
    """Companies-years at each stage, and the loss against the stage before."""
    one = stage_table(spark, d).agg(*_counts())
    pairs = ", ".join(f"{k}, '{s}', {s}" for k, s in enumerate(STAGES))
    long = one.selectExpr(f"stack({len(STAGES)}, {pairs}) AS (stage_no, stage, n)")
    before = F.lag("n").over(Window.orderBy("stage_no"))
    return long.select("stage_no", "stage", "n", (before - F.col("n")).alias("lost"), F.try_divide((before - F.col("n")) * 100, before).alias("loss_pct"))


def funnel_grouping_sets(spark, d):
    stages = stage_table(spark, d)
    sets = [["fy"], ["era"], ["cap_band"], ["exchange"], ["era", "cap_band"], []]
    return stages.groupingSets(sets, "fy", "era", "cap_band", "exchange").agg(F.grouping_id().alias("gid"), *_counts())


def funnel_gap_screen(spark, d):
    """Per transition the widest gap of loss rates between cap bands, and the bands at its ends."""
    by = stage_table(spark, d).groupBy("cap_band").agg(*_counts())
    pairs = ", ".join(
        f"'{a}>{b}', CASE WHEN {a} > 0 THEN 100.0D * ({a} - {b}) / {a} END" for a, b in zip(STAGES, STAGES[1:])
    )
    long = by.selectExpr("cap_band", f"stack({len(STAGES) - 1}, {pairs}) AS (step, loss)").filter("loss is not null")
    top = F.max_by("cap_band", F.struct("loss", "cap_band"))
    return long.groupBy("step").agg(
        (F.max("loss") - F.min("loss")).alias("gap"), top.alias("worst"), F.min_by("cap_band", F.struct("loss", "cap_band")).alias("best")
    ).withColumn("flagged", F.col("gap") >= 10)


def loss_reason_distribution(spark, d):
    lost = stage_table(spark, d).filter("first_failed is not null").groupBy("first_failed", "reason").agg(F.count("*").alias("n"))
    whole, stage = Window.partitionBy(), Window.partitionBy("first_failed")
    return lost.select(
        "first_failed", "reason", "n",
        (F.col("n") / F.sum("n").over(whole)).alias("share"), (F.col("n") / F.sum("n").over(stage)).alias("share_of_stage"),
    )


def reason_completeness_rollup(spark, d):
    lost = stage_table(spark, d).filter("first_failed is not null")
    return lost.rollup("first_failed").agg(F.count("*").alias("n"), F.count("reason").alias("with_reason"))


def loss_concentration(spark, d):
    """Share of all losses held by the 5 and 10 companies that lose most."""
    by = stage_table(spark, d).filter("first_failed is not null").groupBy("company_id").agg(F.count("*").alias("n"))
    top = by.orderBy(F.desc("n"), "company_id").limit(10)
    rank = F.row_number().over(Window.orderBy(F.desc("n"), "company_id"))
    best = top.withColumn("r", rank).agg(
        F.sum(F.when(F.col("r") <= 5, F.col("n"))).alias("top5"), F.sum("n").alias("top10")
    )
    return by.agg(F.sum("n").alias("lost")).crossJoin(best)


def funnel_reconciliation(spark, d):
    """expected - complete - failed, which must be 0, per era and over all."""
    return stage_table(spark, d).rollup("era").agg(
        F.count("*").alias("expected"),
        F.count_if(F.col("first_failed").isNull()).alias("complete"),
        F.count_if(F.col("first_failed").isNotNull()).alias("failed"),
    ).withColumn("residual", F.col("expected") - F.col("complete") - F.col("failed"))


def first_failed_stage(spark, d):
    return stage_table(spark, d).select("company_id", "fy", "era", "cap_band", *STAGES[1:], "first_failed", "reason")


def _priority():
    host = F.regexp_extract(F.lower(F.trim("source_locator")), r"^https?://([^/?#]+)", 1)
    return F.when(host.startswith("filings"), 10).when(host.startswith("archive"), 20).when(host != "", 30).otherwise(90)


def best_source_per_company_year(spark, d):
    """The report of least source priority per company and year; ties by locator and document."""
    w = Window.partitionBy("company_id", "fiscal_year").orderBy("priority", F.col("source_locator").asc_nulls_last(), "document_id", F.col("ingested_at").asc_nulls_last())
    records = table(spark, d, "doc_records").withColumn("priority", _priority())
    return (
        records.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
        .select("company_id", "fiscal_year", "document_id", "priority", "source_locator")
    )


def missing_years(spark, d):
    """Years a listed company has and lacks, as sorted arrays, and the share it has."""
    records = table(spark, d, "doc_records").filter(F.col("fiscal_year").between(*YEARS))
    have = records.groupBy("company_id").agg(F.array_sort(F.collect_set("fiscal_year")).alias("have"))
    own = table(spark, d, "cohort_companies").select("company_id").distinct()
    all_years = F.sequence(F.lit(YEARS[0]), F.lit(YEARS[1]))
    out = own.join(have, "company_id", "left").withColumn("have", F.coalesce("have", F.array().cast("array<int>")))
    return out.select("company_id", F.size("have").alias("n_have"), F.array_join("have", ",").alias("have"),
                      F.array_join(F.array_except(all_years, "have"), ",").alias("missing"))


def resume_todo(spark, d):
    """Documents that are stored but not judged yet."""
    records, judged = table(spark, d, "doc_records"), table(spark, d, "raw_records").select("document_id")
    return records.select("document_id", "company_id", "fiscal_year").distinct().join(judged, "document_id", "left_anti")


def unknown_company_documents(spark, d):
    """Documents of companies the master does not list, by id or alternate id; they must not vanish."""
    companies = table(spark, d, "cohort_companies")
    alternates = F.split(F.coalesce("alternate_isins", F.lit("")), r"\|")
    ids = companies.select(F.explode(F.array_union(F.array("company_id", "isin"), alternates)).alias("company_id")).filter("company_id <> ''")
    return table(spark, d, "doc_records").select("document_id", "company_id").distinct().join(ids.distinct(), "company_id", "left_anti")


def document_company_join(spark, d):
    """Documents with the company that any of its ids names."""
    companies = table(spark, d, "cohort_companies")
    alternates = F.split(F.coalesce("alternate_isins", F.lit("")), r"\|")
    ids = companies.select("company_id", F.explode(F.array_union(F.array("company_id", "isin"), alternates)).alias("key")).filter("key <> ''").distinct()
    docs = table(spark, d, "doc_records").select("document_id", F.col("company_id").alias("key")).distinct()
    return docs.join(ids, "key").groupBy("document_id").agg(F.min("company_id").alias("first_company"), F.count_distinct("company_id").alias("n_companies"))


def duplicate_content(spark, d):
    """File hashes held by more than one document."""
    h = _hash(F.col("sha256"))
    own = table(spark, d, "doc_records").select("document_id", h.alias("sha")).filter(F.col("sha").rlike(GOOD_HASH)).distinct()
    return own.groupBy("sha").agg(F.count("*").alias("n_documents"), F.min("document_id").alias("first_document")).filter("n_documents > 1")


def corpus_summary(spark, d):
    """Documents, bytes and pages by producer, most first."""
    return table(spark, d, "doc_records").groupBy(F.coalesce(F.nullif("producer", F.lit("")), F.lit("unknown")).alias("producer")).agg(
        F.count_distinct("document_id").alias("documents"), F.sum("file_size_bytes").alias("bytes"),
        F.sum(F.col("page_count").cast("long")).alias("pages"), F.count_if("is_encrypted").alias("encrypted"),
    )


def latest_delivery(spark, d):
    """The delivery ingested last of each document."""
    w = Window.partitionBy("document_id").orderBy(F.col("ingested_at").desc_nulls_last(), F.col("filed_at").desc_nulls_last(), F.col("sha256").desc_nulls_last(), F.col("source_locator").desc_nulls_last())
    records = table(spark, d, "doc_records").dropDuplicates()
    return records.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("document_id", "company_id", "fiscal_year", "sha256", "page_count")


def delivery_changes(spark, d):
    """Fields that differ between the first and the last delivery of a document."""
    fields = _FIELDS
    records = table(spark, d, "doc_records").withColumn("at", F.coalesce("ingested_at", F.lit("1900-01-01").cast("timestamp")))
    ends = records.groupBy("document_id").agg(F.min("at").alias("a"), F.max("at").alias("b")).filter("a < b")
    value = [F.max(F.col(f).cast("string")).alias(f) for f in fields]
    old = records.join(ends, "document_id").filter("at = a").groupBy("document_id").agg(*value)
    new = records.join(ends, "document_id").filter("at = b").groupBy("document_id").agg(*value)
    both = old.alias("o").join(new.alias("n"), "document_id", "full")
    pairs = ", ".join(f"'{f}', o.{f}, n.{f}" for f in fields)
    long = both.selectExpr("document_id", f"stack({len(fields)}, {pairs}) AS (field, old_value, new_value)")
    return long.filter("NOT (old_value <=> new_value)")


def master_outer_join(spark, d):
    """The two exchanges' masters joined outright on the id, with the side each company comes from."""
    companies = table(spark, d, "cohort_companies")
    nse = companies.filter("exchange in ('nse', 'both')").groupBy("company_id").agg(F.max("nse_symbol").alias("nse_symbol"))
    bse = companies.filter("exchange in ('bse', 'both')").groupBy("company_id").agg(F.max("bse_scrip").alias("bse_scrip"), F.lit(1).alias("b"))
    joined = nse.withColumn("n", F.lit(1)).join(bse, "company_id", "full")
    side = F.when(F.col("n").isNotNull() & F.col("b").isNotNull(), "both").when(F.col("n").isNotNull(), "nse").otherwise("bse")
    return joined.select("company_id", "nse_symbol", "bse_scrip", side.alias("side"))


_IDS = r"""ids AS (SELECT company_id, unnest(list_concat([company_id, isin], string_split(coalesce(alternate_isins, ''), '|'))) AS key
    FROM cohort_companies)"""

QUERIES = {f.__name__: f for f in (
    coverage_funnel, funnel_grouping_sets, funnel_gap_screen, loss_reason_distribution, reason_completeness_rollup,
    loss_concentration, funnel_reconciliation, first_failed_stage, best_source_per_company_year, missing_years, resume_todo,
    unknown_company_documents, document_company_join, duplicate_content, corpus_summary, latest_delivery, delivery_changes,
    master_outer_join,
)}

_LONG = " UNION ALL ".join(f"SELECT {k} AS stage_no, '{s}' AS stage, count_if({s}) AS n FROM st" for k, s in enumerate(STAGES))
_STEPS = " UNION ALL ".join(
    f"SELECT cap_band, '{a}>{b}' AS step, CASE WHEN count_if({a}) > 0 THEN 100.0::DOUBLE * (count_if({a}) - count_if({b})) / count_if({a}) END AS loss FROM st GROUP BY 1"
    for a, b in zip(STAGES, STAGES[1:])
)
ORACLES = {
    "coverage_funnel": f"""{_BASE}, l AS ({_LONG}) SELECT stage_no, stage, n, lag(n) OVER (ORDER BY stage_no) - n AS lost,
        (lag(n) OVER (ORDER BY stage_no) - n) * 100 / lag(n) OVER (ORDER BY stage_no) AS loss_pct FROM l""",
    "funnel_grouping_sets": f"""{_BASE} SELECT fy, era, cap_band, exchange, grouping_id(fy, era, cap_band, exchange) AS gid, {_COUNTS}
        FROM st GROUP BY GROUPING SETS ((fy), (era), (cap_band), (exchange), (era, cap_band), ())""",
    "funnel_gap_screen": f"""{_BASE}, l AS ({_STEPS}) SELECT step, max(loss) - min(loss) AS gap,
        arg_max(cap_band, (loss, cap_band)) AS worst, arg_min(cap_band, (loss, cap_band)) AS best,
        max(loss) - min(loss) >= 10 AS flagged FROM l WHERE loss IS NOT NULL GROUP BY 1""",
    "loss_reason_distribution": f"""{_BASE}, l AS (SELECT first_failed, reason, count(*) AS n FROM st WHERE first_failed IS NOT NULL GROUP BY ALL)
        SELECT *, n / sum(n) OVER () AS share, n / sum(n) OVER (PARTITION BY first_failed) AS share_of_stage FROM l""",
    "reason_completeness_rollup": f"""{_BASE} SELECT first_failed, count(*) AS n, count(reason) AS with_reason FROM st
        WHERE first_failed IS NOT NULL GROUP BY ROLLUP (first_failed)""",
    "loss_concentration": f"""{_BASE}, b AS (SELECT company_id, count(*) AS n FROM st WHERE first_failed IS NOT NULL GROUP BY 1),
        r AS (SELECT *, row_number() OVER (ORDER BY n DESC, company_id) AS r FROM b)
        SELECT CAST(sum(n) AS BIGINT) AS lost, CAST(sum(n) FILTER (r <= 5) AS BIGINT) AS top5, CAST(sum(n) FILTER (r <= 10) AS BIGINT) AS top10 FROM r""",
    "funnel_reconciliation": f"""{_BASE} SELECT era, count(*) AS expected, count_if(first_failed IS NULL) AS complete,
        count_if(first_failed IS NOT NULL) AS failed, count(*) - count_if(first_failed IS NULL) - count_if(first_failed IS NOT NULL) AS residual
        FROM st GROUP BY ROLLUP (era)""",
    "first_failed_stage": f"{_BASE} SELECT company_id, fy, era, cap_band, {', '.join(STAGES[1:])}, first_failed, reason FROM st",
    "best_source_per_company_year": r"""
WITH h AS (SELECT *, regexp_extract(lower(trim(source_locator)), '^https?://([^/?#]+)', 1) AS host FROM doc_records),
p AS (SELECT *, CASE WHEN host LIKE 'filings%' THEN 10 WHEN host LIKE 'archive%' THEN 20 WHEN host <> '' THEN 30 ELSE 90 END AS priority FROM h),
r AS (SELECT *, row_number() OVER (PARTITION BY company_id, fiscal_year ORDER BY priority, source_locator NULLS LAST, document_id, ingested_at NULLS LAST) AS rn FROM p)
SELECT company_id, fiscal_year, document_id, priority, source_locator FROM r WHERE rn = 1""",
    "missing_years": """
WITH o AS (SELECT DISTINCT company_id FROM cohort_companies),
h AS (SELECT DISTINCT company_id, fiscal_year AS y FROM doc_records WHERE fiscal_year BETWEEN 2010 AND 2025),
g AS (SELECT o.company_id, y.y, h.y IS NOT NULL AS has FROM o CROSS JOIN range(2010, 2026) y(y) LEFT JOIN h ON h.company_id = o.company_id AND h.y = y.y)
SELECT company_id, CAST(count_if(has) AS INT) AS n_have, coalesce(string_agg(y::VARCHAR, ',' ORDER BY y) FILTER (has), '') AS have,
    coalesce(string_agg(y::VARCHAR, ',' ORDER BY y) FILTER (NOT has), '') AS missing FROM g GROUP BY 1""",
    "resume_todo": "SELECT DISTINCT document_id, company_id, fiscal_year FROM doc_records r WHERE NOT EXISTS (SELECT 1 FROM raw_records c WHERE c.document_id = r.document_id)",
    "unknown_company_documents": f"WITH {_IDS} SELECT DISTINCT document_id, company_id FROM doc_records r WHERE NOT EXISTS (SELECT 1 FROM ids WHERE key <> '' AND key = r.company_id)",
    "document_company_join": f"""WITH {_IDS}, k AS (SELECT DISTINCT company_id, key FROM ids WHERE key <> ''), r AS (SELECT DISTINCT document_id, company_id AS key FROM doc_records)
        SELECT document_id, min(company_id) AS first_company, count(DISTINCT company_id) AS n_companies FROM r JOIN k USING (key) GROUP BY 1""",
    "duplicate_content": """SELECT lower(trim(sha256)) AS sha, count(DISTINCT document_id) AS n_documents, min(document_id) AS first_document
        FROM doc_records WHERE regexp_matches(lower(trim(sha256)), '^[0-9a-f]{64}$') GROUP BY 1 HAVING count(DISTINCT document_id) > 1""",
    "corpus_summary": """SELECT coalesce(nullif(producer, ''), 'unknown') AS producer, count(DISTINCT document_id) AS documents,
        CAST(sum(file_size_bytes) AS BIGINT) AS bytes, CAST(sum(page_count) AS BIGINT) AS pages, count_if(is_encrypted) AS encrypted FROM doc_records GROUP BY 1""",
    "latest_delivery": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY ingested_at DESC NULLS LAST, filed_at DESC NULLS LAST,
        sha256 DESC NULLS LAST, source_locator DESC NULLS LAST) AS rn FROM (SELECT DISTINCT * FROM doc_records))
        SELECT document_id, company_id, fiscal_year, sha256, page_count FROM r WHERE rn = 1""",
    "delivery_changes": f"""
WITH r AS (SELECT *, coalesce(ingested_at, TIMESTAMP '1900-01-01') AS t FROM doc_records),
e AS (SELECT document_id, min(t) AS a, max(t) AS b FROM r GROUP BY 1 HAVING min(t) < max(t)),
o AS (SELECT r.document_id, {', '.join(f'max({f}::VARCHAR) AS {f}' for f in _FIELDS)} FROM r JOIN e ON r.document_id = e.document_id AND t = a GROUP BY 1),
n AS (SELECT r.document_id, {', '.join(f'max({f}::VARCHAR) AS {f}' for f in _FIELDS)} FROM r JOIN e ON r.document_id = e.document_id AND t = b GROUP BY 1)
SELECT * FROM ({' UNION ALL '.join(f"SELECT document_id, '{f}' AS field, o.{f} AS old_value, n.{f} AS new_value FROM o FULL JOIN n USING (document_id)" for f in _FIELDS)})
WHERE old_value IS DISTINCT FROM new_value""",
    "master_outer_join": """
WITH n AS (SELECT company_id, max(nse_symbol) AS nse_symbol, 1 AS n FROM cohort_companies WHERE exchange IN ('nse', 'both') GROUP BY 1),
b AS (SELECT company_id, max(bse_scrip) AS bse_scrip, 1 AS b FROM cohort_companies WHERE exchange IN ('bse', 'both') GROUP BY 1)
SELECT company_id, nse_symbol, bse_scrip, CASE WHEN n = 1 AND b = 1 THEN 'both' WHEN n = 1 THEN 'nse' ELSE 'bse' END AS side
FROM n FULL JOIN b USING (company_id)""",
}
