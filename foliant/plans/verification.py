"""Identity, year, era and order of reports; reasons and grades."""

from __future__ import annotations

from foliant.functions import patterns as P
from foliant.functions import text as T
from foliant.functions import verdict as V
from foliant.functions.similarity import name_likeness
from foliant.operators import chains
from foliant.operators import lines as L
from foliant.plans import sections
from foliant.plans.entities import _LUHN, _NORMAL
from foliant.plans.pages import _ORDER
from foliant.plans.sections import _FEATURES
from foliant.session import table
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_types(spark, d):
    """The kind of security of each listing, next to the one written down."""
    c = table(spark, d, "cohort_companies").groupBy("company_id").agg(*[F.max(x).alias(x) for x in ("isin", "nse_symbol", "canonical_name", "series_type")])
    return c.select("company_id", V.series_type(F.col("isin"), F.col("nse_symbol"), F.col("canonical_name")).alias("told"), F.col("series_type").alias("written"))


def reprocessed_files(spark, d):
    return table(spark, d, "doc_records").groupBy("producer").agg(F.count_distinct("document_id").alias("documents")).withColumn("reprocessor", V.is_reprocessor(F.col("producer")))


def era_signals(spark, d):
    t = F.concat_ws("\n", "section_title", "text")
    return table(spark, d, "documents").select("doc_id", V.ratio_count(t).alias("ratios"), *[c.alias(k) for k, c in V.era_signs(t).items()])


def _years(spark, d) -> DataFrame:
    return table(spark, d, "doc_records").groupBy("document_id").agg(F.max("fiscal_year").alias("fiscal_year"))


def era_consistency(spark, d):
    """Texts whose signs of the era contradict the report's year."""
    t = F.concat_ws("\n", "section_title", "text")
    own = table(spark, d, "documents").select("doc_id", "document_id", *[c.alias(k) for k, c in V.era_signs(t).items()]).join(_years(spark, d), "document_id")
    notes = V.era_notes(F.col("fiscal_year"), {k: F.col(k) for k in ("mandated_ratios", *P.ERA_SIGNS)})
    return own.select("doc_id", "fiscal_year", F.array_join(notes, ",").alias("notes"))


def fiscal_year_families(spark, d):
    """The year that a recognised page mentions most, over four families of mentions; then the one mentioned first."""
    pages = table(spark, d, "ocr_pages").select(F.concat_ws("#", "document_id", "page_no").alias("page"), "text").distinct()
    each = pages.select("page", F.explode(V.year_votes(F.col("text"))).alias("v")).select("page", "v.*")
    votes = each.groupBy("page", "year").agg(F.sum("weight").alias("weight"), F.min(F.struct("family", "k")).alias("first"))
    best = F.max_by(F.struct("year", "weight"), F.struct("weight", -F.col("first.family"), -F.col("first.k"))).alias("b")
    return votes.groupBy("page").agg(best).select("page", "b.year", "b.weight")


def bilingual_headings(spark, d):
    """Pages that hold the section's title and a good share of Devanagari."""
    t = F.concat_ws("\n", "section_title", "text")
    dev, n = T.hits(t, T.DEVANAGARI), F.length(t)
    title = t.rlike(f"(?i){P.HEADING}")
    own = table(spark, d, "documents").select("doc_id", title.alias("heading_match"), dev.alias("devanagari"), n.alias("n"))
    return own.withColumn("bilingual", F.col("heading_match") & (F.col("devanagari") > F.col("n") * V.VERDICT.devanagari_share))


def cautionary_tails(spark, d):
    return table(spark, d, "documents").select("doc_id", V.tail_is_cautionary(F.coalesce("text", F.lit(""))).alias("cautionary"))


ANY_CODE = r"\bIN[A-Z0-9][0-9A-Z]{8}[0-9]\b"


def isin_extraction(spark, d):
    """Valid security codes written in a company's row, and the best of them: the declared one, else by kind and place."""
    c = table(spark, d, "cohort_companies").groupBy("company_id").agg(F.max("isin").alias("declared"), F.max(F.concat_ws(" ", "alternate_isins", "isin", "company_id")).alias("t"))
    codes = F.array_distinct(F.filter(F.regexp_extract_all("t", F.lit(ANY_CODE), F.lit(0)), lambda x: T.luhn_valid(x)))
    rank = lambda x: F.when(x.startswith("INE"), 1).when(x.startswith("IN9"), 2).when(x.startswith("INF"), 3).when(x.rlike("^IN[CD]"), 4).otherwise(5)
    best = F.array_min(F.transform("codes", lambda x, i: F.struct(rank(x).alias("r"), i.alias("i"), x.alias("x"))))["x"]
    own = c.withColumn("codes", codes)
    return own.select("company_id", F.when(F.array_contains("codes", F.col("declared")), F.col("declared")).otherwise(best).alias("best"), F.size("codes").alias("n_codes"))


def name_similarity(spark, d):
    """How like the issuer named by a report is to its company's listed names."""
    c = table(spark, d, "cohort_companies").select("company_id", F.explode(F.split(F.concat_ws("|", "canonical_name", "aliases"), r"\|")).alias("n"))
    names = c.groupBy("company_id").agg(F.array_sort(F.collect_set(T.normal_name(F.col("n")))).alias("names"))
    own = table(spark, d, "doc_records").filter("issuer is not null").select("document_id", "company_id", T.normal_name(F.col("issuer")).alias("issuer")).distinct()
    best = own.join(names, "company_id").withColumn("b", name_likeness(F.col("issuer"), F.col("names")))
    return best.select("document_id", "company_id", "b.score", "b.name")


def regulatory_eras(spark, d):
    return table(spark, d, "doc_records").select("document_id", "fiscal_year").distinct().groupBy(T.era6(F.col("fiscal_year")).alias("era6"), T.era3(F.col("fiscal_year")).alias("era3")).agg(F.count("*").alias("documents"))


def rename_chains(spark, d):
    """Former names and the last name each leads to; a chain that would close on itself stops before."""
    c = table(spark, d, "cohort_companies")
    each = c.select(F.explode(F.split("aliases", r"\|")).alias("a"), "canonical_name").select(T.normal_name(F.col("a")).alias("old"), T.normal_name(F.col("canonical_name")).alias("new"))
    edges = each.filter("old <> '' and new <> '' and old <> new").groupBy("old").agg(F.max("new").alias("new"))
    return chains.follow(edges, "old", "new")


def _facts(spark, d) -> DataFrame:
    """One row per report: what its page texts, its file, its year votes and its located section say."""
    docs = table(spark, d, "documents").filter("document_id is not null")
    t = F.coalesce("text", F.lit(""))
    p = F.transform(L.paragraph_array(F.col("text")), lambda x: x["paragraph"])
    each = docs.select(
        "document_id", "doc_id", "physical_page", "source", T.word_count(t).alias("words"), T.hits(t, r"[^ \t\n\r\f]{29,}").alias("long"), V.leaks(t).alias("leaks"),
        F.size(p).alias("paragraphs"), F.size(F.filter(L.order_flags(p), lambda x: x["orphan"])).alias("orphans"), V.tail_is_cautionary(t).alias("tail"),
        V.ratio_count(t).alias("ratios"), V.year_votes(F.col("text")).alias("votes"),
    )
    last = F.struct(F.coalesce("physical_page", F.lit(-1)), "doc_id")
    by = each.groupBy("document_id").agg(
        F.sum("words").alias("words"), F.sum("long").alias("long"), F.size(F.array_distinct(F.flatten(F.collect_set("leaks")))).alias("leak"),
        F.sum(F.greatest("paragraphs", F.lit(0))).alias("paragraphs"), F.sum(F.greatest("orphans", F.lit(0))).alias("orphans"), F.max_by("tail", last).alias("cautious"),
        F.max("source").alias("company_id"), F.max("ratios").alias("ratios"),
    )
    votes = each.select("document_id", F.explode("votes").alias("v")).groupBy("document_id", "v.year").agg(F.sum("v.weight").alias("weight"))
    year = votes.groupBy("document_id").agg(F.max_by(F.struct("year", "weight"), F.struct("weight", -F.col("year"))).alias("y"))
    files = table(spark, d, "doc_records").groupBy("document_id").agg(F.max("fiscal_year").alias("fiscal_year"), F.max("producer").alias("producer"))
    known = table(spark, d, "cohort_companies").select("company_id").distinct().withColumn("__known", F.lit(True))
    spans = sections.section_arbiter(spark, d).select("document_id", "score", "supporters")
    out = by.join(year, "document_id", "left").join(files, "document_id", "left").join(known, "company_id", "left").join(spans, "document_id", "left")
    share = F.when(F.col("paragraphs") >= 5, F.col("orphans") / F.col("paragraphs")).otherwise(0.0)
    return out.select(
        "document_id", "words", "leak", "orphans", "producer", "cautious", (F.col("long") / F.greatest("words", F.lit(1))).alias("long_share"),
        F.coalesce("__known", F.lit(False)).alias("company_ok"), F.coalesce(F.col("y.year") == F.col("fiscal_year"), F.lit(False)).alias("year_ok"),
        F.coalesce("y.weight", F.lit(0)).alias("weight"), share.alias("share"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("supporters", F.lit(0)).alias("supporters"),
        ((F.col("ratios") >= 4) & (F.coalesce("fiscal_year", F.lit(9999)) < 2020)).cast("int").alias("notes"),
    )


def reason_codes(spark, d):
    c = {k: F.col(k) for k in ("company_ok", "year_ok", "weight", "leak", "words", "share", "orphans", "producer", "cautious")}
    return _facts(spark, d).select("document_id", F.array_join(V.reasons(*c.values()), ",").alias("reasons"))


def document_grade(spark, d):
    c = [F.col(k) for k in ("company_ok", "year_ok", "words", "long_share", "share", "orphans", "leak", "notes", "score", "supporters", "producer")]
    return _facts(spark, d).select("document_id", "score", "supporters", V.grade(*c).alias("grade"))


QUERIES = {f.__name__: f for f in (
    series_types, reprocessed_files, era_signals, era_consistency, fiscal_year_families, bilingual_headings, cautionary_tails, isin_extraction,
    name_similarity, regulatory_eras, rename_chains, reason_codes, document_grade,
)}

_q = lambda p: p.replace("'", "''")
_T = "concat_ws(chr(10), section_title, text)"
_RATIO = lambda t: "CAST(" + " + ".join(f"CAST(regexp_matches({t}, '(?i){_q(p)}') AS INT)" for p in P.RATIOS) + " AS INT)"
_SIGNS = f"{_RATIO(_T)} AS ratios, {_RATIO(_T)} >= 4 AS mandated_ratios, " + ", ".join(f"regexp_matches(lower({_T}), '{_q(p)}') AS {k}" for k, p in P.ERA_SIGNS.items())
_REPRO = lambda c: f"regexp_matches(lower(coalesce({c}, '')), '{'|'.join(P.REPROCESSORS)}')"
_END2 = "(CASE WHEN length(b) = 2 THEN a // 100 * 100 + b::INT ELSE b::INT END)"
_EX = lambda p, g: f"regexp_extract_all(text, '(?i){_q(p)}', {g})"
_VOTES = f"""v0 AS (SELECT doc_id, document_id, unnest({_EX(P.FY_RANGE, 1)})::INT AS a, unnest({_EX(P.FY_RANGE, 2)}) AS b, generate_subscripts({_EX(P.FY_RANGE, 1)}, 1) AS k FROM documents),
v1 AS (SELECT doc_id, document_id, CASE WHEN {_END2} < a THEN {_END2} + 100 ELSE {_END2} END AS e, a, k FROM v0),
vo AS (SELECT doc_id, document_id, CASE WHEN e - a = 1 THEN e END AS year, 3 AS w, 0 AS family, k FROM v1
  UNION ALL SELECT doc_id, document_id, y::INT, CASE WHEN lower(m) LIKE 'mar%' THEN 5 ELSE 1 END, 1, k FROM (SELECT doc_id, document_id, unnest({_EX(P.YEAR_ENDED, 1)}) AS m, unnest({_EX(P.YEAR_ENDED, 2)}) AS y, generate_subscripts({_EX(P.YEAR_ENDED, 1)}, 1) AS k FROM documents)
  UNION ALL SELECT doc_id, document_id, CASE WHEN lower(m) LIKE 'mar%' THEN y::INT END, 2, 2, k FROM (SELECT doc_id, document_id, unnest({_EX(P.AS_AT, 1)}) AS m, unnest({_EX(P.AS_AT, 2)}) AS y, generate_subscripts({_EX(P.AS_AT, 1)}, 1) AS k FROM documents)
  UNION ALL SELECT doc_id, document_id, unnest({_EX(P.FY_SINGLE, 1)})::INT, 2, 3, generate_subscripts({_EX(P.FY_SINGLE, 1)}, 1) FROM documents),
vt AS (SELECT * FROM vo WHERE year BETWEEN 1995 AND 2100)"""
_TAIL = lambda t: (
    f"regexp_matches(array_to_string(list_filter(list_transform(regexp_split_to_array({t}, '\\r?\\n'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g'))), lambda x: x <> '')[-15:], ' '), '(?i){_q(P.CAUTIONARY)}')"
)
_FACTS = _ORDER + ", " + _FEATURES.removeprefix("WITH ") + f""", {_VOTES},
fd AS (SELECT document_id, doc_id, physical_page, source, coalesce(text, '') AS t, {_RATIO("coalesce(text, '')")} AS ratios FROM documents WHERE document_id IS NOT NULL),
fb AS (SELECT document_id, CAST(sum(len(regexp_extract_all(t, '[^ \\t\\n\\r\\f]+'))) AS BIGINT) AS words, sum(len(regexp_extract_all(t, '[^ \\t\\n\\r\\f]{{29,}}'))) AS long_tokens,
    {' + '.join("CAST(bool_or(" + " OR ".join(f"regexp_matches(lower(t), '{p}')" for p, tag in P.LEAKS if tag == x) + ") AS INT)" for x in sorted({tag for _, tag in P.LEAKS}))} AS leak,
    arg_max({_TAIL('t')}, (coalesce(physical_page, -1), doc_id)) AS cautious, max(source) AS company_id, max(ratios) AS ratios FROM fd GROUP BY 1),
fo AS (SELECT document_id, sum(paragraphs) AS paragraphs, sum(orphans) AS orphans FROM od WHERE document_id IS NOT NULL GROUP BY 1),
fw AS (SELECT document_id, year, sum(w) AS weight FROM vt GROUP BY ALL), fy AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY weight DESC, year) AS rn FROM fw),
ff AS (SELECT document_id, max(fiscal_year) AS fiscal_year, max(producer) AS producer FROM doc_records GROUP BY 1),
fs AS (SELECT document_id, supporters, CASE WHEN words < 250 THEN least(99, score + 6 * supporters) / 2 ELSE least(99, score + 6 * supporters) END AS score FROM ct),
fa AS (SELECT fb.document_id, words, leak, coalesce(orphans, 0) AS orphans, producer, cautious, long_tokens / greatest(words, 1) AS long_share, fb.company_id IN (SELECT company_id FROM cohort_companies) AS ck,
    coalesce(fy.year = fiscal_year, false) AS year_ok, coalesce(weight, 0) AS weight, CASE WHEN paragraphs >= 5 THEN orphans / paragraphs ELSE 0.0 END AS share, coalesce(score, 0.0) AS score,
    coalesce(supporters, 0) AS supporters, ratios >= 4 AND coalesce(fiscal_year, 9999) < 2020 AS noted FROM fb LEFT JOIN fo USING (document_id) LEFT JOIN fy ON fy.document_id = fb.document_id AND rn = 1
    LEFT JOIN ff ON ff.document_id = fb.document_id LEFT JOIN fs ON fs.document_id = fb.document_id),
fz AS (SELECT *, coalesce(ck, false) AS company_ok, share > 0.03 AND orphans > 1 AS scrambled, share > 0.06 AND orphans > 1 AS badly, {_REPRO('producer')} AS re FROM fa)"""
ORACLES = {
    "series_types": r"""WITH c AS (SELECT company_id, upper(trim(coalesce(max(isin), ''))) AS i, upper(trim(coalesce(max(nse_symbol), ''))) AS s, upper(trim(coalesce(max(canonical_name), ''))) AS n, max(series_type) AS written FROM cohort_companies GROUP BY 1)
        SELECT company_id, CASE WHEN i LIKE 'IN9%' OR s LIKE '%DVR' OR s LIKE '%DVREQS' OR regexp_matches(n, '\b(DVR|DIFFERENTIAL\s+VOTING\s+RIGHTS)\b') THEN 'dvr'
        WHEN s LIKE '%-RE%' OR s LIKE '%-PP' OR regexp_matches(n, '\b(PARTLY\s+PAID|PART\s+PAID|RIGHTS\s+ENTITLEMENT)\b') THEN 'partly_paid' WHEN i LIKE 'INE%' THEN 'ordinary' ELSE 'other' END AS told, written FROM c""",
    "reprocessed_files": f"SELECT producer, count(DISTINCT document_id) AS documents, {_REPRO('producer')} AS reprocessor FROM doc_records GROUP BY 1",
    "era_signals": f"SELECT doc_id, {_SIGNS} FROM documents",
    "era_consistency": f"""WITH y AS (SELECT document_id, max(fiscal_year) AS fiscal_year FROM doc_records GROUP BY 1), s AS (SELECT doc_id, document_id, {_SIGNS} FROM documents)
        SELECT doc_id, fiscal_year, concat_ws(',', CASE WHEN mandated_ratios AND fiscal_year < 2020 THEN 'ratios_early' END, CASE WHEN NOT mandated_ratios AND fiscal_year >= 2020 THEN 'ratios_absent' END,
        CASE WHEN brsr AND fiscal_year < 2023 THEN 'brsr_early' END, CASE WHEN companies_act_2013 AND fiscal_year < 2015 THEN 'act_2013_early' END, CASE WHEN ind_as AND fiscal_year < 2016 THEN 'ind_as_early' END) AS notes FROM s JOIN y USING (document_id)""",
    "fiscal_year_families": "WITH " + _VOTES.replace("FROM documents", "FROM (SELECT DISTINCT concat_ws('#', document_id, page_no) AS doc_id, document_id, text FROM ocr_pages)") + """, g AS (SELECT doc_id, year, CAST(sum(w) AS BIGINT) AS weight, min((family, k)) AS f FROM vt GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, f) AS rn FROM g) SELECT doc_id AS page, year, weight FROM r WHERE rn = 1""",
    "bilingual_headings": f"""WITH x AS (SELECT doc_id, {_T} AS t FROM documents), y AS (SELECT doc_id, regexp_matches(t, '(?i){_q(P.HEADING)}') AS heading_match, len(regexp_extract_all(t, '[ऀ-ॿ]')) AS devanagari, length(t) AS n FROM x)
        SELECT *, heading_match AND devanagari > n * 0.1 AS bilingual FROM y""",
    "cautionary_tails": f"SELECT doc_id, {_TAIL('t')} AS cautionary FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
    "isin_extraction": rf"""WITH c AS (SELECT company_id, max(isin) AS declared, max(concat_ws(' ', alternate_isins, isin, company_id)) AS t FROM cohort_companies GROUP BY 1),
        e AS (SELECT company_id, declared, unnest(regexp_extract_all(t, '{ANY_CODE}')) AS x, generate_subscripts(regexp_extract_all(t, '{ANY_CODE}'), 1) AS i FROM c),
        g AS (SELECT *, array_to_string(list_transform(regexp_split_to_array(x, ''), lambda z: CASE WHEN regexp_matches(z, '[A-Z]') THEN (ascii(z) - 55)::VARCHAR ELSE z END), '') AS dg FROM e),
        o AS (SELECT company_id, declared, x, min(i) AS i, CASE WHEN x LIKE 'INE%' THEN 1 WHEN x LIKE 'IN9%' THEN 2 WHEN x LIKE 'INF%' THEN 3 WHEN regexp_matches(x, '^IN[CD]') THEN 4 ELSE 5 END AS r FROM g WHERE ({_LUHN}) % 10 = 0 GROUP BY ALL),
        b AS (SELECT company_id, coalesce(max(CASE WHEN x = declared THEN x END), arg_min(x, (r, i))) AS best, count(*) AS n FROM o GROUP BY 1)
        SELECT company_id, best, CAST(coalesce(n, 0) AS INT) AS n_codes FROM c LEFT JOIN b USING (company_id)""",
    "regulatory_eras": """WITH x AS (SELECT DISTINCT document_id, fiscal_year AS y FROM doc_records)
        SELECT CASE WHEN y < 2013 THEN 'pre-2013' WHEN y < 2015 THEN '2013-2014' WHEN y < 2016 THEN '2015' WHEN y < 2020 THEN '2016-2019' WHEN y < 2023 THEN '2020-2022' ELSE '2023+' END AS era6,
        CASE WHEN y < 2014 THEN '2010-2013' WHEN y < 2019 THEN '2014-2018' ELSE '2019-2025' END AS era3, count(*) AS documents FROM x GROUP BY ALL""",
    "rename_chains": f"""WITH RECURSIVE x AS (SELECT {_NORMAL.format(x='a')} AS old, {_NORMAL.format(x='canonical_name')} AS new FROM (SELECT unnest(string_split(aliases, '|')) AS a, canonical_name FROM cohort_companies)),
        e AS (SELECT old, max(new) AS new FROM x WHERE old <> '' AND new <> '' AND old <> new GROUP BY 1),
        t AS (SELECT old, new AS last, [old, new] AS seen, 1 AS hops FROM e UNION ALL SELECT t.old, e.new, list_append(seen, e.new), hops + 1 FROM t JOIN e ON e.old = t.last WHERE NOT list_contains(seen, e.new))
        SELECT old, arg_max(last, hops) AS last, CAST(max(hops) AS INT) AS hops FROM t GROUP BY 1""",
    "reason_codes": f"""{_FACTS} SELECT document_id, concat_ws(',', CASE WHEN NOT company_ok THEN 'identity_unproven' END, CASE WHEN NOT year_ok OR weight < 15 THEN 'year_unproven' END, CASE WHEN leak > 0 THEN 'section_leak' END,
        CASE WHEN words < 250 THEN 'too_short' END, CASE WHEN words > 40000 THEN 'too_long' END, CASE WHEN re THEN 'source_shredded' WHEN scrambled THEN 'order_scrambled' END, CASE WHEN NOT cautious THEN 'span_truncated' END) AS reasons FROM fz""",
    "document_grade": f"""{_FACTS} SELECT document_id, score, supporters, CASE WHEN NOT company_ok OR words < 250 OR long_share > 0.03 OR badly THEN 'low'
        WHEN supporters >= 2 AND year_ok AND score >= 80 AND leak = 0 AND NOT noted AND NOT scrambled THEN CASE WHEN re THEN 'medium' ELSE 'high' END
        WHEN supporters >= 1 AND year_ok AND score >= 60 AND leak <= 1 THEN 'medium' WHEN supporters = 0 AND year_ok AND score >= 70 AND leak = 0 AND NOT scrambled THEN 'medium' ELSE 'low' END AS grade FROM fz""",
}
