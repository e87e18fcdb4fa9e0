"""Scoring and sampling: spans, agreement, strata, draws, conditions."""

from __future__ import annotations

from functools import reduce

from foliant.functions import text as T
from foliant.operators.ranking import spread_rank
from foliant.session import table
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATES = ("PRESENT", "ABSENT", "AMBIGUOUS")
BANDS, ERAS, KINDS = ("large", "mid", "small", "micro"), ("2010-2013", "2014-2018", "2019-2025"), ("digital", "mixed", "scanned")
SEED = "foliant-draw-1"


def _standing(spark, d) -> DataFrame:
    w = Window.partitionBy("document_id", "annotator_role").orderBy(F.col("sealed_at").desc_nulls_last(), F.col("record_sha256").desc_nulls_last())
    raw = table(spark, d, "raw_records").withColumn("rn", F.row_number().over(w)).filter("rn = 1")
    return raw.select(
        "document_id", F.col("annotator_role").alias("role"), F.upper(F.trim("presence_state")).alias("state"),
        F.col("primary_span.start_page").alias("s"), F.col("primary_span.end_page").alias("e"), "flags", "sealed_at",
    )


_ST = """st AS (SELECT document_id, annotator_role AS role, upper(trim(presence_state)) AS state, primary_span.start_page AS s, primary_span.end_page AS e, flags, sealed_at
    FROM (SELECT *, row_number() OVER (PARTITION BY document_id, annotator_role ORDER BY sealed_at DESC NULLS LAST, record_sha256 DESC NULLS LAST) AS rn FROM raw_records) WHERE rn = 1)"""


def _labels(spark, d) -> DataFrame:
    return table(spark, d, "annexure_audit_document_labels").groupBy("label_id").agg(*[
        F.max(c).alias(c) for c in ("document_id", "company", "fy", "era", "cap_band", "doc_kind", "verified_by", "true_start_page",
                                    "proposed_start_page", "heading_form", "heading_text", "heading_page", "classification_status")])


_LA = "la AS (SELECT label_id, " + ", ".join(
    f"max({c}) AS {c}" for c in ("document_id", "company", "fy", "era", "cap_band", "doc_kind", "verified_by", "true_start_page",
                                 "proposed_start_page", "heading_form", "heading_text", "heading_page", "classification_status")
) + " FROM annexure_audit_document_labels GROUP BY 1)"


def superseded_records(spark, d):
    """How many records each annotator replaced per document, with the first and the last seal."""
    return table(spark, d, "raw_records").groupBy("document_id", "annotator_role").agg(
        F.count_distinct("record_sha256").alias("records"), F.min("sealed_at").alias("first_seal"), F.max("sealed_at").alias("last_seal")
    ).filter("records > 1")


def _pairs(spark, d) -> DataFrame:
    st = _standing(spark, d).filter(F.col("state").isin(*STATES))
    a = st.select("document_id", F.col("role").alias("role_a"), F.col("state").alias("state_a"), F.col("s").alias("s1"), F.col("e").alias("e1"))
    b = st.select("document_id", F.col("role").alias("role_b"), F.col("state").alias("state_b"), F.col("s").alias("s2"), F.col("e").alias("e2"))
    return a.join(b, "document_id").filter("role_a < role_b")


_PA = _ST + """, ok AS (SELECT * FROM st WHERE state IN ('PRESENT', 'ABSENT', 'AMBIGUOUS')),
    pr AS (SELECT a.document_id, a.role AS role_a, b.role AS role_b, a.state AS state_a, b.state AS state_b, a.s AS s1, a.e AS e1, b.s AS s2, b.e AS e2
    FROM ok a JOIN ok b ON a.document_id = b.document_id AND a.role < b.role)"""


def presence_confusion(spark, d):
    """Contingency of the states two annotators gave the same documents."""
    return _pairs(spark, d).groupBy("role_a", "role_b", "state_a").pivot("state_b", list(STATES)).count().fillna(0)


def agreement_kappa(spark, d):
    """Observed and chance agreement of each pair of annotators, kappa, and kappa under even chances."""
    p = _pairs(spark, d)
    cells = p.groupBy("role_a", "role_b", "state_a", "state_b").count()
    margin = [F.sum(F.when(F.col(f"state_{x}") == s, F.col("count"))).alias(f"{x}_{s}") for x in "ab" for s in STATES]
    by = cells.groupBy("role_a", "role_b").agg(F.sum("count").alias("n"), F.sum(F.when(F.col("state_a") == F.col("state_b"), F.col("count")).otherwise(0)).alias("same"), *margin)
    cross = reduce(lambda x, y: x + y, [F.coalesce(f"a_{s}", F.lit(0)) * F.coalesce(f"b_{s}", F.lit(0)) for s in STATES])
    n, same = F.col("n"), F.col("same")
    # (po - pe) / (1 - pe) over whole numbers, divided once.
    kappa = F.when(n * n != cross, (same * n - cross) / (n * n - cross))
    return by.select("role_a", "role_b", "n", "same", cross.alias("chance"), kappa.alias("kappa"), ((same * 3 - n) / (n * 2)).alias("pabak"))


def span_iou(spark, d):
    """Agreement of the spans of two annotators who both saw the section."""
    p = _pairs(spark, d).filter("state_a = 'PRESENT' and state_b = 'PRESENT'")
    good = (F.col("s1") <= F.col("e1")) & (F.col("s2") <= F.col("e2"))
    cols = [F.col(c) for c in ("s1", "e1", "s2", "e2")]
    return p.filter(good).select(
        "document_id", "role_a", "role_b", T.iou(*cols).alias("iou"), T.hull_iou(*cols).alias("hull_iou"),
        *[(F.abs(F.col("s1") - F.col("s2")) <= k).alias(f"within_{k}") for k in (0, 1, 2)],
    )


def span_band_agreement(spark, d):
    """Span supporters: annotators whose start lies within two pages, and the best supported span."""
    st = _standing(spark, d).filter("state = 'PRESENT' and s is not null")
    a = st.select("document_id", "role", "s", "e")
    b = st.select("document_id", F.col("role").alias("other"), F.col("s").alias("os"))
    near = a.join(b, "document_id").filter("role <> other and abs(s - os) <= 2").groupBy("document_id", "role").agg(F.count("*").alias("supporters"))
    w = Window.partitionBy("document_id").orderBy(F.desc("supporters"), "s", "role")
    full = a.join(near, ["document_id", "role"], "left").fillna(0, ["supporters"])
    return full.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def signed_error_quantiles(spark, d):
    """Quantiles of proposed minus true start page, by heading form."""
    err = _labels(spark, d).withColumn("err", F.col("proposed_start_page") - F.col("true_start_page")).filter("err is not null")
    p = F.percentile("err", F.array(*[F.lit(q) for q in (0.0, 0.25, 0.5, 0.75, 1.0)])).alias("p")
    by = err.groupBy("heading_form").agg(F.count("*").alias("n"), p)
    return by.select("heading_form", "n", *[F.get("p", F.lit(k)).alias(f"q{k}") for k in range(5)])


def modal_offset(spark, d):
    """The most frequent offset between true and proposed start per worksheet year, and how many agree."""
    off = _labels(spark, d).withColumn("off", F.col("true_start_page") - F.col("proposed_start_page")).filter("off is not null")
    n = off.groupBy("fy", "off").agg(F.count("*").alias("n"))
    best = F.max_by(F.struct("off", "n"), F.struct("n", -F.abs("off"), -F.col("off"))).alias("b")
    return n.groupBy("fy").agg(best, F.sum("n").alias("samples")).select("fy", "b.off", "b.n", "samples")


def segmentation_error(spark, d):
    """P_k of two annotators' spans as segmentations of the pages, with probes of four pages."""
    k, last = 4, F.greatest("e1", "e2") + 4
    p = _pairs(spark, d).filter("state_a = 'PRESENT' and state_b = 'PRESENT' and s1 <= e1 and s2 <= e2")
    probes = p.select("document_id", "role_a", "role_b", "s1", "e1", "s2", "e2", F.explode(F.sequence(F.lit(0), last - k)).alias("i"))
    seg = lambda x, s, e: F.when(x < F.col(s), 0).when(x <= F.col(e), 1).otherwise(2)
    i, j = F.col("i"), F.col("i") + k
    differs = (seg(i, "s1", "e1") == seg(j, "s1", "e1")) != (seg(i, "s2", "e2") == seg(j, "s2", "e2"))
    width = (seg(j, "s1", "e1") - seg(i, "s1", "e1")) != (seg(j, "s2", "e2") - seg(i, "s2", "e2"))
    return probes.groupBy("role_a", "role_b").agg(F.count("*").alias("probes"), F.count_if(differs).alias("pk_errors"), F.count_if(width).alias("wd_errors"))


def stratified_evaluation(spark, d):
    """Start accuracy in all 36 strata of band, era and kind; empty strata come out as zeros."""
    axes = spark.range(1).select(
        F.explode(F.array(*[F.lit(x) for x in BANDS])).alias("cap_band")).withColumn(
        "era", F.explode(F.array(*[F.lit(x) for x in ERAS]))).withColumn("doc_kind", F.explode(F.array(*[F.lit(x) for x in KINDS])))
    off = F.abs(F.col("true_start_page") - F.col("proposed_start_page"))
    by = _labels(spark, d).groupBy("cap_band", "era", "doc_kind").agg(F.count("*").alias("n"), F.count(off).alias("measured"), *[F.count_if(off <= k).alias(f"within_{k}") for k in (0, 1, 2)])
    return axes.join(by, ["cap_band", "era", "doc_kind"], "left").fillna(0)


def worst_strata(spark, d):
    """The three strata with the lowest share of starts within one page."""
    s = stratified_evaluation(spark, d).filter("measured > 0").withColumn("share", F.col("within_1") / F.col("measured"))
    return s.orderBy("share", "cap_band", "era", "doc_kind").limit(3).select("cap_band", "era", "doc_kind", "measured", "share")


def leave_one_out(spark, d):
    """Start accuracy without each heading form in turn, from totals less the group's own sums."""
    off = F.abs(F.col("true_start_page") - F.col("proposed_start_page"))
    by = _labels(spark, d).groupBy("heading_form").agg(F.count(off).alias("n"), F.count_if(off <= 1).alias("hit"))
    whole = Window.partitionBy()
    rest, hit = F.sum("n").over(whole) - F.col("n"), F.sum("hit").over(whole) - F.col("hit")
    return by.select("heading_form", rest.alias("n_rest"), F.when(rest > 0, hit / rest).alias("share_rest"))


def issuer_weighted_accuracy(spark, d):
    """Mean over companies of each company's accuracy, so that none weighs more than another."""
    off = F.abs(F.col("true_start_page") - F.col("proposed_start_page"))
    by = _labels(spark, d).groupBy("company").agg(F.count(off).alias("n"), F.count_if(off <= 1).alias("hit"))
    share = F.when(F.col("n") > 0, (F.col("hit") * 1000000 / F.col("n")).cast("long"))
    return by.agg(F.count("*").alias("companies"), F.count_if(F.col("n") == 0).alias("unmeasured"), F.sum(share).alias("ppm_sum"))


def heading_form_cube(spark, d):
    return _labels(spark, d).cube("heading_form", "cap_band", "era").agg(
        F.grouping_id().alias("gid"), F.count("*").alias("n"),
        F.count_if(F.abs(F.col("true_start_page") - F.col("proposed_start_page")) <= 1).alias("within_1"))


def stratified_hash_sample(spark, d):
    """Two labels of each stratum, by the rank of a hash; independent of order and partitioning."""
    own = _labels(spark, d).withColumn("rank", T.hash_rank(SEED, F.col("document_id"), F.col("label_id")))
    w = Window.partitionBy("cap_band", "era", "doc_kind").orderBy("rank", "label_id")
    return own.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").select("label_id", "cap_band", "era", "doc_kind", "rank")


def salted_issuer_draw(spark, d):
    """Three documents of each company by salted hash; companies with fewer are marked short."""
    own = table(spark, d, "doc_records").select("company_id", "document_id").distinct().withColumn("rank", T.hash_rank(SEED, F.col("company_id"), F.col("document_id")))
    w = Window.partitionBy("company_id").orderBy("rank", "document_id")
    out = own.withColumn("rn", F.row_number().over(w)).filter("rn <= 3")  # kept per group before the shuffle
    n = own.groupBy("company_id").agg(F.count("*").alias("n")).alias("c")
    same = F.col("o.company_id").eqNullSafe(F.col("c.company_id"))
    return out.alias("o").join(n, same).select("o.company_id", "document_id", "rn", (F.col("n") < 3).alias("short"))


def earliest_latest_report(spark, d):
    """First and last fiscal year's report of each company; ties by hash."""
    own = table(spark, d, "doc_records").filter("fiscal_year is not null").select("company_id", "document_id", "fiscal_year").distinct()
    own = own.withColumn("rank", T.hash_rank(SEED, F.col("document_id")))
    return own.groupBy("company_id").agg(
        F.min_by("document_id", F.struct("fiscal_year", "rank")).alias("earliest"),
        F.max_by("document_id", F.struct("fiscal_year", "rank")).alias("latest"), F.count_distinct("fiscal_year").alias("years"),
    )


def quota_cohort(spark, d):
    """A fixed number of listed companies per band, active ones first, then by hash."""
    quota = F.when(F.col("cap_band") == "large", 6).when(F.col("cap_band") == "mid", 8).when(F.col("cap_band") == "small", 10).otherwise(12)
    own = table(spark, d, "cohort_companies").filter("cap_band is not null").groupBy("company_id").agg(F.max("cap_band").alias("cap_band"), F.max("status").alias("status"))
    w = Window.partitionBy("cap_band").orderBy(F.when(F.col("status") == "active", 0).otherwise(1), T.hash_rank(SEED, F.col("company_id")))
    # The largest quota bounds each band before the shuffle; each band's own follows.
    return own.withColumn("rn", F.row_number().over(w)).filter("rn <= 12").filter(F.col("rn") <= quota).select("company_id", "cap_band", "rn")


def issuer_split_rotation(spark, d):
    """Companies in hash order dealt to FIT, HOLDOUT, FIT, VALIDATION in turn; a company is never parted.

    The order over all companies is an exact rank over ranges of the hash, not one sorted task.
    """
    own = table(spark, d, "doc_records").filter("company_id is not null").groupBy("company_id").agg(F.count_distinct("document_id").alias("documents"))
    own = own.withColumn("rank", T.hash_rank(SEED, F.col("company_id"))).withColumn("one", F.lit(1))
    pos = spread_rank(own, ["one"], F.substring("rank", 1, 2), [F.col("rank")], "pos")
    split = F.element_at(F.array(*[F.lit(x) for x in ("FIT", "HOLDOUT", "FIT", "VALIDATION")]), (F.col("pos") % 4 + 1).cast("int"))
    return pos.select("company_id", "documents", split.alias("split"))


def split_integrity(spark, d):
    """Companies whose written splits differ, once notation is taken off."""
    s = F.upper(F.trim("split"))
    return table(spark, d, "doc_records").filter("company_id is not null").groupBy("company_id").agg(
        F.array_join(F.array_sort(F.collect_set(s)), ",").alias("splits"), F.count_distinct(s).alias("n")).filter("n > 1")


CONDITIONS = ("is_scanned", "is_native", "is_hybrid", "is_t0_ocr", "is_t0_broken", "is_devanagari_page", "is_hindi_page", "is_bilingual_page",
              "has_top_furniture", "has_bottom_furniture", "has_toc_keyword", "has_mda_keyword", "has_annexure_keyword")


def _conditions(spark, d) -> DataFrame:
    pairs = ", ".join(f"'{c}', {c}" for c in CONDITIONS)
    by = table(spark, d, "page_census").selectExpr("document_id", "company_id", "physical_page", f"stack({len(CONDITIONS)}, {pairs}) AS (condition, holds)")
    return by.filter("holds").select("document_id", "company_id", "physical_page", "condition").distinct()


_CO = "co AS (" + " UNION ".join(f"SELECT document_id, company_id, physical_page, '{c}' AS condition FROM page_census WHERE {c}" for c in CONDITIONS) + ")"


def condition_coverage(spark, d):
    """Pages, documents and companies that show each condition, and whether it is rare."""
    by = _conditions(spark, d).groupBy("condition").agg(
        F.count_distinct("document_id", "physical_page").alias("pages"), F.count_distinct("document_id").alias("documents"), F.count_distinct("company_id").alias("companies"))
    return by.withColumn("rare", F.col("documents") <= 10)


def condition_interactions(spark, d):
    """Documents that show both conditions of a pair."""
    own = _conditions(spark, d).select("document_id", "condition").distinct()
    # At most 13 conditions a document: the pairs come from its own array, not from a join.
    sets = own.groupBy("document_id").agg(F.array_sort(F.collect_set("condition")).alias("c"))
    pair = sets.select("document_id", F.posexplode("c").alias("i", "a"), "c").select("a", F.explode(F.slice("c", F.col("i") + 2, F.lit(len(CONDITIONS)))).alias("b"))
    return pair.groupBy("a", "b").agg(F.count("*").alias("documents")).filter("documents >= 3")


def page_condition_labels(spark, d):
    """All conditions of each page, and the first of them in order of priority as its stratum."""
    by = _conditions(spark, d).groupBy("document_id", "physical_page").agg(F.array_sort(F.collect_set("condition")).alias("all_labels"))
    order = F.array(*[F.lit(c) for c in ("is_t0_broken", "is_scanned", "is_hybrid", "is_bilingual_page", "is_devanagari_page", "is_native")])
    first = F.get(F.filter(order, lambda x: F.array_contains("all_labels", x)), F.lit(0))
    return by.select("document_id", "physical_page", F.array_join("all_labels", ",").alias("labels"), first.alias("stratum"))


def zero_cells(spark, d):
    """Combinations of band, kind, form and year that no label shows."""
    la = _labels(spark, d)
    level = {c: la.select(c).filter(f"{c} is not null").distinct() for c in ("cap_band", "doc_kind", "heading_form", "fy")}
    # A handful of levels each (bands, kinds, forms, years): the product is at most a thousand rows or so.
    cells = level["cap_band"].crossJoin(level["doc_kind"]).crossJoin(level["heading_form"]).crossJoin(level["fy"])
    return cells.join(la, ["cap_band", "doc_kind", "heading_form", "fy"], "left_anti")


def pages_in_span(spark, d):
    """Audited spans against the census: pages found inside, missing, scanned."""
    spans = table(spark, d, "input_rows").filter("start_page <= end_page").groupBy("document_id").agg(F.min("start_page").alias("s"), F.max("end_page").alias("e"))
    inside = spans.select("document_id", F.explode(F.sequence("s", "e")).alias("physical_page"))
    census = table(spark, d, "page_census").groupBy("document_id", "physical_page").agg(F.bool_or("is_scanned").alias("scanned"))
    both = inside.join(census.withColumn("found", F.lit(1)), ["document_id", "physical_page"], "left")
    return both.groupBy("document_id").agg(F.count("*").alias("pages"), F.count("found").alias("found"), F.count_if("scanned").alias("scanned"))


def gap_pages(spark, d):
    """Page lists of audits parsed; pages named inside and outside the span."""
    own = table(spark, d, "input_rows").filter("gap_pages <> ''").select("document_id", "start_page", "end_page", F.explode(F.split("gap_pages", ";")).alias("p")).distinct()
    page = own.withColumn("page", F.expr("try_cast(trim(p) AS int)"))
    return page.groupBy("document_id").agg(F.count("page").alias("pages"), F.count_if(F.col("page").between(F.col("start_page"), F.col("end_page"))).alias("inside"), F.count_if(F.col("page").isNull()).alias("unreadable"))


def annotator_triggers(spark, d):
    """Documents on which annotators differ by more than a few pages, raise many flags, or disagree."""
    st = _standing(spark, d)
    by = st.groupBy("document_id").agg(
        F.count("*").alias("annotators"), F.count_distinct("state").alias("states"),
        (F.max("s") - F.min("s")).alias("spread"), F.max(F.coalesce(F.array_size("flags"), F.lit(0))).alias("most_flags"))
    fired = F.array_compact(F.array(F.when(F.col("states") > 1, "STATE"), F.when(F.col("spread") > 3, "SPAN"), F.when(F.col("most_flags") >= 4, "FLAGS")))
    return by.withColumn("fired", F.array_join(fired, ",")).filter("fired <> ''")


def record_violations(spark, d):
    """Rules that annotators' records break, one row per rule and record."""
    s, e = F.col("primary_span.start_page"), F.col("primary_span.end_page")
    state = F.upper(F.trim("presence_state"))
    rules = F.array_compact(F.array(
        F.when(F.coalesce(~state.isin(*STATES), F.lit(True)), "unknown_state"),
        F.when((state == "PRESENT") & s.isNull(), "present_without_span"), F.when((state != "PRESENT") & s.isNotNull(), "span_without_presence"),
        F.when(s > e, "span_reversed"), F.when(s.isNotNull() & e.isNull(), "span_open"), F.when(F.col("flags").isNull(), "flags_missing")))
    return table(spark, d, "raw_records").select("record_sha256", F.explode(rules).alias("rule")).distinct()


QUERIES = {f.__name__: f for f in (
    superseded_records, presence_confusion, agreement_kappa, span_iou, span_band_agreement, signed_error_quantiles, modal_offset,
    segmentation_error, stratified_evaluation, worst_strata, leave_one_out, issuer_weighted_accuracy, heading_form_cube,
    stratified_hash_sample, salted_issuer_draw, earliest_latest_report, quota_cohort, issuer_split_rotation, split_integrity,
    condition_coverage, condition_interactions, page_condition_labels, zero_cells, pages_in_span, gap_pages, annotator_triggers,
    record_violations,
)}

_OFF = "abs(true_start_page - proposed_start_page)"
_HASH = "sha256(concat_ws(chr(0), 'foliant-draw-1', {}))"
_STRATA = f"""WITH {_LA}, ax AS (SELECT * FROM (SELECT unnest({list(BANDS)}) AS cap_band), (SELECT unnest({list(ERAS)}) AS era), (SELECT unnest({list(KINDS)}) AS doc_kind)),
    g AS (SELECT cap_band, era, doc_kind, count(*) AS n, count({_OFF}) AS measured, count_if({_OFF} <= 0) AS within_0, count_if({_OFF} <= 1) AS within_1, count_if({_OFF} <= 2) AS within_2
    FROM la GROUP BY ALL), se AS (SELECT ax.*, {', '.join(f'coalesce({c}, 0) AS {c}' for c in ('n', 'measured', 'within_0', 'within_1', 'within_2'))}
    FROM ax LEFT JOIN g USING (cap_band, era, doc_kind))"""
_SEG = lambda x, s, e: f"(CASE WHEN {x} < {s} THEN 0 WHEN {x} <= {e} THEN 1 ELSE 2 END)"
ORACLES = {
    "superseded_records": """SELECT document_id, annotator_role, count(DISTINCT record_sha256) AS records, min(sealed_at) AS first_seal, max(sealed_at) AS last_seal
        FROM raw_records GROUP BY ALL HAVING count(DISTINCT record_sha256) > 1""",
    "presence_confusion": f"WITH {_PA} SELECT role_a, role_b, state_a, " + ", ".join(f"count_if(state_b = '{s}') AS \"{s}\"" for s in STATES) + " FROM pr GROUP BY ALL",
    "agreement_kappa": f"WITH {_PA}, m AS (SELECT role_a, role_b, count(*) AS n, count_if(state_a = state_b) AS same, "
        + " + ".join(f"count_if(state_a = '{s}') * count_if(state_b = '{s}')" for s in STATES)
        + " AS chance FROM pr GROUP BY ALL) SELECT *, CASE WHEN n * n <> chance THEN (same * n - chance) / (n * n - chance) END AS kappa, (same * 3 - n) / (n * 2) AS pabak FROM m",
    "span_iou": f"""WITH {_PA}, x AS (SELECT *, greatest(least(e1, e2) - greatest(s1, s2) + 1, 0) AS sh FROM pr WHERE state_a = 'PRESENT' AND state_b = 'PRESENT' AND s1 <= e1 AND s2 <= e2)
        SELECT document_id, role_a, role_b, sh / ((e1 - s1 + 1) + (e2 - s2 + 1) - sh) AS iou, sh / (greatest(e1, e2) - least(s1, s2) + 1) AS hull_iou,
        abs(s1 - s2) <= 0 AS within_0, abs(s1 - s2) <= 1 AS within_1, abs(s1 - s2) <= 2 AS within_2 FROM x""",
    "span_band_agreement": f"""WITH {_ST}, p AS (SELECT document_id, role, s, e FROM st WHERE state = 'PRESENT' AND s IS NOT NULL),
        n AS (SELECT a.document_id, a.role, a.s, a.e, count(b.role) AS supporters FROM p a LEFT JOIN p b ON a.document_id = b.document_id AND a.role <> b.role AND abs(a.s - b.s) <= 2 GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY supporters DESC, s, role) AS rn FROM n) SELECT document_id, role, s, e, supporters FROM r WHERE rn = 1""",
    "signed_error_quantiles": f"WITH {_LA} SELECT heading_form, count(*) AS n, " + ", ".join(f"quantile_cont(proposed_start_page - true_start_page, {q}) AS q{k}" for k, q in enumerate((0.0, 0.25, 0.5, 0.75, 1.0)))
        + " FROM la WHERE proposed_start_page - true_start_page IS NOT NULL GROUP BY 1",
    "modal_offset": f"""WITH {_LA}, n AS (SELECT fy, true_start_page - proposed_start_page AS off, count(*) AS n FROM la WHERE true_start_page - proposed_start_page IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY fy ORDER BY n DESC, abs(off), off) AS rn, CAST(sum(n) OVER (PARTITION BY fy) AS BIGINT) AS samples FROM n) SELECT fy, off, n, samples FROM r WHERE rn = 1""",
    "segmentation_error": f"""WITH {_PA}, x AS (SELECT role_a, role_b, s1, e1, s2, e2, unnest(range(0, greatest(e1, e2) + 1)) AS i FROM pr WHERE state_a = 'PRESENT' AND state_b = 'PRESENT' AND s1 <= e1 AND s2 <= e2)
        SELECT role_a, role_b, count(*) AS probes, count_if(({_SEG('i', 's1', 'e1')} = {_SEG('i + 4', 's1', 'e1')}) <> ({_SEG('i', 's2', 'e2')} = {_SEG('i + 4', 's2', 'e2')})) AS pk_errors,
        count_if(({_SEG('i + 4', 's1', 'e1')} - {_SEG('i', 's1', 'e1')}) <> ({_SEG('i + 4', 's2', 'e2')} - {_SEG('i', 's2', 'e2')})) AS wd_errors FROM x GROUP BY ALL""",
    "stratified_evaluation": f"{_STRATA} SELECT * FROM se",
    "worst_strata": f"{_STRATA} SELECT cap_band, era, doc_kind, measured, within_1 / measured AS share FROM se WHERE measured > 0 ORDER BY share, cap_band, era, doc_kind LIMIT 3",
    "leave_one_out": f"""WITH {_LA}, g AS (SELECT heading_form, count({_OFF}) AS n, count_if({_OFF} <= 1) AS hit FROM la GROUP BY 1),
        r AS (SELECT heading_form, CAST(sum(n) OVER () - n AS BIGINT) AS n_rest, sum(hit) OVER () - hit AS h FROM g) SELECT heading_form, n_rest, CASE WHEN n_rest > 0 THEN h / n_rest END AS share_rest FROM r""",
    "issuer_weighted_accuracy": f"""WITH {_LA}, g AS (SELECT company, count({_OFF}) AS n, count_if({_OFF} <= 1) AS hit FROM la GROUP BY 1)
        SELECT count(*) AS companies, count_if(n = 0) AS unmeasured, CAST(sum(CASE WHEN n > 0 THEN hit * 1000000 // n END) AS BIGINT) AS ppm_sum FROM g""",
    "heading_form_cube": f"WITH {_LA} SELECT heading_form, cap_band, era, grouping_id(heading_form, cap_band, era) AS gid, count(*) AS n, count_if({_OFF} <= 1) AS within_1 FROM la GROUP BY CUBE (heading_form, cap_band, era)",
    "stratified_hash_sample": f"""WITH {_LA}, h AS (SELECT *, {_HASH.format('document_id, label_id::VARCHAR')} AS rank FROM la),
        r AS (SELECT *, row_number() OVER (PARTITION BY cap_band, era, doc_kind ORDER BY rank, label_id) AS rn FROM h) SELECT label_id, cap_band, era, doc_kind, rank FROM r WHERE rn <= 2""",
    "salted_issuer_draw": f"""WITH x AS (SELECT DISTINCT company_id, document_id FROM doc_records), h AS (SELECT *, {_HASH.format('company_id, document_id')} AS rank FROM x),
        r AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY rank, document_id) AS rn, count(*) OVER (PARTITION BY company_id) AS n FROM h)
        SELECT company_id, document_id, rn, n < 3 AS short FROM r WHERE rn <= 3""",
    "earliest_latest_report": f"""WITH x AS (SELECT DISTINCT company_id, document_id, fiscal_year, {_HASH.format('document_id')} AS rank FROM doc_records WHERE fiscal_year IS NOT NULL)
        SELECT company_id, arg_min(document_id, (fiscal_year, rank)) AS earliest, arg_max(document_id, (fiscal_year, rank)) AS latest, count(DISTINCT fiscal_year) AS years FROM x GROUP BY 1""",
    "quota_cohort": f"""WITH c AS (SELECT company_id, max(cap_band) AS cap_band, max(status) AS status FROM cohort_companies WHERE cap_band IS NOT NULL GROUP BY 1),
        r AS (SELECT *, row_number() OVER (PARTITION BY cap_band ORDER BY CASE WHEN status = 'active' THEN 0 ELSE 1 END, {_HASH.format('company_id')}) AS rn FROM c)
        SELECT company_id, cap_band, rn FROM r WHERE rn <= CASE cap_band WHEN 'large' THEN 6 WHEN 'mid' THEN 8 WHEN 'small' THEN 10 ELSE 12 END""",
    "issuer_split_rotation": f"""WITH c AS (SELECT company_id, count(DISTINCT document_id) AS documents FROM doc_records WHERE company_id IS NOT NULL GROUP BY 1),
        r AS (SELECT *, (row_number() OVER (ORDER BY {_HASH.format('company_id')}) - 1) % 4 AS k FROM c)
        SELECT company_id, documents, CASE k WHEN 1 THEN 'HOLDOUT' WHEN 3 THEN 'VALIDATION' ELSE 'FIT' END AS split FROM r""",
    "split_integrity": """SELECT company_id, string_agg(DISTINCT upper(trim(split)), ',' ORDER BY upper(trim(split))) AS splits, count(DISTINCT upper(trim(split))) AS n
        FROM doc_records WHERE company_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT upper(trim(split))) > 1""",
    "condition_coverage": f"""WITH {_CO}, g AS (SELECT condition, count(DISTINCT (document_id, physical_page)) AS pages, count(DISTINCT document_id) AS documents, count(DISTINCT company_id) AS companies FROM co GROUP BY 1)
        SELECT *, documents <= 10 AS rare FROM g""",
    "condition_interactions": f"""WITH {_CO}, o AS (SELECT DISTINCT document_id, condition FROM co)
        SELECT x.condition AS a, y.condition AS b, count(*) AS documents FROM o x JOIN o y ON x.document_id = y.document_id AND x.condition < y.condition GROUP BY ALL HAVING count(*) >= 3""",
    "page_condition_labels": f"""WITH {_CO} SELECT document_id, physical_page, string_agg(DISTINCT condition, ',' ORDER BY condition) AS labels, CASE
        {' '.join(f"WHEN bool_or(condition = '{c}') THEN '{c}'" for c in ('is_t0_broken', 'is_scanned', 'is_hybrid', 'is_bilingual_page', 'is_devanagari_page', 'is_native'))} END AS stratum FROM co GROUP BY ALL""",
    "zero_cells": f"""WITH {_LA}, a AS (SELECT DISTINCT cap_band FROM la WHERE cap_band IS NOT NULL), b AS (SELECT DISTINCT doc_kind FROM la WHERE doc_kind IS NOT NULL), c AS (SELECT DISTINCT heading_form FROM la WHERE heading_form IS NOT NULL), e AS (SELECT DISTINCT fy FROM la WHERE fy IS NOT NULL)
        SELECT * FROM a, b, c, e EXCEPT SELECT cap_band, doc_kind, heading_form, fy FROM la""",
    "pages_in_span": """WITH s AS (SELECT document_id, min(start_page) AS s, max(end_page) AS e FROM input_rows WHERE start_page <= end_page GROUP BY 1),
        i AS (SELECT document_id, unnest(range(s, e + 1)) AS physical_page FROM s), c AS (SELECT document_id, physical_page, bool_or(is_scanned) AS scanned, 1 AS f FROM page_census GROUP BY ALL)
        SELECT document_id, count(*) AS pages, count(f) AS found, count(*) FILTER (scanned) AS scanned FROM i LEFT JOIN c USING (document_id, physical_page) GROUP BY 1""",
    "gap_pages": """WITH x AS (SELECT DISTINCT * FROM (SELECT document_id, start_page, end_page, unnest(string_split(gap_pages, ';')) AS p FROM input_rows WHERE gap_pages <> '')),
        y AS (SELECT *, try_cast(trim(p) AS INT) AS page FROM x)
        SELECT document_id, count(page) AS pages, count(*) FILTER (page BETWEEN start_page AND end_page) AS inside, count_if(page IS NULL) AS unreadable FROM y GROUP BY 1""",
    "annotator_triggers": f"""WITH {_ST}, g AS (SELECT document_id, count(*) AS annotators, count(DISTINCT state) AS states, max(s) - min(s) AS spread, CAST(max(coalesce(len(flags), 0)) AS INT) AS most_flags FROM st GROUP BY 1),
        f AS (SELECT *, concat_ws(',', CASE WHEN states > 1 THEN 'STATE' END, CASE WHEN spread > 3 THEN 'SPAN' END, CASE WHEN most_flags >= 4 THEN 'FLAGS' END) AS fired FROM g) SELECT * FROM f WHERE fired <> ''""",
    "record_violations": """WITH r AS (SELECT record_sha256, upper(trim(presence_state)) AS st, primary_span.start_page AS s, primary_span.end_page AS e, flags FROM raw_records)
        SELECT record_sha256, 'unknown_state' AS rule FROM r WHERE coalesce(st NOT IN ('PRESENT', 'ABSENT', 'AMBIGUOUS'), true) UNION SELECT record_sha256, 'present_without_span' FROM r WHERE st = 'PRESENT' AND s IS NULL
        UNION SELECT record_sha256, 'span_without_presence' FROM r WHERE st <> 'PRESENT' AND s IS NOT NULL UNION SELECT record_sha256, 'span_reversed' FROM r WHERE s > e
        UNION SELECT record_sha256, 'span_open' FROM r WHERE s IS NOT NULL AND e IS NULL UNION SELECT record_sha256, 'flags_missing' FROM r WHERE flags IS NULL""",
}
