"""Scoring against gold, corpus audits and draws."""

from __future__ import annotations

from functools import reduce

from foliant.functions import text as T
from foliant.plans.pages import _ORDER, _order
from foliant.plans.scoring import _CO, _HASH, _LA, _ST, SEED, STATES, _conditions, _labels, _standing
from foliant.session import table
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("NO_OUTPUT", "DUPLICATE", "IDENTITY_INVALID", "QUARANTINE", "NOT_LOCATED", "TYPE_INVALID", "ORDER_INVALID", "RANGE_INVALID", "VALID")


def valid_span(start: Column, end: Column, pages: Column) -> Column:
    """0 <= start <= end < pages; false where any is unknown."""
    return F.coalesce((pages > 0) & (start >= 0) & (start <= end) & (end < pages), F.lit(False))


def prediction_status(spark, d):
    """Which of nine statuses the audited span of each judged report has, in order of priority.

    Gold are the judged reports with their file hash, predictions the audited rows with the file's
    own hash, page count and state of verification; several rows of one report are duplicates.
    """
    good = F.lower(F.trim("source_pdf_sha256"))
    gold = table(spark, d, "raw_records").filter("document_id is not null").groupBy("document_id").agg(F.max(good).alias("gold_sha"))
    files = table(spark, d, "doc_records").groupBy("document_id").agg(
        F.max(F.lower(F.trim("sha256"))).alias("sha"), F.max("page_count").alias("n"), F.bool_and("sha256_verified").alias("verified"))
    rows = table(spark, d, "input_rows").groupBy("document_id").agg(
        F.count("*").alias("rows"), F.max("start_page").alias("s"), F.max("end_page").alias("e"), F.max("body_title").alias("title"))
    c = gold.join(rows, "document_id", "left").join(files, "document_id", "left")
    s, e, n = F.col("s"), F.col("e"), F.col("n")
    status = (
        F.when(F.col("rows").isNull(), "NO_OUTPUT").when(F.col("rows") > 1, "DUPLICATE").when(F.coalesce(F.col("sha") != F.col("gold_sha"), F.lit(True)), "IDENTITY_INVALID")
        .when(F.col("verified") == F.lit(False), "QUARANTINE").when(e.isNull() & F.col("title").isNull(), "NOT_LOCATED").when(s.isNull() | e.isNull() | n.isNull() | (n <= 0), "TYPE_INVALID")
        .when(s > e, "ORDER_INVALID").when((s < 0) | (e >= n), "RANGE_INVALID").otherwise("VALID")
    )
    return c.select("document_id", status.alias("status"))


def _gold_state(spark, d) -> DataFrame:
    """The state most standing records give a report; ties by the order of STATES."""
    n = _standing(spark, d).filter(F.col("state").isin(*STATES)).groupBy("document_id", "state").agg(F.count("*").alias("n"))
    rank = F.array_position(F.array(*[F.lit(x) for x in STATES]), F.col("state"))
    return n.groupBy("document_id").agg(F.max_by("state", F.struct("n", -rank)).alias("gold_state"))


def presence_scores(spark, d):
    """Sensitivity, specificity and accuracy of located sections; every failure counts as an error."""
    both = _gold_state(spark, d).join(prediction_status(spark, d), "document_id")
    p, a = F.col("gold_state") == "PRESENT", F.col("gold_state") == "ABSENT"
    found, lost = F.col("status") == "VALID", F.col("status") == "NOT_LOCATED"
    one = both.agg(
        F.count_if(p & found).alias("tp"), F.count_if(p & ~found).alias("fn"), F.count_if(a & ~lost).alias("fp"), F.count_if(a & lost).alias("tn"),
        F.count_if(F.col("gold_state") == "AMBIGUOUS").alias("ambiguous"),
    )
    div = lambda x, y: F.try_divide(x, y)
    return one.select(
        "*", div(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"), div(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
        div(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("accuracy"),
    )


def presence_table(spark, d):
    """Gold state by what became of the report: located, not located, or failed."""
    both = _gold_state(spark, d).join(prediction_status(spark, d), "document_id")
    column = F.when(F.col("status") == "VALID", "PRESENT").when(F.col("status") == "NOT_LOCATED", "NOT_LOCATED").otherwise("FAILED")
    return both.groupBy("gold_state", column.alias("outcome")).agg(F.count("*").alias("documents"))


def gold_violations(spark, d):
    """Rules of gold records that a record breaks, one row per rule and record."""
    pages = table(spark, d, "doc_records").groupBy("document_id").agg(F.max("page_count").alias("n"))
    r = table(spark, d, "raw_records").dropDuplicates(["record_sha256"]).join(pages, "document_id", "left")
    s, e = F.col("primary_span.start_page"), F.col("primary_span.end_page")
    state, flags = F.col("presence_state"), F.coalesce("flags", F.array().cast("array<string>"))
    none = lambda c: F.coalesce(~c, F.lit(True))
    rules = (
        (none(F.col("document_id").rlike("^[A-Za-z0-9._-]{1,256}$")), "document_id"), (none(F.col("source_pdf_sha256").rlike("^[0-9a-f]{64}$")), "source_hash"),
        (none(F.col("record_sha256").rlike("^[0-9a-f]{64}$")), "record_hash"), (none(state.isin(*STATES)), "state"), (none(F.col("record_type").isin("RAW", "ADJUDICATED")), "record_type"),
        (none(F.col("annotator_role").rlike("^ANNOTATOR_[A-Z]$")), "role"), (none(F.col("n") > 0), "page_count"), (F.col("sealed_at").isNull(), "unsealed"),
        ((state == "PRESENT") & ~valid_span(s, e, F.col("n")), "present_span"), ((state != "PRESENT") & F.col("primary_span").isNotNull(), "span_without_presence"),
        ((state == "ABSENT") & F.array_contains(flags, "GAP_PAGES"), "absent_gaps"), (F.size(F.array_distinct(flags)) != F.size(flags), "repeated_flags"),
        (F.col("flags").isNull(), "flags_missing"), (F.array_contains(flags, "GAP_PAGES") & (e - s < 2), "gap_outside_span"),
    )
    return r.select("record_sha256", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for c, k in rules]))).alias("rule"))


def label_precision(spark, d):
    """Share of starts within one page by heading form (method), and by how many signs support it, at most three."""
    off = F.abs(F.col("true_start_page") - F.col("proposed_start_page"))
    signs = F.when(F.col("verified_by") == "read_pdf", 1).otherwise(0) + F.when(F.col("classification_status") == "clear", 1).otherwise(0) + F.when(F.col("heading_page") == F.col("proposed_start_page"), 1).otherwise(0)
    la = _labels(spark, d).filter("proposed_start_page is not null and true_start_page is not null").withColumn("support", F.when(signs >= 3, "3+").otherwise(signs.cast("string")))
    n = [F.count("*").alias("n"), F.count_if(off <= 1).alias("within_1"), F.count_if(off == 0).alias("exact")]
    by = la.groupingSets([["heading_form"], ["support"], ["doc_kind"]], "heading_form", "support", "doc_kind").agg(F.grouping_id().alias("gid"), *n)
    return by.withColumn("precision", F.col("within_1") / F.col("n"))


def document_threshold_metrics(spark, d):
    """Documents of which 5, 10, 25 or 50 % of the pages have a share of orphans over a threshold."""
    pages = _order(spark, d).filter("document_id is not null and paragraphs >= 2").select("document_id", (F.col("orphans") / F.col("paragraphs")).alias("x"))
    both = pages.withColumn("threshold", F.explode(F.array(*[F.lit(v) for v in (0.03, 0.1, 0.2)])))
    by = both.groupBy("threshold", "document_id").agg(F.count("*").alias("pages"), F.count_if(F.col("x") > F.col("threshold")).alias("bad"))
    return by.groupBy("threshold").agg(F.count("*").alias("documents"), *[F.count_if(F.col("bad") * 100 >= F.col("pages") * k).alias(f"over_{k}") for k in (5, 10, 25, 50)])


def subgroup_stability(spark, d):
    """Share of orphaned paragraphs over a threshold in overlapping groups of documents, with the median share."""
    docs = _order(spark, d).filter("document_id is not null").groupBy("document_id").agg((F.sum("orphans") / F.greatest(F.sum("paragraphs"), F.lit(1))).alias("x"))
    files = table(spark, d, "doc_records").groupBy("document_id").agg(F.max("fiscal_year").alias("y"), F.max("producer").alias("producer"), F.max("page_count").alias("n"))
    tags = F.array_compact(F.array(F.lit("all"), T.era3(F.col("y")), F.concat(F.lit("producer "), "producer"), F.when(F.col("n") > 200, "long"), F.when(F.col("n") <= 60, "short")))
    each = docs.join(files, "document_id").select("x", F.explode(tags).alias("tag")).withColumn("threshold", F.explode(F.array(*[F.lit(v) for v in (0.03, 0.1)])))
    return each.groupBy("tag", "threshold").agg(F.count("*").alias("documents"), F.count_if(F.col("x") > F.col("threshold")).alias("over"), F.percentile("x", 0.5).alias("median"))


def population_reconciliation(spark, d):
    """Pages by provenance, and the residual against all pages, which must be 0."""
    kind = page_provenance(spark, d)
    count = lambda k: F.count_if(F.col("provenance") == k).alias(k)
    one = kind.agg(F.count("*").alias("pages"), *[count(k) for k in ("ocr", "native", "blank", "unknown")])
    return one.withColumn("residual", F.col("pages") - F.col("ocr") - F.col("native") - F.col("blank") - F.col("unknown"))


def page_provenance(spark, d):
    """Where the text of each page comes from: recognised, native, none or unknown, in this order."""
    t = table(spark, d, "page_census").groupBy("document_id", "physical_page").agg(
        F.bool_or(F.coalesce("is_t0_ocr", F.lit(False)) | F.coalesce("is_scanned", F.lit(False))).alias("ocr"), F.bool_or("is_native").alias("native"), F.max("char_count").alias("chars"))
    kind = F.when(F.col("ocr"), "ocr").when(F.col("native"), "native").when(F.col("chars") == 0, "blank").otherwise("unknown")
    return t.select("document_id", "physical_page", kind.alias("provenance"))


def document_provenance(spark, d):
    """native, ocr, mixed, unknown or empty, blank pages aside."""
    by = page_provenance(spark, d).groupBy("document_id").agg(*[F.count_if(F.col("provenance") == k).alias(k) for k in ("ocr", "native", "unknown")])
    o, n = F.col("ocr") > 0, F.col("native") > 0
    return by.withColumn("provenance", F.when(o & n, "mixed").when(o, "ocr").when(n, "native").when(F.col("unknown") > 0, "unknown").otherwise("empty"))


def length_buckets(spark, d):
    """Reports by length against the corpus' own quartiles and tails."""
    own = table(spark, d, "doc_records").filter("page_count is not null").groupBy("document_id").agg(F.max("page_count").alias("n"))
    q = own.agg(F.percentile("n", F.array(*[F.lit(x) for x in (0.25, 0.75, 0.9, 0.95)])).alias("q"))  # one row
    n, at = F.col("n"), lambda k: F.get("q", F.lit(k))
    bucket = F.when(n < at(0), "SHORT").when(n <= at(1), "MEDIUM").when(n <= at(2), "LONG").when(n <= at(3), "VERY_LONG").otherwise("EXTREME")
    return own.join(F.broadcast(q)).select("document_id", "n", bucket.alias("bucket"))


def scan_quality(spark, d):
    """Median picture share and share of scans by year and size of company."""
    files = table(spark, d, "doc_records").groupBy("document_id").agg(F.max("fiscal_year").alias("fy"))
    bands = table(spark, d, "cohort_companies").groupBy("company_id").agg(F.max("cap_band").alias("cap_band"))
    c = table(spark, d, "page_census").select("document_id", "company_id", "image_area_frac", "is_scanned").join(files, "document_id").join(bands, "company_id", "left")
    return c.groupBy("fy", "cap_band").agg(F.count("*").alias("pages"), F.percentile("image_area_frac", 0.5).alias("median_image"), F.count_if("is_scanned").alias("scans"))


def page_languages(spark, d):
    """Languages to recognise a page in, and its resolution kept between 200 and 400 from the size of the scan."""
    t = table(spark, d, "page_census").groupBy("document_id", "physical_page").agg(
        F.max("devanagari_count").alias("dev"), F.max("latin_count").alias("latin"), F.max("page_width").alias("w"))
    dev, latin = F.coalesce("dev", F.lit(0)), F.coalesce("latin", F.lit(0))
    language = F.when(dev * 20 >= dev + latin, F.when(dev > 0, "eng+hin").otherwise("eng")).otherwise("eng")
    dpi = F.coalesce(F.least(F.lit(400), F.greatest(F.lit(200), F.floor(F.lit(178500) / F.col("w")).cast("int"))), F.lit(300))
    return t.select("document_id", "physical_page", language.alias("language"), dpi.alias("dpi"))


def broken_text(spark, d):
    """Whether a page's text layer is broken, sound or cannot be told, by its share of replacement and private characters."""
    t = table(spark, d, "page_census").groupBy("document_id", "physical_page").agg(*[F.max(c).alias(c) for c in ("char_count", "replacement_char_count", "pua_count")])
    bad = F.col("replacement_char_count") + F.col("pua_count")
    told = F.when(F.col("char_count").isNull() | bad.isNull() | (F.col("char_count") < 120), None).otherwise(bad * 50 > F.col("char_count"))
    return t.select("document_id", "physical_page", told.alias("broken"))


def overlapping_blocks(spark, d):
    """Pairs among the first sixty blocks of a page that overlap, and the widest overlap, from the page's own array."""
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", F.slice("blocks", 1, 60).alias("b")).distinct().filter("b is not null")

    def area(x: Column, y: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(x["x1"], y["x1"]) - F.greatest(x["x0"], y["x0"])) * F.greatest(F.lit(0.0), F.least(x["y1"], y["y1"]) - F.greatest(x["y0"], y["y0"]))

    pairs = F.flatten(F.transform("b", lambda x, i: F.transform(F.slice(F.col("b"), i + 2, F.lit(60)), lambda y: area(x, y))))
    hit = F.filter(pairs, lambda a: a > 0)
    return pages.select("document_id", "page_no", F.size(hit).alias("overlaps"), F.coalesce(F.round(F.array_max(hit), 3), F.lit(0.0)).alias("widest"))


def column_gutters(spark, d):
    """Vertical bands of a page that few blocks cross: columns by a histogram of the blocks' extents, in the page's row."""
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", F.col("blocks").alias("boxes")).distinct().filter("size(boxes) >= 2")
    bins = F.sequence(F.lit(2), F.lit(37))
    low = lambda v: F.floor(v * 40 / 595.0)
    cover = F.transform(bins, lambda k: F.size(F.filter("boxes", lambda b: (low(b["x0"]) <= k) & (low(b["x1"]) >= k))))
    open_ = F.size(F.filter(cover, lambda n: n * 10 <= F.size("boxes")))
    return pages.select("document_id", "page_no", F.size("boxes").alias("blocks"), open_.alias("open_bins"))


def lexicon_share(spark, d):
    """Share of a recognised page's words that native texts use too, by a semi-join on different words."""
    word = lambda t: F.explode(F.regexp_extract_all(F.lower(t), F.lit("[a-z]{3,}"), F.lit(0)))
    known = table(spark, d, "documents").select(word("text").alias("w")).groupBy("w").agg(F.count("*").alias("n")).filter("n >= 3").select("w", F.lit(1).alias("hit"))
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "text").distinct().select("document_id", "page_no", word("text").alias("w"))
    by = pages.groupBy("document_id", "page_no", "w").agg(F.count("*").alias("n")).join(known, "w", "left")
    return by.groupBy("document_id", "page_no").agg(F.sum("n").alias("words"), F.sum(F.when(F.col("hit") == 1, F.col("n")).otherwise(0)).alias("known"))


def title_locations(spark, d):
    """The first page, within eight of an audited title's start and on, whose text names the title."""
    rows = table(spark, d, "input_rows").filter("body_title is not null and document_id is not null").select("document_id", "body_title").distinct()
    texts = table(spark, d, "documents").filter("document_id is not null").select("document_id", "physical_page", F.lower(F.concat_ws("\n", "section_title", "text")).alias("t"))
    hit = rows.join(texts, "document_id").filter(F.contains("t", F.lower("body_title")) & (F.col("physical_page") <= 8))
    return rows.join(hit.groupBy("document_id", "body_title").agg(F.min("physical_page").alias("page")), ["document_id", "body_title"], "left")


def audit_fallback(spark, d):
    """Audited rows with their split, the file's own where the audit names none, and where it came from."""
    files = table(spark, d, "doc_records").groupBy("document_id").agg(F.max(F.upper(F.trim("split"))).alias("file_split"))
    own = F.nullif(F.upper(F.trim("split")), F.lit(""))
    rows = table(spark, d, "input_rows").select("document_id", "start_page", own.alias("audit_split")).distinct().join(files, "document_id", "left")
    origin = F.when(F.col("audit_split").isNotNull(), "audit").when(F.col("file_split").isNotNull(), "file").otherwise("none")
    return rows.select("document_id", "start_page", F.coalesce("audit_split", "file_split").alias("split"), origin.alias("origin"))


def split_overlap(spark, d):
    """Companies with documents in both of two splits; each pair of splits should share none."""
    s = table(spark, d, "doc_records").filter("company_id is not null").select("company_id", F.upper(F.trim("split")).alias("s")).distinct()
    parts = {k: s.filter(F.col("s") == k).select("company_id") for k in ("FIT", "VALIDATION", "HOLDOUT")}
    pairs = [("FIT", "VALIDATION"), ("FIT", "HOLDOUT"), ("VALIDATION", "HOLDOUT")]
    return reduce(DataFrame.unionByName, [parts[a].intersect(parts[b]).agg(F.count("*").alias("companies")).select(F.lit(a).alias("a"), F.lit(b).alias("b"), "companies") for a, b in pairs])


def cell_minimum_sample(spark, d):
    """Of each company and condition of a page the unit with the least seeded hash; ties by document and page."""
    c = _conditions(spark, d).withColumn("rank", T.hash_rank(SEED, F.col("document_id"), F.col("physical_page")))
    best = F.min(F.struct("rank", "document_id", "physical_page")).alias("b")
    return c.groupBy("company_id", "condition").agg(best).select("company_id", "condition", "b.document_id", "b.physical_page")


def pilot_draw(spark, d):
    """A staged draw: five reports of a reserved hard stratum, ten of the rest, three of these again for a retest."""
    hard = table(spark, d, "page_census").groupBy("document_id").agg(F.bool_or(F.coalesce("is_t0_broken", F.lit(False)) | F.coalesce("is_bilingual_page", F.lit(False))).alias("hard"))
    docs = table(spark, d, "doc_records").filter("document_id is not null").select("document_id").distinct().join(hard, "document_id", "left")
    draw = lambda df, seed, k: df.withColumn("rank", T.hash_rank(seed, F.col("document_id"))).orderBy("rank", "document_id").limit(k)
    first = draw(docs.filter("hard"), "pilot-hard", 5).select("document_id", F.lit("hard").alias("stage"))
    rest = draw(docs.join(first, "document_id", "left_anti"), "pilot-rest", 10).select("document_id", F.lit("rest").alias("stage"))
    chosen = first.unionByName(rest)
    return chosen.unionByName(draw(chosen, "pilot-retest", 3).select("document_id", F.lit("retest").alias("stage")))


def review_manifest(spark, d):
    """At most forty reports to review: the five heaviest, then the heaviest of each company not seen yet."""
    own = table(spark, d, "doc_records").filter("document_id is not null").groupBy("document_id").agg(F.max("company_id").alias("company_id"), F.max("file_size_bytes").alias("bytes"))
    key = [F.desc_nulls_last("bytes"), F.col("document_id")]
    best = own.withColumn("r", F.row_number().over(Window.partitionBy("company_id").orderBy(*key))).filter("r = 1").drop("r")
    five = own.orderBy(*key).limit(5).withColumn("priority", F.lit(0))
    more = best.join(five.select("document_id"), "document_id", "left_anti").join(five.select("company_id").dropna().distinct(), "company_id", "left_anti").withColumn("priority", F.lit(1))
    return five.unionByName(more.select(five.columns)).orderBy("priority", *key).limit(40).select("document_id", "company_id", "priority")


def index_pages(spark, d):
    """Pages to read first: all of a short report that is mostly scans, else the front and two in six, at most sixty."""
    t = table(spark, d, "page_census").groupBy("document_id", "physical_page").agg(F.max("page_count").alias("n"), F.bool_or(F.coalesce("is_scanned", F.lit(False))).alias("scan"))
    by = t.groupBy("document_id").agg(F.max("n").alias("pages"), F.avg(F.col("scan").cast("int")).alias("share"))
    whole = (F.col("pages") <= 60) & (F.col("share") > 0.8)
    own = t.join(by, "document_id").filter(whole | (F.col("physical_page") < 14) | (F.col("physical_page") % 6).isin(0, 3))
    w = Window.partitionBy("document_id").orderBy("physical_page")
    return own.withColumn("r", F.row_number().over(w)).filter("r <= 60").select("document_id", "physical_page", F.coalesce(whole, F.lit(False)).alias("whole"))


def sampled_positions(spark, d):
    """Positions of pages at which a report's fonts are looked at: its ends and quarters."""
    n = F.col("n")
    at = F.array(F.lit(0), F.lit(1), F.lit(2), n - 1, n - 2, F.floor(n / 4).cast("int"), F.floor(n / 2).cast("int"), F.floor(n * 3 / 4).cast("int"))
    own = table(spark, d, "doc_records").filter("page_count > 0").groupBy("document_id").agg(F.max("page_count").alias("n"))
    return own.select("document_id", F.explode(F.array_distinct(F.filter(at, lambda p: p.between(0, F.col("n") - 1)))).alias("position"))


def pages_of_interest(spark, d):
    """Pages around the start and the end of audited spans and the first of the report, within the report."""
    size = table(spark, d, "doc_records").groupBy("document_id").agg(F.max("page_count").alias("n"))
    rows = table(spark, d, "input_rows").filter("start_page is not null").groupBy("document_id").agg(F.min("start_page").alias("s"), F.max("end_page").alias("e")).join(size, "document_id")
    around = lambda c: F.coalesce(F.sequence(c - 2, c + 2), F.array().cast("array<int>"))
    every = F.array_union(F.array_union(around(F.col("s")), around(F.col("e"))), F.array(F.lit(0), F.lit(1)))
    return rows.select("document_id", F.explode(F.filter(every, lambda p: p.between(0, F.col("n") - 1))).alias("page"))


def full_width_blocks(spark, d):
    """Whether a page has a block over six tenths of its text's width, which a cut into columns must not part."""
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", F.col("blocks").alias("b")).distinct().filter("size(b) > 0")
    side = lambda k: F.transform("b", lambda x: x[k])
    band = F.array_max(side("x1")) - F.array_min(side("x0"))
    widest = F.array_max(F.transform("b", lambda x: x["x1"] - x["x0"]))
    return pages.select("document_id", "page_no", F.size("b").alias("blocks"), (widest > band * 0.6).alias("full_width"))


def record_chains(spark, d):
    """The chain of an annotator's records of a report: first and standing one, length, and whether their seals part them all."""
    r = table(spark, d, "raw_records").filter("document_id is not null and annotator_role is not null").select("document_id", "annotator_role", "record_sha256", "sealed_at").distinct()
    key = F.struct("sealed_at", "record_sha256")
    by = r.groupBy("document_id", "annotator_role").agg(
        F.min_by("record_sha256", key).alias("first_record"), F.max_by("record_sha256", key).alias("standing_record"), F.count("*").alias("records"), F.count_distinct("sealed_at").alias("seals"))
    return by.withColumn("ordered", F.col("records") == F.col("seals")).drop("seals")


QUERIES = {f.__name__: f for f in (
    prediction_status, presence_scores, presence_table, gold_violations, label_precision, document_threshold_metrics, subgroup_stability,
    population_reconciliation, page_provenance, document_provenance, length_buckets, scan_quality, page_languages, broken_text, overlapping_blocks,
    column_gutters, lexicon_share, title_locations, audit_fallback, split_overlap, cell_minimum_sample, pilot_draw, review_manifest, index_pages,
    sampled_positions, pages_of_interest, full_width_blocks, record_chains,
)}

_STATUS = """gs AS (SELECT document_id, max(lower(trim(source_pdf_sha256))) AS gold_sha FROM raw_records WHERE document_id IS NOT NULL GROUP BY 1),
fi AS (SELECT document_id, max(lower(trim(sha256))) AS sha, max(page_count) AS n, bool_and(sha256_verified) AS verified FROM doc_records GROUP BY 1),
ro AS (SELECT document_id, count(*) AS c, max(start_page) AS s, max(end_page) AS e, max(body_title) AS title FROM input_rows GROUP BY 1),
ps AS (SELECT document_id, CASE WHEN c IS NULL THEN 'NO_OUTPUT' WHEN c > 1 THEN 'DUPLICATE' WHEN sha IS NULL OR gold_sha IS NULL OR sha <> gold_sha THEN 'IDENTITY_INVALID' WHEN NOT verified THEN 'QUARANTINE'
    WHEN e IS NULL AND title IS NULL THEN 'NOT_LOCATED' WHEN s IS NULL OR e IS NULL OR n IS NULL OR n <= 0 THEN 'TYPE_INVALID' WHEN s > e THEN 'ORDER_INVALID' WHEN s < 0 OR e >= n THEN 'RANGE_INVALID' ELSE 'VALID' END AS status
    FROM gs LEFT JOIN ro USING (document_id) LEFT JOIN fi USING (document_id))"""
_GOLD = _ST + """, gn AS (SELECT document_id, state, count(*) AS n FROM st WHERE state IN ('PRESENT', 'ABSENT', 'AMBIGUOUS') GROUP BY ALL),
go AS (SELECT document_id, arg_max(state, (n, -list_position(['PRESENT', 'ABSENT', 'AMBIGUOUS'], state))) AS gold_state FROM gn GROUP BY 1)"""
_PROV = """pv AS (SELECT document_id, physical_page, CASE WHEN bool_or(coalesce(is_t0_ocr, false) OR coalesce(is_scanned, false)) THEN 'ocr' WHEN bool_or(is_native) THEN 'native' WHEN max(char_count) = 0 THEN 'blank' ELSE 'unknown' END AS provenance
    FROM page_census GROUP BY ALL)"""
_D = lambda x: f"CASE WHEN {x[1]} <> 0 THEN ({x[0]}) / ({x[1]}) END"
ORACLES = {
    "prediction_status": f"WITH {_STATUS} SELECT * FROM ps",
    "presence_scores": f"""WITH {_STATUS}, {_GOLD}, b AS (SELECT count_if(gold_state = 'PRESENT' AND status = 'VALID') AS tp, count_if(gold_state = 'PRESENT' AND status <> 'VALID') AS fn,
        count_if(gold_state = 'ABSENT' AND status <> 'NOT_LOCATED') AS fp, count_if(gold_state = 'ABSENT' AND status = 'NOT_LOCATED') AS tn, count_if(gold_state = 'AMBIGUOUS') AS ambiguous FROM go JOIN ps USING (document_id))
        SELECT *, {_D(('tp', 'tp + fn'))} AS sensitivity, {_D(('tn', 'tn + fp'))} AS specificity, {_D(('tp + tn', 'tp + tn + fp + fn'))} AS accuracy FROM b""",
    "presence_table": f"WITH {_STATUS}, {_GOLD} SELECT gold_state, CASE WHEN status = 'VALID' THEN 'PRESENT' WHEN status = 'NOT_LOCATED' THEN 'NOT_LOCATED' ELSE 'FAILED' END AS outcome, count(*) AS documents FROM go JOIN ps USING (document_id) GROUP BY ALL",
    "gold_violations": """WITH p AS (SELECT document_id, max(page_count) AS n FROM doc_records GROUP BY 1), r AS (SELECT x.*, n, primary_span.start_page AS s, primary_span.end_page AS e, coalesce(flags, []) AS fl FROM (SELECT DISTINCT * FROM raw_records) x LEFT JOIN p USING (document_id))
        SELECT record_sha256, unnest(list_filter([CASE WHEN NOT coalesce(regexp_matches(document_id, '^[A-Za-z0-9._-]{1,256}$'), false) THEN 'document_id' END, CASE WHEN NOT coalesce(regexp_matches(source_pdf_sha256, '^[0-9a-f]{64}$'), false) THEN 'source_hash' END,
        CASE WHEN NOT coalesce(regexp_matches(record_sha256, '^[0-9a-f]{64}$'), false) THEN 'record_hash' END, CASE WHEN NOT coalesce(presence_state IN ('PRESENT', 'ABSENT', 'AMBIGUOUS'), false) THEN 'state' END,
        CASE WHEN NOT coalesce(record_type IN ('RAW', 'ADJUDICATED'), false) THEN 'record_type' END, CASE WHEN NOT coalesce(regexp_matches(annotator_role, '^ANNOTATOR_[A-Z]$'), false) THEN 'role' END,
        CASE WHEN NOT coalesce(n > 0, false) THEN 'page_count' END, CASE WHEN sealed_at IS NULL THEN 'unsealed' END, CASE WHEN presence_state = 'PRESENT' AND NOT coalesce(n > 0 AND s >= 0 AND s <= e AND e < n, false) THEN 'present_span' END,
        CASE WHEN presence_state <> 'PRESENT' AND primary_span IS NOT NULL THEN 'span_without_presence' END, CASE WHEN presence_state = 'ABSENT' AND list_contains(fl, 'GAP_PAGES') THEN 'absent_gaps' END,
        CASE WHEN len(list_distinct(fl)) <> len(fl) THEN 'repeated_flags' END, CASE WHEN flags IS NULL THEN 'flags_missing' END, CASE WHEN list_contains(fl, 'GAP_PAGES') AND e - s < 2 THEN 'gap_outside_span' END], lambda x: x IS NOT NULL)) AS rule FROM r""",
    "label_precision": f"""WITH {_LA}, x AS (SELECT *, abs(true_start_page - proposed_start_page) AS off, CASE WHEN verified_by = 'read_pdf' THEN 1 ELSE 0 END + CASE WHEN classification_status = 'clear' THEN 1 ELSE 0 END
        + CASE WHEN heading_page = proposed_start_page THEN 1 ELSE 0 END AS k FROM la WHERE proposed_start_page IS NOT NULL AND true_start_page IS NOT NULL), y AS (SELECT *, CASE WHEN k >= 3 THEN '3+' ELSE k::VARCHAR END AS support FROM x),
        g AS (SELECT heading_form, support, doc_kind, grouping_id(heading_form, support, doc_kind) AS gid, count(*) AS n, count_if(off <= 1) AS within_1, count_if(off = 0) AS exact FROM y GROUP BY GROUPING SETS ((heading_form), (support), (doc_kind)))
        SELECT *, within_1 / n AS precision FROM g""",
    "document_threshold_metrics": _ORDER + """, p AS (SELECT document_id, orphans / paragraphs AS x FROM od WHERE document_id IS NOT NULL AND paragraphs >= 2),
        b AS (SELECT threshold, document_id, count(*) AS pages, count_if(x > threshold) AS bad FROM p, (SELECT unnest([0.03, 0.1, 0.2])::DOUBLE AS threshold) GROUP BY ALL)
        SELECT threshold, count(*) AS documents, """ + ", ".join(f"count_if(bad * 100 >= pages * {k}) AS over_{k}" for k in (5, 10, 25, 50)) + " FROM b GROUP BY 1",
    "subgroup_stability": _ORDER + """, g AS (SELECT document_id, sum(orphans) / greatest(sum(paragraphs), 1) AS x FROM od WHERE document_id IS NOT NULL GROUP BY 1),
        f AS (SELECT document_id, max(fiscal_year) AS y, max(producer) AS producer, max(page_count) AS n FROM doc_records GROUP BY 1),
        e AS (SELECT x, unnest(list_filter(['all', CASE WHEN y < 2014 THEN '2010-2013' WHEN y < 2019 THEN '2014-2018' ELSE '2019-2025' END, 'producer ' || producer, CASE WHEN n > 200 THEN 'long' END, CASE WHEN n <= 60 THEN 'short' END], lambda t: t IS NOT NULL)) AS tag FROM g JOIN f USING (document_id))
        SELECT tag, threshold, count(*) AS documents, count_if(x > threshold) AS "over", quantile_cont(x, 0.5) AS median FROM e, (SELECT unnest([0.03, 0.1])::DOUBLE AS threshold) GROUP BY ALL""",
    "population_reconciliation": f"WITH {_PROV} SELECT count(*) AS pages, count_if(provenance = 'ocr') AS ocr, count_if(provenance = 'native') AS native, count_if(provenance = 'blank') AS blank, count_if(provenance = 'unknown') AS unknown, 0 AS residual FROM pv",
    "page_provenance": f"WITH {_PROV} SELECT * FROM pv",
    "document_provenance": f"""WITH {_PROV}, g AS (SELECT document_id, count_if(provenance = 'ocr') AS ocr, count_if(provenance = 'native') AS native, count_if(provenance = 'unknown') AS unknown FROM pv GROUP BY 1)
        SELECT *, CASE WHEN ocr > 0 AND native > 0 THEN 'mixed' WHEN ocr > 0 THEN 'ocr' WHEN native > 0 THEN 'native' WHEN unknown > 0 THEN 'unknown' ELSE 'empty' END AS provenance FROM g""",
    "full_width_blocks": """WITH p AS (SELECT DISTINCT document_id, page_no, blocks AS b FROM ocr_pages WHERE len(blocks) > 0)
        SELECT document_id, page_no, CAST(len(b) AS INT) AS blocks, list_max(list_transform(b, lambda x: x.x1 - x.x0)) > (list_max(list_transform(b, lambda x: x.x1)) - list_min(list_transform(b, lambda x: x.x0))) * 0.6 AS full_width FROM p""",
    "record_chains": """WITH r AS (SELECT DISTINCT document_id, annotator_role, record_sha256, sealed_at FROM raw_records WHERE document_id IS NOT NULL AND annotator_role IS NOT NULL),
        k AS (SELECT *, row_number() OVER (PARTITION BY document_id, annotator_role ORDER BY sealed_at NULLS FIRST, record_sha256) AS a, row_number() OVER (PARTITION BY document_id, annotator_role ORDER BY sealed_at DESC NULLS LAST, record_sha256 DESC) AS z FROM r)
        SELECT document_id, annotator_role, max(CASE WHEN a = 1 THEN record_sha256 END) AS first_record, max(CASE WHEN z = 1 THEN record_sha256 END) AS standing_record, count(*) AS records, count(*) = count(DISTINCT sealed_at) AS ordered FROM k GROUP BY ALL""",
    "length_buckets": """WITH o AS (SELECT document_id, max(page_count) AS n FROM doc_records WHERE page_count IS NOT NULL GROUP BY 1), q AS (SELECT quantile_cont(n, [0.25, 0.75, 0.9, 0.95]) AS q FROM o)
        SELECT document_id, n, CASE WHEN n < q[1] THEN 'SHORT' WHEN n <= q[2] THEN 'MEDIUM' WHEN n <= q[3] THEN 'LONG' WHEN n <= q[4] THEN 'VERY_LONG' ELSE 'EXTREME' END AS bucket FROM o, q""",
    "scan_quality": """WITH f AS (SELECT document_id, max(fiscal_year) AS fy FROM doc_records GROUP BY 1), b AS (SELECT company_id, max(cap_band) AS cap_band FROM cohort_companies GROUP BY 1)
        SELECT fy, cap_band, count(*) AS pages, quantile_cont(image_area_frac, 0.5) AS median_image, count_if(is_scanned) AS scans FROM page_census JOIN f USING (document_id) LEFT JOIN b USING (company_id) GROUP BY ALL""",
    "page_languages": """WITH t AS (SELECT document_id, physical_page, coalesce(max(devanagari_count), 0) AS dev, coalesce(max(latin_count), 0) AS latin, max(page_width) AS w FROM page_census GROUP BY ALL)
        SELECT document_id, physical_page, CASE WHEN dev > 0 AND dev * 20 >= dev + latin THEN 'eng+hin' ELSE 'eng' END AS language, CAST(coalesce(CASE WHEN w IS NOT NULL THEN least(400, greatest(200, floor(178500 / w))) END, 300) AS INT) AS dpi FROM t""",
    "broken_text": """WITH t AS (SELECT document_id, physical_page, max(char_count) AS c, max(replacement_char_count) + max(pua_count) AS bad FROM page_census GROUP BY ALL)
        SELECT document_id, physical_page, CASE WHEN c >= 120 AND bad IS NOT NULL THEN bad * 50 > c END AS broken FROM t""",
    "overlapping_blocks": """WITH p AS (SELECT DISTINCT document_id, page_no, blocks[1:60] AS b FROM ocr_pages WHERE blocks IS NOT NULL), u AS (SELECT row_number() OVER () AS id, * FROM p), e AS (SELECT id, unnest(b) AS x, generate_subscripts(b, 1) AS i FROM u),
        a AS (SELECT l.id, greatest(0, least(l.x.x1, r.x.x1) - greatest(l.x.x0, r.x.x0)) * greatest(0, least(l.x.y1, r.x.y1) - greatest(l.x.y0, r.x.y0)) AS area FROM e l JOIN e r ON l.id = r.id AND l.i < r.i)
        SELECT document_id, page_no, CAST(count(area) AS INT) AS overlaps, coalesce(round(max(area), 3), 0.0) AS widest FROM u LEFT JOIN (SELECT * FROM a WHERE area > 0) USING (id) GROUP BY id, document_id, page_no""",
    "column_gutters": """WITH p AS (SELECT DISTINCT document_id, page_no, blocks FROM ocr_pages WHERE len(blocks) >= 2)
        SELECT document_id, page_no, CAST(len(blocks) AS INT) AS blocks, CAST(len(list_filter(range(2, 38), lambda k: len(list_filter(blocks, lambda b: floor(b.x0 * 40 / 595.0) <= k AND floor(b.x1 * 40 / 595.0) >= k)) * 10 <= len(blocks))) AS INT) AS open_bins FROM p""",
    "lexicon_share": """WITH k AS (SELECT w FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM documents) GROUP BY 1 HAVING count(*) >= 3),
        p AS (SELECT document_id, page_no, unnest(regexp_extract_all(lower(text), '[a-z]{3,}')) AS w FROM (SELECT DISTINCT document_id, page_no, text FROM ocr_pages))
        SELECT document_id, page_no, count(*) AS words, count(k.w) AS known FROM p LEFT JOIN k USING (w) GROUP BY ALL""",
    "title_locations": """WITH r AS (SELECT DISTINCT document_id, body_title FROM input_rows WHERE body_title IS NOT NULL AND document_id IS NOT NULL)
        SELECT document_id, body_title, (SELECT min(physical_page) FROM documents t WHERE t.document_id = r.document_id AND physical_page <= 8 AND contains(lower(concat_ws(chr(10), section_title, text)), lower(body_title))) AS page FROM r""",
    "audit_fallback": """WITH f AS (SELECT document_id, max(upper(trim(split))) AS fs FROM doc_records GROUP BY 1), r AS (SELECT DISTINCT document_id, start_page, nullif(upper(trim(split)), '') AS a FROM input_rows)
        SELECT document_id, start_page, coalesce(a, fs) AS split, CASE WHEN a IS NOT NULL THEN 'audit' WHEN fs IS NOT NULL THEN 'file' ELSE 'none' END AS origin FROM r LEFT JOIN f USING (document_id)""",
    "split_overlap": " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, (SELECT count(*) FROM (SELECT company_id FROM doc_records WHERE company_id IS NOT NULL AND upper(trim(split)) = '{a}' INTERSECT SELECT company_id FROM doc_records WHERE upper(trim(split)) = '{b}')) AS companies"
        for a, b in (("FIT", "VALIDATION"), ("FIT", "HOLDOUT"), ("VALIDATION", "HOLDOUT"))
    ),
    "cell_minimum_sample": f"""WITH {_CO}, h AS (SELECT *, {_HASH.format('document_id, physical_page::VARCHAR')} AS rank FROM co), m AS (SELECT company_id, condition, min((rank, document_id, physical_page)) AS b FROM h GROUP BY ALL)
        SELECT company_id, condition, b[2] AS document_id, b[3] AS physical_page FROM m""",
    "pilot_draw": """WITH h AS (SELECT document_id, bool_or(coalesce(is_t0_broken, false) OR coalesce(is_bilingual_page, false)) AS hard FROM page_census GROUP BY 1), d AS (SELECT DISTINCT document_id FROM doc_records WHERE document_id IS NOT NULL),
        a AS (SELECT document_id, 'hard' AS stage FROM d JOIN h USING (document_id) WHERE hard ORDER BY sha256(concat_ws(chr(0), 'pilot-hard', document_id)), document_id LIMIT 5),
        b AS (SELECT document_id, 'rest' AS stage FROM d WHERE document_id NOT IN (SELECT document_id FROM a) ORDER BY sha256(concat_ws(chr(0), 'pilot-rest', document_id)), document_id LIMIT 10),
        c AS (SELECT * FROM a UNION ALL SELECT * FROM b) SELECT * FROM c UNION ALL SELECT * FROM (SELECT document_id, 'retest' AS stage FROM c ORDER BY sha256(concat_ws(chr(0), 'pilot-retest', document_id)), document_id LIMIT 3)""",
    "review_manifest": """WITH o AS (SELECT document_id, max(company_id) AS company_id, max(file_size_bytes) AS bytes FROM doc_records WHERE document_id IS NOT NULL GROUP BY 1), f AS (SELECT *, 0 AS priority FROM o ORDER BY bytes DESC NULLS LAST, document_id LIMIT 5),
        m AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY bytes DESC NULLS LAST, document_id) AS r FROM o), u AS (SELECT * FROM f UNION ALL SELECT document_id, company_id, bytes, 1 FROM m WHERE r = 1 AND document_id NOT IN (SELECT document_id FROM f)
        AND NOT EXISTS (SELECT 1 FROM f WHERE f.company_id = m.company_id)) SELECT document_id, company_id, priority FROM u ORDER BY priority, bytes DESC NULLS LAST, document_id LIMIT 40""",
    "index_pages": """WITH t AS (SELECT document_id, physical_page, max(page_count) AS n, bool_or(coalesce(is_scanned, false)) AS scan FROM page_census GROUP BY ALL), b AS (SELECT document_id, max(n) <= 60 AND avg(scan::INT) > 0.8 AS whole FROM t GROUP BY 1),
        r AS (SELECT document_id, physical_page, coalesce(whole, false) AS whole, row_number() OVER (PARTITION BY document_id ORDER BY physical_page) AS r FROM t JOIN b USING (document_id) WHERE whole OR physical_page < 14 OR physical_page % 6 IN (0, 3)) SELECT document_id, physical_page, whole FROM r WHERE r <= 60""",
    "sampled_positions": """WITH o AS (SELECT document_id, max(page_count) AS n FROM doc_records WHERE page_count > 0 GROUP BY 1), p AS (SELECT document_id, n, unnest([0, 1, 2, n - 1, n - 2, n // 4, n // 2, n * 3 // 4])::INT AS position FROM o)
        SELECT DISTINCT document_id, position FROM p WHERE position BETWEEN 0 AND n - 1""",
    "pages_of_interest": """WITH z AS (SELECT document_id, max(page_count) AS n FROM doc_records GROUP BY 1), r AS (SELECT document_id, min(start_page) AS s, max(end_page) AS e FROM input_rows WHERE start_page IS NOT NULL GROUP BY 1),
        p AS (SELECT document_id, n, unnest(list_concat(range(s - 2, s + 3), coalesce(range(e - 2, e + 3), []), [0, 1]))::INT AS page FROM r JOIN z USING (document_id)) SELECT DISTINCT document_id, page FROM p WHERE page BETWEEN 0 AND n - 1""",
}
