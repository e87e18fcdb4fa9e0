"""Pages and texts: routing, recognition quality, furniture, paragraphs, reading order, section checks."""

from __future__ import annotations

from foliant.config import GATE, SECTION, TRIAGE
from foliant.functions import patterns as P
from foliant.functions import text as T
from foliant.operators import lines as L
from foliant.session import table
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _census(spark, d) -> DataFrame:
    """One profile per page: the latest, ties by counts."""
    w = Window.partitionBy("document_id", "physical_page").orderBy(
        F.col("profiled_at").desc_nulls_last(), F.col("char_count").desc_nulls_last(), F.col("image_area_frac").desc_nulls_last()
    )
    return table(spark, d, "page_census").withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _kind() -> Column:
    chars, image, paths = F.coalesce("char_count", F.lit(0)), F.coalesce("image_area_frac", F.lit(0.0)), F.coalesce("drawings_line_count", F.lit(0))
    bad = F.coalesce("replacement_char_count", F.lit(0)) / F.greatest(chars, F.lit(1))
    t = TRIAGE
    return (
        F.when((chars < t.blank_chars) & (image < t.blank_image) & (paths < t.blank_drawings), "blank")
        .when((chars >= t.min_chars) & (bad > t.max_mojibake), "broken_text")
        .when((chars < t.min_chars) & (image >= t.big_image), "scanned")
        .when((chars < t.min_chars) & (paths >= t.vector_paths), "vector_text")
        .when((chars < t.min_chars) & (image >= t.hybrid_image), "scanned")
        .when(chars < t.blank_chars, "blank")
        .when((chars >= t.min_chars) & (chars < t.dense_chars) & (image >= t.hybrid_image), "hybrid")
        .otherwise("digital")
    )


def page_triage(spark, d):
    """The kind of each page by text, image and drawing measures, and whether it needs recognition."""
    out = _census(spark, d).select("document_id", "physical_page", _kind().alias("kind"))
    return out.withColumn("needs_ocr", F.col("kind").isin("scanned", "broken_text", "vector_text", "hybrid"))


_KIND_SQL = """
WITH c0 AS (SELECT *, row_number() OVER (PARTITION BY document_id, physical_page ORDER BY profiled_at DESC NULLS LAST,
    char_count DESC NULLS LAST, image_area_frac DESC NULLS LAST) AS rn FROM page_census),
c AS (SELECT *, coalesce(char_count, 0) AS ch, coalesce(image_area_frac, 0.0) AS im, coalesce(drawings_line_count, 0) AS pa,
    coalesce(replacement_char_count, 0) / greatest(coalesce(char_count, 0), 1) AS bad FROM c0 WHERE rn = 1),
k AS (SELECT document_id, company_id, physical_page, devanagari_count, latin_count, CASE WHEN ch < 15 AND im < 0.05 AND pa < 20 THEN 'blank' WHEN ch >= 120 AND bad > 0.02 THEN 'broken_text'
    WHEN ch < 120 AND im >= 0.55 THEN 'scanned' WHEN ch < 120 AND pa >= 400 THEN 'vector_text' WHEN ch < 120 AND im >= 0.25 THEN 'scanned'
    WHEN ch < 15 THEN 'blank' WHEN ch >= 120 AND ch < 600 AND im >= 0.25 THEN 'hybrid' ELSE 'digital' END AS kind FROM c)
"""
_NEEDS = "kind IN ('scanned', 'broken_text', 'vector_text', 'hybrid')"


def doc_kind_rollup(spark, d):
    """Kind of a document by the share of pages with content that need recognition; bilingual by script shares."""
    pages = _census(spark, d).select("document_id", _kind().alias("kind"), "devanagari_count", "latin_count")
    needs = F.col("kind").isin("scanned", "broken_text", "vector_text", "hybrid")
    full = F.col("kind") != "blank"
    known = full & (F.coalesce("devanagari_count", F.lit(0)) + F.coalesce("latin_count", F.lit(0)) > 0)
    indic = known & (F.col("devanagari_count") * 20 >= F.coalesce("latin_count", F.lit(0)) + F.col("devanagari_count"))
    by = pages.groupBy("document_id").agg(
        F.count("*").alias("pages"), F.count_if(full).alias("content"), F.count_if(needs).alias("to_read"),
        F.count_if(known).alias("known"), F.count_if(indic).alias("indic"),
    )
    share = F.col("to_read") / F.greatest("content", F.lit(1))
    part = F.when(F.col("known") > 0, F.col("indic") / F.col("known"))
    return by.select(
        "document_id", "pages", "content", "to_read",
        F.when(share >= TRIAGE.doc_scanned, "scanned").when(share <= TRIAGE.doc_digital, "digital").otherwise("mixed").alias("doc_kind"),
        F.coalesce(part.between(0.08, 0.92), F.lit(False)).alias("bilingual"),
    )


def script_profile(spark, d):
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select(
        "doc_id", T.script(t).alias("script"), T.hits(t, T.DEVANAGARI).alias("devanagari"), T.hits(t, T.INDIC).alias("indic"),
        T.hits(t, "[A-Za-z]").alias("latin"),
    )


def quality_gate(spark, d):
    """First reason to refuse a recognised page: few words, low confidence, symbols, run-on tokens, one line over and over.

    Letters, marks and digits of every script are no symbols.
    """
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "text", "mean_conf", "engine").distinct()
    words, chars = T.word_count(F.col("text")), F.length("text")
    good = T.hits(F.col("text"), r"[\p{L}\p{M}\p{N}\s]")
    same = L.longest_run(F.filter(F.transform(F.split("text", "\r?\n"), lambda x: F.trim(x)), lambda x: x != ""))
    long = T.hits(F.col("text"), r"[^ \t\n\r\f]{31,}")
    reason = F.coalesce(
        F.when(words < GATE.min_words, "too_few_words"),
        F.when(F.col("mean_conf") / 100 < GATE.min_conf, "low_conf"),
        F.when(good < chars * (1 - GATE.max_symbols), "high_symbol_noise"),
        F.when(long > F.greatest(F.lit(3.0), words * 0.02), "run_on_tokens"),
        F.when(same >= GATE.repeat_run, "degenerate"),
        F.lit("ok"),
    )
    return pages.select("document_id", "page_no", "engine", words.alias("n_words"), reason.alias("verdict"))


def degenerate_line_runs(spark, d):
    """The longest run of identical lines of each text, and whether it looks degenerate."""
    full = F.filter(F.transform(F.split("text", "\r?\n"), lambda x: F.trim(x)), lambda x: x != "")
    longest = table(spark, d, "documents").select("doc_id", L.longest_run(full).alias("longest")).filter("longest is not null")
    return longest.withColumn("degenerate", F.col("longest") >= GATE.repeat_run)


def running_furniture(spark, d):
    """Headers and footers that recur on enough different pages of a document; the profiled pages are few, so two are enough."""
    c = table(spark, d, "page_census")
    both = c.select("document_id", "physical_page", F.explode(F.array(
        F.struct(F.lit("top").alias("place"), F.col("top_furniture_text").alias("line")),
        F.struct(F.lit("bottom").alias("place"), F.col("bottom_furniture_text").alias("line")))).alias("x"))
    key = T.furniture_key(F.col("x.line"))
    pages = c.groupBy("document_id").agg(F.count_distinct("physical_page").alias("pages"))
    by = both.select("document_id", "physical_page", "x.place", key.alias("form")).filter("form <> ''")
    counts = by.groupBy("document_id", "place", "form").agg(F.count_distinct("physical_page").alias("on_pages"))
    least = F.greatest(F.lit(2), F.floor(F.col("pages") * SECTION.furniture_share))
    return counts.join(pages, "document_id").filter(F.col("on_pages") >= least)


def adjacent_headers(spark, d):
    """Headers that resemble the next page's, by edit distance."""
    w = Window.partitionBy("document_id").orderBy("physical_page")
    own = _census(spark, d).select("document_id", "physical_page", F.lower(F.trim("top_furniture_text")).alias("header"))
    after = own.withColumn("next_header", F.lead("header").over(w)).withColumn("next_page", F.lead("physical_page").over(w))
    far = F.levenshtein("header", "next_header")
    return after.filter("header <> '' and next_header <> '' and next_page = physical_page + 1").select(
        "document_id", "physical_page", far.alias("distance"), (far * 5 <= F.length("header")).alias("similar")
    )


def paragraph_reconstruction(spark, d):
    paras = L.paragraphs(table(spark, d, "documents"), ["doc_id"])
    return paras.select("doc_id", "para_no", "first_line", F.md5("paragraph").alias("digest"))


def _order(spark, d) -> DataFrame:
    keys = ["doc_id", "document_id", "physical_page"]
    paras = F.transform(L.paragraph_array(F.col("text")), lambda p: p["paragraph"])
    own = table(spark, d, "documents").select(*keys, paras.alias("p")).filter("size(p) > 0")
    flags = own.select(*keys, L.order_flags(F.col("p")).alias("f"))
    count = lambda k: F.size(F.filter("f", lambda x: x[k])).cast("long")
    return flags.select(*keys, F.size("f").cast("long").alias("paragraphs"), count("orphan").alias("orphans"), count("dangling").alias("danglers"))


def order_quality_doc(spark, d):
    """Orphaned and dangling paragraphs per text; shares only from five paragraphs on."""
    enough = F.col("paragraphs") >= SECTION.least_paragraphs
    return _order(spark, d).select("doc_id", "paragraphs", "orphans", "danglers", F.when(enough, F.col("orphans") / F.col("paragraphs")).otherwise(0.0).alias("orphan_share"))


def order_quality_hidden(spark, d):
    """Reports with a bad page that the whole report's score hides."""
    pages = _order(spark, d).withColumn("share", F.when(F.col("paragraphs") >= 2, F.col("orphans") / F.col("paragraphs")))
    by = pages.groupBy("document_id").agg(F.sum("orphans").alias("o"), F.sum("paragraphs").alias("p"), F.max("share").alias("worst_page"), F.count("*").alias("pages"))
    whole = F.col("o") / F.greatest("p", F.lit(1))
    return by.select("document_id", "pages", whole.alias("whole"), "worst_page", ((F.col("worst_page") > SECTION.orphan_gate) & (whole <= SECTION.orphan_gate)).alias("hidden"))


def threshold_sweep(spark, d):
    """Texts below, at and above several thresholds of the orphan share, and the gap around each."""
    own = order_quality_doc(spark, d).select("orphan_share")
    x, y = F.col("orphan_share"), F.col("threshold")
    both = own.withColumn("threshold", F.explode(F.array(*[F.lit(v) for v in (0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.2)])))
    return both.groupBy("threshold").agg(
        F.count_if(x < y).alias("below"), F.count_if(x == y).alias("equal"), F.count_if(x > y).alias("above"),
        F.max(F.when(x <= y, x)).alias("last_below"), F.min(F.when(x > y, x)).alias("first_above"),
    )


def score_percentiles(spark, d):
    """Interpolated percentiles of text lengths per source."""
    qs = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
    p = F.percentile("n_chars", F.array(*[F.lit(q) for q in qs]))
    by = table(spark, d, "documents").groupBy("source").agg(F.count("n_chars").alias("n"), p.alias("p"))
    return by.select("source", "n", *[F.get("p", F.lit(k)).alias(f"p{int(q * 100)}") for k, q in enumerate(qs)])


def section_qc(spark, d):
    """Counts and shares that tell prose from tables, and reasons to doubt a text."""
    t = F.coalesce("text", F.lit(""))
    words, chars, digits, letters = T.word_count(t), F.length(t), T.hits(t, "[0-9]"), T.hits(t, "[A-Za-zऀ-ॿ઀-૿]")
    long = T.hits(t, r"[^ \t\n\r\f]{29,}")
    base = table(spark, d, "documents").select("doc_id", words.alias("n_words"), chars.alias("n_chars"), digits.alias("digits"), letters.alias("letters"), long.alias("long_tokens"))
    reasons = F.array_compact(F.array(
        F.when(F.col("n_words") < SECTION.too_short, "too_short"), F.when(F.col("n_words") > SECTION.too_long, "too_long"),
        F.when(F.col("digits") / F.greatest(F.col("letters") + F.col("digits"), F.lit(1)) > SECTION.table_digits, "looks_like_tables"),
        F.when(F.col("long_tokens") * 50 > F.col("n_words"), "run_on_tokens")))
    return base.withColumn("reasons", F.array_join(reasons, ","))


def leak_detection(spark, d):
    """Tags of passages of other sections that a text holds, one pass over the text for all; empty without any."""
    low = F.lower(F.coalesce("text", F.lit("")))
    tags = F.array_compact(F.array(*[F.when(low.rlike(p), F.lit(tag)) for p, tag in P.LEAKS]))
    return table(spark, d, "documents").select("doc_id", F.array_join(tags, ",").alias("leaks"))


def _cue_pages(spark, d) -> DataFrame:
    score = sum((T.hits(F.concat_ws("\n", "section_title", "text"), "(?i)" + c) for c in P.BODY_CUES), F.lit(0))
    pages = table(spark, d, "documents").filter("document_id is not null and physical_page is not null")
    return pages.groupBy("document_id", "physical_page").agg(F.sum(F.least(score, F.lit(4))).alias("cues"))


def body_cue_best_run(spark, d):
    """The stretch of at most 60 pages with most cues, a page costing as much as one and a half cues.

    Best contiguous run by prefix sums: the largest rise of the running sum over a bounded frame.
    """
    w = Window.partitionBy("document_id").orderBy("physical_page")
    own = _cue_pages(spark, d).withColumn("gain", F.col("cues") * 2 - 3)
    run = own.withColumn("total", F.sum("gain").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    low = F.min(F.struct((F.col("total") - F.col("gain")).alias("before"), F.col("physical_page"))).over(w.rowsBetween(-59, 0))
    scored = run.withColumn("low", low).withColumn("score", F.col("total") - F.col("low.before"))
    best = F.max_by(F.struct(F.col("low.physical_page").alias("start_page"), F.col("physical_page").alias("end_page"), "score"),
                    F.struct("score", -F.col("physical_page")))
    return scored.groupBy("document_id").agg(best.alias("b")).select("document_id", "b.start_page", "b.end_page", "b.score")


def language_windows(spark, d):
    """Windows of 2,000 characters over whole texts: which are mostly Devanagari, and the worst per text."""
    wins = L.text_windows(table(spark, d, "documents").select("doc_id", "text"), ["doc_id"], SECTION.window)
    dev, n = T.hits(F.col("chunk"), T.DEVANAGARI), F.length("chunk")
    m = wins.select("doc_id", "start", dev.alias("dev"), n.alias("n"))
    fired = F.col("dev") * 50 > F.col("n")
    return m.groupBy("doc_id").agg(
        F.count("*").alias("windows"), F.count_if(fired).alias("fired"), F.sum("dev").alias("devanagari"),
        F.max_by("start", F.struct(F.col("dev") / F.col("n"), -F.col("start"))).alias("worst_start"),
    )


def fiscal_year_vote(spark, d):
    """The year a text speaks of: years in brackets weigh 2, others 1; the heaviest wins, then the first."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    both = None
    for weight, pattern in ((2, r"\((20[0-2][0-9])\)"), (1, r"\b(20[0-2][0-9])\b")):
        part = docs.select("doc_id", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("k", "year")).withColumn("w", F.lit(weight))
        both = part if both is None else both.unionByName(part)
    votes = both.groupBy("doc_id", F.col("year").cast("int").alias("year")).agg(F.sum("w").alias("weight"), F.min("k").alias("first"))
    best = F.max_by(F.struct("year", "weight"), F.struct("weight", -F.col("first"), -F.col("year")))
    return votes.groupBy("doc_id").agg(best.alias("b")).select("doc_id", "b.year", "b.weight")


def table_runs(spark, d):
    """Runs of at least three lines of figures: where tables stand in a text."""
    full = F.filter(F.split("text", "\r?\n"), lambda x: F.trim(x) != "")
    figures = F.transform(full, lambda x: T.hits(x, "[0-9]") * 2 >= T.hits(x, "[A-Za-zऀ-ॿ઀-૿]"))
    runs = table(spark, d, "documents").select("doc_id", F.explode(L.true_runs(figures)).alias("r"))
    return runs.select("doc_id", "r.first", "r.length").filter("length >= 3")


def dehyphenated_lines(spark, d):
    """Words broken over lines of recognised pages, joined."""
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "text").distinct()
    joined = F.regexp_replace("text", "([a-z])[-¬‐­] *\n *([a-z]+)", "$1$2\n")
    return pages.select("document_id", "page_no", T.hits(F.col("text"), "[a-z][-¬‐­] *\n *[a-z]").alias("joins"), F.md5(joined).alias("digest"))


def mojibake_share(spark, d):
    return table(spark, d, "page_census").groupBy("company_id").agg(
        F.count("*").alias("pages"), F.sum("replacement_char_count").alias("replacement"), F.sum("pua_count").alias("private_use"),
        F.count_if(F.col("replacement_char_count") * 50 > F.col("char_count")).alias("broken_pages"),
    )


QUERIES = {f.__name__: f for f in (
    page_triage, doc_kind_rollup, script_profile, quality_gate, degenerate_line_runs, running_furniture, adjacent_headers,
    paragraph_reconstruction, order_quality_doc, order_quality_hidden, threshold_sweep, score_percentiles, section_qc, leak_detection,
    body_cue_best_run, language_windows, fiscal_year_vote, table_runs, dehyphenated_lines, mojibake_share,
)}

_N = lambda p, t="t": f"len(regexp_extract_all({t}, '{p}'))"
_W = r"[^ \t\n\r\f]+"
_LINES = r"""
l0 AS (SELECT {keys}, unnest(regexp_split_to_array(text, '\r?\n')) AS raw, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) - 1 AS line_no
    FROM documents WHERE text IS NOT NULL)"""
_PARAS = _LINES + r""",
l1 AS (SELECT {keys}, line_no, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS line FROM l0),
l2 AS (SELECT *, line = '' AS blank, lag(line = '' OR regexp_matches(line, '[.!?]["''”’)\]]*\s*$'), 1, true) OVER (PARTITION BY {keys} ORDER BY line_no) AS bef FROM l1),
l3 AS (SELECT *, sum(CASE WHEN NOT blank AND bef THEN 1 ELSE 0 END) OVER (PARTITION BY {keys} ORDER BY line_no) AS para_no FROM l2),
pa AS (SELECT {keys}, CAST(para_no AS BIGINT) AS para_no, min(line_no) AS first_line, string_agg(line, ' ' ORDER BY line_no) AS p FROM l3 WHERE NOT blank GROUP BY ALL)"""
_HEAD = (
    "(length(trim({x})) > 0 AND length(trim({x})) <= 60 AND NOT regexp_matches(trim({x}), '[.!?:;,]$') AND len(regexp_extract_all(trim({x}), '[^ \\t\\n\\r\\f]+')) <= 8"
    " AND len(regexp_extract_all(trim({x}), '[A-Za-z]')) > 0 AND (len(regexp_extract_all(trim({x}), '[A-Z]')) >= len(regexp_extract_all(trim({x}), '[A-Za-z]')) * 0.7"
    " OR (len(regexp_extract_all(trim({x}), '(?:^|[^A-Za-z''])[a-z]')) <= len(regexp_extract_all(trim({x}), '(?:^|[^A-Za-z''])(?:a|an|and|or|the|of|to|in|on|for|at|by|is|as|with|from|into|over)(?:[^A-Za-z'']|$)'))"
    " AND regexp_matches(trim({x}), '^[A-Z]'))))"
)
_END = r"regexp_matches({x}, '[.!?][\"''”’)\]]*\s*$')".replace('\\"', '"')
_ORDER = (
    "WITH " + _PARAS.format(keys="doc_id, document_id, physical_page") + r""",
o1 AS (SELECT *, lag(p) OVER w AS prev, lead(p) OVER w AS after FROM pa WINDOW w AS (PARTITION BY doc_id, document_id, physical_page ORDER BY para_no)),
o2 AS (SELECT *, coalesce(NOT regexp_matches(p, '^\s*\(?([a-z]|[ivx]{2,3}|[0-9]{1,2})[.)]\s') AND regexp_matches(p, '^[a-z,)\]}]') AND (""" + _END.format(x="prev") + " OR " + _HEAD.format(x="prev").replace("{2,3}", "{2,3}") + r"""), false) AS orphan,
  coalesce(len(regexp_extract_all(p, '[^ \t\n\r\f]+')) >= 4 AND NOT regexp_matches(p, '[:;]\s*$') AND regexp_matches(p, '(?:^| )["''(\[]*[a-z][^ ]*\s*$')
    AND NOT regexp_matches(p, '(?:^| )(?:""" + T.TAIL_WORDS + r""")["'')\].,;:]*\s*$')
    AND NOT """ + _END.format(x="p") + " AND NOT " + _HEAD.format(x="p") + r""" AND NOT regexp_matches(after, '^[a-z0-9]'), false) AS dangling FROM o1),
od AS (SELECT doc_id, document_id, physical_page, count(*) AS paragraphs, count_if(orphan) AS orphans, count_if(dangling) AS danglers FROM o2 GROUP BY ALL)"""
)
_ORDER_DOC = _ORDER + ", dq AS (SELECT doc_id, paragraphs, orphans, danglers, CASE WHEN paragraphs >= 5 THEN orphans / paragraphs ELSE 0.0 END AS orphan_share FROM od)"
_SCORE = " + ".join(f"len(regexp_extract_all(concat_ws(chr(10), section_title, text), '(?i){c}'))" for c in P.BODY_CUES)
ORACLES = {
    "page_triage": f"{_KIND_SQL} SELECT document_id, physical_page, kind, {_NEEDS} AS needs_ocr FROM k",
    "doc_kind_rollup": f"""{_KIND_SQL}, b AS (SELECT document_id, count(*) AS pages, count_if(kind <> 'blank') AS content, count_if({_NEEDS}) AS to_read,
        count_if(kind <> 'blank' AND coalesce(devanagari_count, 0) + coalesce(latin_count, 0) > 0) AS known,
        count_if(kind <> 'blank' AND coalesce(devanagari_count, 0) + coalesce(latin_count, 0) > 0 AND devanagari_count * 20 >= coalesce(latin_count, 0) + devanagari_count) AS indic
        FROM k GROUP BY 1) SELECT document_id, pages, content, to_read,
        CASE WHEN to_read / greatest(content, 1) >= 0.85 THEN 'scanned' WHEN to_read / greatest(content, 1) <= 0.05 THEN 'digital' ELSE 'mixed' END AS doc_kind,
        coalesce(CASE WHEN known > 0 THEN indic / known END BETWEEN 0.08 AND 0.92, false) AS bilingual FROM b""",
    "script_profile": f"""WITH x AS (SELECT doc_id, {_N('[ऀ-ॿ]', "coalesce(text, '')")} AS devanagari, {_N('[ऀ-ൿ]', "coalesce(text, '')")} AS indic,
        {_N('[A-Za-z]', "coalesce(text, '')")} AS latin FROM documents) SELECT *, CASE WHEN devanagari + indic + latin = 0 THEN 'unknown'
        WHEN indic / (devanagari + indic + latin) < 0.05 THEN 'latin' WHEN indic / (devanagari + indic + latin) <= 0.85 THEN 'mixed'
        WHEN devanagari >= indic * 0.8 THEN 'devanagari' ELSE 'other_indic' END AS script FROM x""",
    "quality_gate": rf"""WITH x AS (SELECT DISTINCT document_id, page_no, text, mean_conf, engine FROM ocr_pages),
        l0 AS (SELECT DISTINCT text, unnest(regexp_split_to_array(text, '\r?\n')) AS raw, generate_subscripts(regexp_split_to_array(text, '\r?\n'), 1) AS k FROM (SELECT DISTINCT text FROM x WHERE text IS NOT NULL)),
        l1 AS (SELECT text, trim(raw) AS line, row_number() OVER (PARTITION BY text ORDER BY k) AS pos FROM l0 WHERE trim(raw) <> ''),
        l2 AS (SELECT text, line, pos - row_number() OVER (PARTITION BY text, line ORDER BY pos) AS g FROM l1), l3 AS (SELECT text, line, g, count(*) AS n FROM l2 GROUP BY ALL), l4 AS (SELECT text, max(n) AS same FROM l3 GROUP BY 1)
        SELECT document_id, page_no, engine, {_N(_W, 'x.text')} AS n_words, CASE WHEN {_N(_W, 'x.text')} < 40 THEN 'too_few_words' WHEN mean_conf / 100 < 0.72 THEN 'low_conf'
        WHEN len(regexp_extract_all(x.text, '[\p{{L}}\p{{M}}\p{{N}}\s]')) < length(x.text) * 0.75 THEN 'high_symbol_noise'
        WHEN len(regexp_extract_all(x.text, '[^ \t\n\r\f]{{31,}}')) > greatest(3.0, {_N(_W, 'x.text')} * 0.02) THEN 'run_on_tokens' WHEN same >= 8 THEN 'degenerate' ELSE 'ok' END AS verdict FROM x LEFT JOIN l4 ON x.text = l4.text""",
    "degenerate_line_runs": "WITH " + _LINES.format(keys="doc_id") + """,
        a AS (SELECT doc_id, line_no, trim(raw) AS line FROM l0 WHERE trim(raw) <> ''),
        b AS (SELECT *, CASE WHEN line = lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) THEN 0 ELSE 1 END AS c FROM a),
        e AS (SELECT *, sum(c) OVER (PARTITION BY doc_id ORDER BY line_no) AS i FROM b), f AS (SELECT doc_id, i, count(*) AS n FROM e GROUP BY ALL)
        SELECT doc_id, max(n) AS longest, max(n) >= 8 AS degenerate FROM f GROUP BY 1""",
    "running_furniture": r"""WITH b AS (SELECT document_id, physical_page, 'top' AS place, top_furniture_text AS line FROM page_census UNION ALL
        SELECT document_id, physical_page, 'bottom', bottom_furniture_text FROM page_census),
        f AS (SELECT *, lower(trim(regexp_replace(regexp_replace(line, '[0-9]+', '', 'g'), '\s+', ' ', 'g'))) AS form FROM b),
        p AS (SELECT document_id, count(DISTINCT physical_page) AS pages FROM page_census GROUP BY 1),
        c AS (SELECT document_id, place, form, count(DISTINCT physical_page) AS on_pages FROM f WHERE form <> '' GROUP BY ALL)
        SELECT c.*, pages FROM c JOIN p USING (document_id) WHERE on_pages >= greatest(2, floor(pages * 0.35))""",
    "adjacent_headers": """WITH c0 AS (SELECT *, row_number() OVER (PARTITION BY document_id, physical_page ORDER BY profiled_at DESC NULLS LAST,
        char_count DESC NULLS LAST, image_area_frac DESC NULLS LAST) AS rn FROM page_census),
        a AS (SELECT document_id, physical_page, lower(trim(top_furniture_text)) AS h FROM c0 WHERE rn = 1),
        b AS (SELECT *, lead(h) OVER w AS nh, lead(physical_page) OVER w AS np FROM a WINDOW w AS (PARTITION BY document_id ORDER BY physical_page))
        SELECT document_id, physical_page, CAST(levenshtein(h, nh) AS INT) AS distance, levenshtein(h, nh) * 5 <= length(h) AS similar FROM b
        WHERE h <> '' AND nh <> '' AND np = physical_page + 1""",
    "paragraph_reconstruction": "WITH " + _PARAS.format(keys="doc_id") + " SELECT doc_id, para_no, first_line, md5(p) AS digest FROM pa",
    "order_quality_doc": _ORDER_DOC + " SELECT * FROM dq",
    "order_quality_hidden": _ORDER + """, b AS (SELECT document_id, count(*) AS pages, sum(orphans) / greatest(sum(paragraphs), 1) AS whole,
        max(CASE WHEN paragraphs >= 2 THEN orphans / paragraphs END) AS worst_page FROM od GROUP BY 1)
        SELECT *, worst_page > 0.03 AND whole <= 0.03 AS hidden FROM b""",
    "threshold_sweep": _ORDER_DOC + """ SELECT threshold, count_if(orphan_share < threshold) AS below, count_if(orphan_share = threshold) AS equal,
        count_if(orphan_share > threshold) AS above, max(CASE WHEN orphan_share <= threshold THEN orphan_share END) AS last_below,
        min(CASE WHEN orphan_share > threshold THEN orphan_share END) AS first_above
        FROM dq, (SELECT unnest([0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.2])::DOUBLE AS threshold) GROUP BY 1""",
    "score_percentiles": "SELECT source, count(n_chars) AS n, " + ", ".join(f"quantile_cont(n_chars, {q}) AS p{int(q * 100)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)) + " FROM documents GROUP BY 1",
    "section_qc": rf"""WITH x AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), y AS (SELECT doc_id, {_N(_W)} AS n_words, length(t) AS n_chars, {_N('[0-9]')} AS digits,
        {_N('[A-Za-zऀ-ॿ઀-૿]')} AS letters, len(regexp_extract_all(t, '[^ \t\n\r\f]{{29,}}')) AS long_tokens FROM x)
        SELECT *, concat_ws(',', CASE WHEN n_words < 250 THEN 'too_short' END, CASE WHEN n_words > 25000 THEN 'too_long' END,
        CASE WHEN digits / greatest(letters + digits, 1) > 0.25 THEN 'looks_like_tables' END, CASE WHEN long_tokens * 50 > n_words THEN 'run_on_tokens' END) AS reasons FROM y""",
    "leak_detection": "SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(lower(coalesce(text, '')), '{p}') THEN '{tag}' END" for p, tag in P.LEAKS) + ") AS leaks FROM documents",
    "body_cue_best_run": f"""WITH c AS (SELECT document_id, physical_page, CAST(sum(least({_SCORE}, 4)) AS BIGINT) AS cues FROM documents
        WHERE document_id IS NOT NULL AND physical_page IS NOT NULL GROUP BY ALL),
        r AS (SELECT *, cues * 2 - 3 AS gain, sum(cues * 2 - 3) OVER (PARTITION BY document_id ORDER BY physical_page) AS total FROM c),
        s AS (SELECT *, min((total - gain, physical_page)) OVER (PARTITION BY document_id ORDER BY physical_page ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS low FROM r),
        u AS (SELECT document_id, physical_page AS end_page, low[2] AS start_page, CAST(total - low[1] AS BIGINT) AS score FROM s),
        v AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, end_page) AS rn FROM u)
        SELECT document_id, start_page, end_page, score FROM v WHERE rn = 1""",
    "language_windows": """WITH w AS (SELECT doc_id, text, unnest(range(0, length(text), 2000)) AS start FROM documents WHERE length(text) > 0),
        c AS (SELECT doc_id, start, len(regexp_extract_all(array_slice(text, start + 1, start + 2000), '[ऀ-ॿ]')) AS dev, length(array_slice(text, start + 1, start + 2000)) AS n FROM w),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY dev / n DESC, start) AS rn FROM c)
        SELECT doc_id, count(*) AS windows, count_if(dev * 50 > n) AS fired, CAST(sum(dev) AS BIGINT) AS devanagari, CAST(max(CASE WHEN rn = 1 THEN start END) AS INT) AS worst_start FROM r GROUP BY 1""",
    "fiscal_year_vote": r"""WITH a AS (SELECT doc_id, unnest(regexp_extract_all(text, '\((20[0-2][0-9])\)', 1)) AS y, generate_subscripts(regexp_extract_all(text, '\((20[0-2][0-9])\)', 1), 1) - 1 AS k, 2 AS w FROM documents
        UNION ALL SELECT doc_id, unnest(regexp_extract_all(text, '\b(20[0-2][0-9])\b', 1)), generate_subscripts(regexp_extract_all(text, '\b(20[0-2][0-9])\b', 1), 1) - 1, 1 FROM documents),
        v AS (SELECT doc_id, y::INT AS year, CAST(sum(w) AS BIGINT) AS weight, min(k) AS f FROM a GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, f, year) AS rn FROM v) SELECT doc_id, year, weight FROM r WHERE rn = 1""",
    "table_runs": "WITH " + _LINES.format(keys="doc_id") + """,
        a AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos, len(regexp_extract_all(raw, '[0-9]')) * 2 >= len(regexp_extract_all(raw, '[A-Za-zऀ-ॿ઀-૿]')) AS f FROM l0 WHERE trim(raw) <> ''),
        b AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, f ORDER BY pos) AS i FROM a)
        SELECT doc_id, CAST(min(pos) AS INT) AS first, count(*) AS length FROM b WHERE f GROUP BY doc_id, i HAVING count(*) >= 3""",
    "dehyphenated_lines": r"""WITH p AS (SELECT DISTINCT document_id, page_no, text FROM ocr_pages)
        SELECT document_id, page_no, len(regexp_extract_all(text, concat('[a-z][-¬‐', chr(173), '] *', chr(10), ' *[a-z]'))) AS joins,
        md5(regexp_replace(text, concat('([a-z])[-¬‐', chr(173), '] *', chr(10), ' *([a-z]+)'), concat('\1\2', chr(10)), 'g')) AS digest FROM p""",
    "mojibake_share": """SELECT company_id, count(*) AS pages, CAST(sum(replacement_char_count) AS BIGINT) AS replacement, CAST(sum(pua_count) AS BIGINT) AS private_use,
        count_if(replacement_char_count * 50 > char_count) AS broken_pages FROM page_census GROUP BY 1""",
}
