"""Sections of reports: ending lines, outline, contents, heading and body strategies, arbiter, refinement."""

from __future__ import annotations

from foliant.functions import patterns as P
from foliant.operators import sections as S
from foliant.session import cut, table
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _documents(spark, d) -> DataFrame:
    """Page texts under their section titles, as they stand in the report."""
    t = table(spark, d, "documents").filter("document_id is not null and physical_page is not null")
    return t.select("doc_id", "document_id", F.col("physical_page").alias("page_no"), F.concat_ws("\n", "section_title", "text").alias("text"))


def _pages(spark, d) -> DataFrame:
    """Features of pages; of several texts of one page the one of the least id counts."""
    each = S.page_features(_documents(spark, d), ["doc_id", "document_id", "page_no"])
    rest = [c for c in each.columns if c not in ("doc_id", "document_id", "page_no")]
    best = each.groupBy("document_id", "page_no").agg(F.min_by(F.struct(*rest), "doc_id").alias("f"))
    # The texts are read once; every strategy works on what is known of the pages.
    return cut(best.select("document_id", "page_no", "f.*"))


def _sizes(spark, d) -> DataFrame:
    return table(spark, d, "doc_records").groupBy("document_id").agg(F.max("page_count").alias("n_pages"))


def _outline(spark, d) -> DataFrame:
    t = table(spark, d, "documents").filter("section_title is not null and document_id is not null and physical_page is not null")
    return t.select("document_id", F.col("section_title").alias("title"), F.col("physical_page").alias("page_no")).distinct()


def _contents(spark, d) -> DataFrame:
    """A contents page for each audited report, from its audited sections: titles and printed pages, one line each."""
    rows = table(spark, d, "input_rows").filter("document_id is not null and body_title is not null and start_page is not null")
    lines = rows.select("document_id", F.struct("start_page", F.concat_ws(" ..... ", "body_title", F.col("start_page").cast("string"))).alias("x")).distinct()
    text = F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["col2"]), "\n")
    return lines.groupBy("document_id").agg(F.concat(F.lit("Contents\nCover ..... 1\nNotes ..... 999\n"), text).alias("text")).withColumn("page_no", F.lit(0))


def terminator_lines(spark, d):
    """Lines of page texts that end a section, by their shape and place."""
    each = S.page_features(_documents(spark, d), ["doc_id"]).select("doc_id", F.explode("terms").alias("t"))
    return each.select("doc_id", "t.line_index", "t.text", "t.font_signal")


def scanned_terminators(spark, d):
    """The same on recognised pages."""
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "text").distinct()
    each = S.page_features(pages, ["document_id", "page_no"]).select("document_id", "page_no", F.explode("terms").alias("t"))
    return each.select("document_id", "page_no", "t.line_index", "t.text", "t.font_signal")


def page_body_score(spark, d):
    return table(spark, d, "documents").select("doc_id", S.body_score(F.coalesce("text", F.lit(""))).alias("score"))


def pointer_headings(spark, d):
    """Worksheet headings that are titles of the section, and those that only point to it."""
    h = table(spark, d, "annexure_audit_document_labels").filter("heading_text is not null").groupBy("label_id").agg(F.max("heading_text").alias("h"))
    return h.select("label_id", S.is_section_title(F.col("h")).alias("is_title"), S.is_pointer(F.col("h")).alias("is_pointer"), S.is_title_or_caps(F.col("h")).alias("shaped"))


def section_outline(spark, d):
    return S.locate_outline(_outline(spark, d), _pages(spark, d), _sizes(spark, d))


def section_contents(spark, d):
    """Sections by the contents pages of audited reports."""
    pages = S.page_features(_contents(spark, d), ["document_id", "page_no"])
    return S.locate_contents(pages, _sizes(spark, d))


def section_heading(spark, d):
    return S.locate_text_heading(_pages(spark, d))


def section_body(spark, d):
    return S.locate_body(_pages(spark, d))


def _candidates(spark, d, pages) -> DataFrame:
    outline = S.locate_outline(_outline(spark, d), pages, _sizes(spark, d)).filter("start_page is not null")
    parts = [(0, "outline", outline), (1, "contents", section_contents(spark, d)), (2, "heading_text", S.locate_text_heading(pages)), (3, "body_score", S.locate_body(pages))]
    out = None
    for k, name, df in parts:
        part = df.select("document_id", F.lit(k).alias("ord"), F.lit(name).alias("method"), "start_page", "end_page", F.col("score").cast("int").alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def section_arbiter(spark, d):
    """The best span of each report over all strategies."""
    pages = _pages(spark, d)
    return S.arbiter(_candidates(spark, d, pages), pages)


def end_refinement(spark, d):
    """Spans of the body strategy walked on to their end."""
    pages = _pages(spark, d)
    return S.refine_end(S.locate_body(pages).select("document_id", "start_page", "end_page"), pages)


def section_prose(spark, d):
    """The prose of each located section: pages in order, without furniture and tables; words, lines of tables, digest."""
    from foliant.functions import text as T

    both = F.array_compact(F.array(F.nullif(T.furniture_key(F.col("top_furniture_text")), F.lit("")), F.nullif(T.furniture_key(F.col("bottom_furniture_text")), F.lit(""))))
    edges = table(spark, d, "page_census").select("document_id", F.explode(both).alias("k")).groupBy("document_id").agg(F.collect_set("k").alias("furniture"))
    spans = section_arbiter(spark, d).select("document_id", "start_page", "end_page")
    t = table(spark, d, "documents").select("doc_id", "document_id", F.col("physical_page").alias("page_no"), "text")
    # Only pages inside a span keep their text; a span has at most sixty.
    inside = t.join(spans, "document_id").filter(F.col("page_no").between(F.col("start_page"), F.col("end_page")))
    p = inside.join(edges, "document_id", "left").select("document_id", "page_no", "doc_id", S.prose_of(F.col("text"), F.coalesce("furniture", F.array().cast("array<string>"))).alias("p"))
    parts = F.array_sort(F.collect_list(F.struct("page_no", "doc_id", "p.prose", "p.tables")))
    by = p.groupBy("document_id").agg(parts.alias("x")).withColumn("prose", F.array_join(F.transform("x", lambda e: e["prose"]), "\n"))
    return by.select("document_id", F.size("x").alias("texts"), T.word_count(F.col("prose")).alias("words"),
                     F.aggregate("x", F.lit(0), lambda a, e: a + e["tables"]).alias("table_lines"), F.md5("prose").alias("digest"))


QUERIES = {f.__name__: f for f in (
    terminator_lines, scanned_terminators, page_body_score, pointer_headings, section_outline, section_contents, section_heading,
    section_body, section_arbiter, end_refinement, section_prose,
)}

_q = lambda p: p.replace("'", "''")
_SMALL = "(" + ", ".join(f"'{w}'" for w in P.TITLE_SMALL) + ")"
_STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"
_CAPS = lambda s: rf"(regexp_matches({s}, '\p{{Lu}}') AND NOT regexp_matches({s}, '\p{{Ll}}'))"
_LOW = lambda s: f"len(list_filter(regexp_extract_all({s}, '[A-Za-z]+'), lambda w: regexp_matches(w, '^[a-z]') AND lower(w) NOT IN {_SMALL})) > 0"
_SHAPED = lambda s: f"({_CAPS(s)} OR (regexp_matches({s}, '[A-Z]') AND NOT regexp_matches({s}, '^[^A-Za-z]*[a-z]') AND NOT {_LOW(s)}))"
_TITLE = lambda s: f"(regexp_matches({s}, '(?i)(?:{_q(P.HEADING)})|(?:{_q(P.COMBINED)})') OR (length({s}) <= 24 AND regexp_matches({s}, '(?i){_q(P.ACRONYM)}')))"
_POINT = lambda s: f"(regexp_matches({s}, '(?i){_q(P.POINTER)}') OR regexp_matches(regexp_replace({s}, '(?i){_q(P.POINTER_BELOW)}', ' ', 'g'), '(?i){_q(P.POINTER_GIVEN)}'))"
_TERM = _q(P.TERMINATOR)
_PART = lambda k: f"regexp_extract(s, '(?i)^(.*?)(?:{_TERM})(.*)$', {k})"
_FEW = lambda p: f"(len(regexp_extract_all({p}, '[A-Za-z]+')) <= 3 AND NOT {_LOW(p)})"
_NORM = r"lower(trim(regexp_replace(regexp_replace(s, '[0-9]+', '', 'g'), '\s+', ' ', 'g')))"


def _lines_sql(source: str, keys: str) -> str:
    """CTEs: tx (keys, text), ln (keys, n, i, s, before) of lines, te of ending lines."""
    return rf"""tx AS ({source}),
ls AS (SELECT {keys}, text, string_split(text, chr(10)) AS ls FROM tx),
li AS (SELECT {keys}, len(ls) AS n, ls, unnest(range(0, len(ls))) AS i FROM ls),
ln AS (SELECT {keys}, n, i, {_STRIP.format('ls[i + 1]')} AS s, CASE WHEN i > 0 THEN {_STRIP.format('ls[i]')} END AS before FROM li),
te AS (SELECT {keys}, CAST(i AS INT) AS line_index, s AS text, CASE WHEN {_CAPS('s')} THEN 'all_caps' ELSE 'title_case' END AS font_signal,
    i * 1000 // greatest(n, 1) AS permille, {_NORM} AS norm FROM ln
    WHERE length(s) BETWEEN 1 AND 80 AND regexp_matches(s, '(?i){_TERM}') AND NOT regexp_matches(s, '[,;]$')
    AND NOT (regexp_matches(s, '\.$') AND NOT regexp_matches(s, '(?i)\b(?:Co|Ltd|Inc|Corp|No)\.$')) AND {_FEW(_PART(1))} AND {_FEW(_PART(2))} AND {_SHAPED('s')}
    AND (coalesce(before = '', false) OR (i <= greatest(8, n // 2) AND i < greatest(4, n // 3))))"""


_DOCS = "SELECT doc_id, document_id, physical_page AS page_no, concat_ws(chr(10), section_title, text) AS text FROM documents WHERE document_id IS NOT NULL AND physical_page IS NOT NULL"
_PAGE = f"SELECT document_id, page_no, arg_min(text, doc_id) AS text FROM ({_DOCS}) GROUP BY ALL"
_BODY = lambda t: (
    f"CASE WHEN regexp_matches({t}, '\\S') THEN least(160, least(100, 25 * (" + " + ".join(f"CAST(regexp_matches({t}, '(?i){_q(p)}') AS INT)" for p in P.BODY_CUES)
    + f")) + 35 * CAST(regexp_matches({t}, '(?i){_q(P.HEADING)}') AS INT) + 15 * CAST(regexp_matches({t}, '(?i)cautionary\\s+statement') AS INT)) ELSE 0 END"
)
_CUE = "(?i)" + "|".join(f"(?:{_q(p)})" for p in P.BODY_CUES)
_FEATURES = "WITH " + _lines_sql(_PAGE, "document_id, page_no") + rf""",
fu AS (SELECT document_id, page_no, list(s ORDER BY i) AS f FROM ln WHERE s <> '' GROUP BY ALL),
pg AS (SELECT tx.document_id, tx.page_no, {_BODY('tx.text')} AS score, len(regexp_extract_all(tx.text, '[^ \t\n\r\f]+')) AS words,
    len(regexp_extract_all(tx.text, '\p{{L}}')) * 100 BETWEEN length(tx.text) * 60 AND length(tx.text) * 92 AS dense, regexp_matches(tx.text, '{_CUE}') AS cue,
    {_POINT('tx.text')} AS pointer, coalesce(fu.f, []) AS f, list_filter(list_transform(coalesce(fu.f, [])[1:4], lambda s: {_NORM}), lambda x: x <> '') AS headers FROM tx LEFT JOIN fu USING (document_id, page_no)),
rk AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_no) AS rk FROM pg),
sz AS (SELECT document_id, max(page_count) AS n_pages FROM doc_records GROUP BY 1),
ol AS (SELECT DISTINCT document_id, section_title AS title, physical_page AS page_no FROM documents WHERE section_title IS NOT NULL AND document_id IS NOT NULL AND physical_page IS NOT NULL),
og AS (SELECT document_id, min(page_no) AS proposed FROM ol WHERE {_TITLE('title')} GROUP BY 1),
oh AS (SELECT og.document_id, proposed, CAST(least(coalesce((SELECT min(page_no) FROM ol WHERE ol.document_id = og.document_id AND page_no > proposed) - 1, n_pages - 1, proposed), proposed + 59) AS INT) AS e
    FROM og LEFT JOIN sz USING (document_id)),
pr AS (SELECT a.document_id, a.page_no FROM pg a WHERE words >= 120 AND dense AND (cue OR EXISTS (SELECT 1 FROM pg b WHERE b.document_id = a.document_id AND b.page_no = a.page_no + 1 AND b.cue))),
outline AS (SELECT document_id, proposed, st AS start_page, CAST(greatest(e, st) AS INT) AS end_page, CASE WHEN st = proposed THEN 95 WHEN st > proposed THEN 90 END AS score, st - proposed AS walked,
    CASE WHEN st = proposed THEN 'accepted' WHEN st > proposed THEN 'accepted_with_walk' ELSE 'invalidated' END AS outcome
    FROM (SELECT *, (SELECT min(page_no) FROM pr WHERE pr.document_id = oh.document_id AND page_no BETWEEN proposed AND least(proposed + 8, e)) AS st FROM oh)),
hc AS (SELECT document_id, page_no, f, unnest(range(0, least(5, len(f)))) AS i FROM pg WHERE page_no >= 2 AND NOT pointer),
hd AS (SELECT *, f[i + 1] AS s, CASE WHEN i < 4 THEN f[i + 2] END AS nx FROM hc),
he AS (SELECT *, CASE WHEN length(s) <= 110 AND {_TITLE('s')} THEN s WHEN nx IS NOT NULL AND NOT {_TITLE('nx')} AND length(s || ' ' || nx) <= 110 AND {_TITLE("(s || ' ' || nx)")} THEN s || ' ' || nx END AS t FROM hd),
hf AS (SELECT document_id, page_no, i, t, 40 + 10 * (5 - i) // 5 + CASE WHEN length(t) <= 60 THEN 10 ELSE 0 END + CASE WHEN {_CAPS('t')} THEN 5 ELSE 0 END
    - CASE WHEN len(list_filter(f, lambda s: regexp_matches(s, '(?i){_TERM}'))) >= 3 THEN 30 ELSE 0 END AS score FROM he WHERE t IS NOT NULL),
hg AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, page_no, i) AS rn FROM hf),
hs AS (SELECT document_id, page_no AS start_page, CAST(least(78, score) AS INT) AS score, t AS heading FROM hg WHERE rn = 1),
ha AS (SELECT hs.document_id, hs.start_page, a.headers, a.rk AS r0, b.page_no, b.rk, b.score AS ps FROM hs JOIN rk a ON a.document_id = hs.document_id AND a.page_no = hs.start_page JOIN rk b ON b.document_id = hs.document_id AND b.rk > a.rk AND b.rk <= a.rk + 60),
ht AS (SELECT ha.*, te.line_index, te.text AS term, te.permille FROM ha JOIN te ON te.document_id = ha.document_id AND te.page_no = ha.page_no WHERE NOT ((te.line_index <= 3 OR te.permille < 80) AND list_contains(headers, te.norm))),
hx AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY page_no, line_index) AS rn FROM ht),
heading AS (SELECT hs.document_id, hs.start_page, hs.score, heading, CAST(coalesce(CASE WHEN hx.page_no IS NOT NULL THEN greatest(hs.start_page, CASE WHEN (line_index >= 5 OR permille >= 350) AND ps >= 25 THEN hx.page_no ELSE hx.page_no - 1 END) END,
    (SELECT max(page_no) FROM ha WHERE ha.document_id = hs.document_id), hs.start_page) AS INT) AS end_page, term AS terminator FROM hs LEFT JOIN hx ON hx.document_id = hs.document_id AND rn = 1),
b1 AS (SELECT *, sum(score - 12) OVER (PARTITION BY document_id ORDER BY page_no) AS c FROM rk),
b2 AS (SELECT a.document_id, a.page_no AS s, b.page_no AS e, b.rk, b.score, b.c - a.c + a.score - 12 AS acc FROM b1 a JOIN b1 b ON a.document_id = b.document_id AND b.rk >= a.rk AND b.rk < a.rk + 60),
b3 AS (SELECT *, coalesce(max(CASE WHEN score > 20 THEN e END) OVER w, s) AS good, coalesce(min(acc) OVER (PARTITION BY document_id, s ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lowest FROM b2 WINDOW w AS (PARTITION BY document_id, s ORDER BY rk)),
b4 AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY acc DESC, s, rk) AS rn FROM b3 WHERE lowest >= -90 AND acc > 0 AND document_id IN (SELECT document_id FROM pg GROUP BY 1 HAVING max(score) >= 35)),
body AS (SELECT document_id, s AS start_page, good AS end_page, CAST(least(72, 30 + acc // 6) AS INT) AS score FROM b4 WHERE rn = 1),
c0 AS (SELECT DISTINCT document_id, body_title AS title, start_page AS folio FROM input_rows WHERE document_id IS NOT NULL AND body_title IS NOT NULL AND start_page IS NOT NULL),
c1 AS (SELECT document_id, {_STRIP.format("regexp_extract(title || ' ..... ' || folio, '" + _q(P.CONTENTS_LINE) + "', 1)")} AS title, folio FROM c0 WHERE regexp_matches(title || ' ..... ' || folio, '{_q(P.CONTENTS_LINE)}')),
c2 AS (SELECT * FROM c1 WHERE {_SHAPED('title')}),
c3 AS (SELECT document_id, min((folio, title)) AS s FROM c2 WHERE {_TITLE('title')} GROUP BY 1),
c4 AS (SELECT c3.document_id, s[1] AS f, s[2] AS heading, coalesce((SELECT min(folio) FROM c2 WHERE c2.document_id = c3.document_id AND folio > s[1]), 999) AS nx, n_pages FROM c3 LEFT JOIN sz USING (document_id)),
contents AS (SELECT document_id, CAST(greatest(0, least(f, n_pages - 1)) AS INT) AS start_page, CAST(least(greatest(greatest(0, least(f, n_pages - 1)), least(nx - 1, n_pages - 1)), greatest(0, least(f, n_pages - 1)) + 59) AS INT) AS end_page,
    15 AS score, heading, 0 AS "offset" FROM c4),
ca AS (SELECT document_id, 0 AS ord, 'outline' AS method, start_page, end_page, score FROM outline WHERE start_page IS NOT NULL UNION ALL SELECT document_id, 1, 'contents', start_page, end_page, score FROM contents
    UNION ALL SELECT document_id, 2, 'heading_text', start_page, end_page, score FROM heading UNION ALL SELECT document_id, 3, 'body_score', start_page, end_page, score FROM body),
cr AS (SELECT *, row_number() OVER (PARTITION BY document_id ORDER BY score DESC, ord) AS rn FROM ca),
ct AS (SELECT document_id, method, start_page, end_page, score, (SELECT count(*) FROM cr x WHERE x.document_id = cr.document_id AND x.rn > 1 AND abs(x.start_page - cr.start_page) <= 2) AS supporters,
    coalesce((SELECT CAST(sum(words) AS BIGINT) FROM pg WHERE pg.document_id = cr.document_id AND page_no BETWEEN cr.start_page AND cr.end_page), 0) AS words FROM cr WHERE rn = 1)
"""
ORACLES = {
    "terminator_lines": "WITH " + _lines_sql(_DOCS, "doc_id") + " SELECT doc_id, line_index, text, font_signal FROM te",
    "scanned_terminators": "WITH " + _lines_sql("SELECT DISTINCT document_id, page_no, coalesce(text, '') AS text FROM ocr_pages", "document_id, page_no") + " SELECT document_id, page_no, line_index, text, font_signal FROM te",
    "page_body_score": f"SELECT doc_id, CAST({_BODY('t')} AS INT) AS score FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)",
    "pointer_headings": f"WITH x AS (SELECT label_id, max(heading_text) AS h FROM annexure_audit_document_labels WHERE heading_text IS NOT NULL GROUP BY 1) SELECT label_id, {_TITLE('h')} AS is_title, {_POINT('h')} AS is_pointer, {_SHAPED('h')} AS shaped FROM x",
    "section_outline": f"{_FEATURES} SELECT * FROM outline",
    "section_contents": f"{_FEATURES} SELECT * FROM contents",
    "section_heading": f"{_FEATURES} SELECT * FROM heading",
    "section_body": f"{_FEATURES} SELECT * FROM body",
    "section_arbiter": f"{_FEATURES} SELECT document_id, method, start_page, end_page, supporters, words, CASE WHEN words < 250 THEN least(99, score + 6 * supporters) / 2 ELSE least(99, score + 6 * supporters) END AS score FROM ct",
    "section_prose": f"""{_FEATURES}, fk AS (SELECT document_id, list(DISTINCT k) AS furniture FROM (SELECT document_id, {_NORM.replace('(s,', '(top_furniture_text,')} AS k FROM page_census UNION ALL
        SELECT document_id, {_NORM.replace('(s,', '(bottom_furniture_text,')} FROM page_census) WHERE k <> '' GROUP BY 1),
        sp AS (SELECT d.doc_id, d.document_id, d.physical_page AS page_no, coalesce(d.text, '') AS text, coalesce(furniture, []) AS furniture FROM documents d JOIN ct ON ct.document_id = d.document_id AND d.physical_page BETWEEN ct.start_page AND ct.end_page
        LEFT JOIN fk ON fk.document_id = d.document_id),
        sl AS (SELECT doc_id, document_id, page_no, furniture, unnest(range(0, len(string_split(text, chr(10))))) AS i, text FROM sp),
        sm AS (SELECT doc_id, document_id, page_no, i, {_STRIP.format('string_split(text, chr(10))[i + 1]')} AS s, furniture FROM sl),
        sn AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, len(regexp_extract_all(s, '[0-9]')) * 2 >= len(regexp_extract_all(s, '\\p{{L}}')) AS f FROM sm WHERE s <> '' AND NOT list_contains(furniture, {_NORM})),
        so AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, f ORDER BY pos) AS isl FROM sn), sq AS (SELECT *, f AND count(*) OVER (PARTITION BY doc_id, f, isl) >= 3 AS tab FROM so),
        sr AS (SELECT doc_id, regexp_replace(string_agg(s, chr(10) ORDER BY pos) FILTER (NOT tab), concat('([a-z])-', chr(10), '([a-z]+)'), concat('\1\2', chr(10)), 'g') AS prose, count_if(tab) AS tables FROM sq GROUP BY 1),
        ss AS (SELECT sp.document_id, sp.doc_id, page_no, coalesce(prose, '') AS prose, coalesce(tables, 0) AS tables FROM sp LEFT JOIN sr USING (doc_id)),
        su AS (SELECT document_id, CAST(count(*) AS INT) AS texts, string_agg(prose, chr(10) ORDER BY page_no, doc_id) AS prose, CAST(sum(tables) AS INT) AS table_lines FROM ss GROUP BY 1)
        SELECT document_id, texts, len(regexp_extract_all(prose, '[^ \t\n\r\f]+')) AS words, table_lines, md5(prose) AS digest FROM su""",
    "end_refinement": f"""{_FEATURES}, w AS (SELECT document_id, start_page, end_page, unnest(range(end_page + 1, end_page + 13)) AS p FROM body),
        x AS (SELECT w.*, pg.document_id IS NULL OR (pg.score < 15 AND pg.words < 60) OR EXISTS (SELECT 1 FROM te WHERE te.document_id = w.document_id AND te.page_no = w.p) AS stops FROM w LEFT JOIN pg ON pg.document_id = w.document_id AND pg.page_no = w.p)
        SELECT document_id, start_page, end_page, CAST(coalesce(min(CASE WHEN stops THEN p END) - 1, end_page + 12) AS INT) AS refined_end FROM x GROUP BY document_id, start_page, end_page""",
}
