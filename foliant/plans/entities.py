"""Entities and events: names, codes, locators, components, layout, attempts and streams."""

from __future__ import annotations

import re

from foliant.functions import text as T
from foliant.operators.cover import greedy_cover, rarity
from foliant.operators.geometry import covered_cells, order_blocks, vertical_gaps
from foliant.operators.graph import connected_components, star_edges
from foliant.plans.scoring import _CO, _conditions
from foliant.session import table
from foliant.streaming import events as S
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: What predicate texts may name: columns of the census and logical words.
PREDICATE_COLUMNS = {"char_count", "word_count", "image_area_frac", "estimated_columns", "rotation", "physical_page", "page_count", "and", "or", "not"}


def company_names(spark, d):
    """Canonical names and aliases without legal form, once each, with how many companies bear them."""
    c = table(spark, d, "cohort_companies")
    each = c.select("company_id", F.explode(F.split(F.concat_ws("|", "canonical_name", "aliases"), r"\|")).alias("n"))
    return each.select("company_id", T.normal_name(F.col("n")).alias("name")).filter("name <> ''").groupBy("name").agg(
        F.count_distinct("company_id").alias("companies"), F.min("company_id").alias("first_company"))


def isin_check(spark, d):
    c = table(spark, d, "cohort_companies").groupBy("company_id").agg(F.max("isin").alias("isin"))
    return c.select("company_id", "isin", T.luhn_valid(F.col("isin")).alias("valid"))


def entity_components(spark, d):
    """Companies that share a registry number, an id code or a normalised name, as one entity each."""
    c = table(spark, d, "cohort_companies").select(
        "company_id", F.nullif(F.trim("cin"), F.lit("")).alias("cin"), F.nullif(F.trim("isin"), F.lit("")).alias("isin"),
        F.nullif(T.normal_name(F.col("canonical_name")), F.lit("")).alias("name"),
    )
    edges = None
    for key in ("cin", "isin", "name"):
        part = star_edges(c, "company_id", key)
        edges = part if edges is None else edges.unionByName(part)
    return connected_components(edges, "u", "v").select(F.col("node").alias("company_id"), F.col("component").alias("entity"))


def former_name_chain(spark, d):
    """Aliases that are present names of other companies, a rename or a namesake; ``rename_chains`` follows them to the end."""
    c = table(spark, d, "cohort_companies")
    old = c.select("company_id", F.explode(F.split("aliases", r"\|")).alias("a")).select("company_id", T.normal_name(F.col("a")).alias("name")).filter("name <> ''").distinct()
    now = c.select(F.col("company_id").alias("other"), T.normal_name(F.col("canonical_name")).alias("name")).distinct()
    return old.join(now, "name").filter("company_id <> other").select("company_id", "name", "other").distinct()


def locator_parts(spark, d):
    """Host, year and file number of report locators."""
    u = F.trim("source_locator")
    return table(spark, d, "doc_records").select(
        "document_id", "ingested_at", F.lower(F.regexp_extract(u, "^[a-zA-Z]+://([^/?#]+)", 1)).alias("host"),
        F.expr("try_cast(regexp_extract(trim(source_locator), '(?i)/ar/([0-9]{4})/', 1) AS int)").alias("year"),
        F.regexp_extract(u, r"/([0-9]+)\.[pP][dD][fF]", 1).alias("number"),
    ).distinct()


def url_redaction(spark, d):
    """Locators with hidden secrets, and the hash of what is shown, which gives no secret away."""
    u = T.redact_url(F.trim("source_locator"))
    return table(spark, d, "doc_records").filter("source_locator is not null").select(u.alias("redacted"), F.sha2(u, 256).alias("url_sha256")).distinct()


def storage_path(spark, d):
    """Content-addressed paths of stored files, two levels of fan-out."""
    h = F.lower(F.trim("sha256"))
    return table(spark, d, "doc_records").filter(h.rlike("^[0-9a-f]{64}$")).select(F.concat_ws("/", F.lit("blobs"), F.substring(h, 1, 2), F.substring(h, 3, 2), F.concat(h, F.lit(".pdf"))).alias("path")).distinct()


def title_slugs(spark, d):
    return table(spark, d, "cohort_companies").select("company_id", T.slug(F.col("canonical_name")).alias("slug")).distinct()


def heading_normal_form(spark, d):
    """Headings folded, lower case, without punctuation, and how often each occurs."""
    h = F.trim(F.regexp_replace(F.regexp_replace(F.lower(T.fold_ligatures(F.col("heading_text"))), "[^a-z0-9 ]", " "), " +", " "))
    return table(spark, d, "annexure_audit_document_labels").filter("heading_text is not null").groupBy(h.alias("heading")).agg(F.count_distinct("label_id").alias("labels"))


def character_error_rate(spark, d):
    """Edit distance of the issuer that a report names to each name of its company, over the name's length; the least."""
    c = table(spark, d, "cohort_companies")
    names = c.select("company_id", F.explode(F.split(F.concat_ws("|", "canonical_name", "aliases"), r"\|")).alias("n")).select("company_id", F.lower(F.trim("n")).alias("listed"))
    read = table(spark, d, "doc_records").select("document_id", "company_id", F.lower(F.trim("issuer")).alias("read")).filter("read <> ''").distinct()
    both = read.join(names.filter("listed <> ''").distinct(), "company_id")
    return both.groupBy("document_id", "company_id", "read").agg(F.min(F.levenshtein("read", "listed") * 1000 / F.length("listed")).alias("per_mille"))


def gold_prediction_status(spark, d):
    """Status of each label's prediction: missing, outside, exact, near or wrong; one of them, in this order."""
    la = table(spark, d, "annexure_audit_document_labels").groupBy("label_id").agg(F.max("true_start_page").alias("t"), F.max("proposed_start_page").alias("p"))
    off = F.abs(F.col("t") - F.col("p"))
    status = F.when(F.col("t").isNull(), "NO_GOLD").when(F.col("p").isNull(), "NO_PREDICTION").when(F.col("p") < 0, "INVALID").when(off == 0, "EXACT").when(off <= 2, "NEAR").otherwise("WRONG")
    return la.groupBy(status.alias("status")).agg(F.count("*").alias("n"), F.sum(off).alias("pages_off"))


def next_terminator(spark, d):
    """For each page with a start heading, the next page of the report that ends the section (forward as-of)."""
    w = Window.partitionBy("document_id").orderBy("physical_page").rowsBetween(1, 60)
    docs = table(spark, d, "documents").filter("document_id is not null and physical_page is not null")
    starts = F.col("section_title").isin("Management Discussion and Analysis", "Industry Structure")
    ends = F.col("section_title").isin("Corporate Governance", "Directors' Report", "Cautionary Statement")
    page = docs.groupBy("document_id", "physical_page").agg(F.bool_or(starts).alias("starts"), F.bool_or(ends).alias("ends"))
    out = page.withColumn("end_page", F.min(F.when(F.col("ends"), F.col("physical_page"))).over(w))
    return out.filter("starts").select("document_id", "physical_page", "end_page")


def taxonomy_predicates(spark, d):
    """Pages per named predicate; predicates are text and may use nothing but PREDICATE_COLUMNS."""
    predicates = {
        "dense": "char_count >= 2000", "picture": "image_area_frac > 0.5", "two_column": "estimated_columns >= 2",
        "rotated": "rotation <> 0", "late": "physical_page * 2 > page_count",
    }
    for text in predicates.values():
        other = set(re.findall(r"[A-Za-z_]\w*", re.sub(r"'[^']*'", "", text))) - PREDICATE_COLUMNS
        if other:
            raise ValueError(f"a predicate names {', '.join(sorted(other))}")
    pairs = ", ".join(f"'{k}', ({v})" for k, v in predicates.items())
    long = table(spark, d, "page_census").selectExpr("document_id", f"stack({len(predicates)}, {pairs}) AS (predicate, holds)")
    return long.filter("holds").groupBy("predicate").agg(F.count("*").alias("pages"), F.count_distinct("document_id").alias("documents"))


def font_usage(spark, d):
    return table(spark, d, "page_census").select("document_id", F.explode("font_names").alias("font")).groupBy("font").agg(F.count("*").alias("pages"), F.count_distinct("document_id").alias("documents"))


def rarest_documents(spark, d):
    """Forty-five reports whose conditions are rarest in sum: a challenge set."""
    return rarity(_conditions(spark, d), "document_id", "condition").orderBy(F.desc("score"), "document_id").limit(45)


def condition_set_cover(spark, d):
    """Reports chosen one by one until every condition is shown."""
    return greedy_cover(_conditions(spark, d), "document_id", "condition")


def _blocks(spark, d) -> DataFrame:
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "blocks").distinct().filter("blocks is not null")
    return pages.select("document_id", "page_no", F.explode("blocks").alias("b")).select("document_id", "page_no", "b.x0", "b.y0", "b.x1", "b.y1")


def reading_order(spark, d):
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "blocks").distinct()
    return order_blocks(pages, ["document_id", "page_no"])


def widest_gap(spark, d):
    return vertical_gaps(_blocks(spark, d), ["document_id", "page_no"])


def text_area(spark, d):
    pages = table(spark, d, "ocr_pages").select("document_id", "page_no", "blocks").distinct().filter("size(blocks) > 0")
    return pages.select("document_id", "page_no", covered_cells(F.col("blocks"), 595.0, 842.0).alias("cells"))


def error_classes(spark, d):
    """Events by class and layer of failure, from an ordered list of rules over type, value and payload."""
    k = F.get_json_object("props", "$.k").cast("int")
    kind = (
        F.when(F.col("event_type") != "error", "none").when(k.isNull(), "malformed").when(k < 20, "timeout")
        .when(k < 50, "http_status").when(F.col("value") > 50, "too_large").otherwise("content")
    )
    layer = F.when(kind == "none", "none").when(kind.isin("timeout", "http_status"), "network").otherwise("payload")
    return table(spark, d, "events").groupBy(kind.alias("kind"), layer.alias("layer")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


def retry_sequences(spark, d):
    """Attempts of each user up to and with the first success after an error."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("bad", F.col("event_type") == "error")
    e = e.withColumn("attempt", F.row_number().over(w)).withColumn("run", F.sum(F.when(~F.col("bad"), 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    seq = e.groupBy("user_id", F.coalesce("run", F.lit(0)).alias("run")).agg(F.count("*").alias("attempts"), F.count_if("bad").alias("errors"), F.bool_or(~F.col("bad")).alias("ended_well"))
    return seq.filter("errors > 0").groupBy("attempts", "ended_well").agg(F.count("*").alias("sequences"))


def failure_windows(spark, d):
    return S.failure_windows(table(spark, d, "events"))


def failure_windows_sliding(spark, d):
    return S.failure_windows(table(spark, d, "events"), "3 hours", "1 hour")


def retry_sessions(spark, d):
    return S.retry_sessions(table(spark, d, "events"))


def stream_failure_windows(spark, d):
    """The tumbling windows computed by a stream in complete mode of one run."""
    stream = S.read_events(spark, d).withWatermark("ts", "40 days")
    out = S.batches(S.failure_windows(stream), "complete")
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


def stream_first_deliveries(spark, d):
    """Events once each through a deduplicating stream."""
    once = S.first_deliveries(S.read_events(spark, d).select("event_id", "ts", "user_id", "event_type"))
    return S.drain(once).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_latest_per_user(spark, d):
    """The last event of each user, merged batch by batch."""
    stream = S.read_events(spark, d).filter("user_id is not null").select("user_id", "event_id", "ts", "event_type")
    return S.upsert_latest(stream, "user_id", ["ts", "event_id"]).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_paced_users(spark, d):
    """Slots granted by a rate limiter that keeps state per user."""
    stream = S.paced(S.read_events(spark, d).filter("user_id is not null"))
    return S.batches(stream, "update").groupBy("user_id").agg(F.max("granted").alias("granted"), F.max("delayed").alias("delayed"))


QUERIES = {f.__name__: f for f in (
    company_names, isin_check, entity_components, former_name_chain, locator_parts, url_redaction, storage_path, title_slugs,
    heading_normal_form, character_error_rate, gold_prediction_status, next_terminator, taxonomy_predicates, font_usage,
    rarest_documents, condition_set_cover, reading_order, widest_gap, text_area, error_classes, retry_sequences, failure_windows,
    failure_windows_sliding, retry_sessions, stream_failure_windows, stream_first_deliveries, stream_latest_per_user,
    stream_paced_users,
)}

_NORMAL = r"trim(regexp_replace(replace(regexp_replace(regexp_replace(lower({x}), '[^a-z0-9& ]', ' ', 'g'), '\b(" + T.NAME_STOP + r")\b', ' ', 'g'), '&', ' '), ' +', ' ', 'g'))"
_WIN = """SELECT {start} AS start, {start} + INTERVAL {width} AS "end", count(*) AS attempts, count_if(event_type = 'error') AS failures,
    CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS value_cents FROM {src} GROUP BY 1"""
_TUMBLE = _WIN.format(start="time_bucket(INTERVAL 90 MINUTE, ts, TIMESTAMP '1970-01-01')", width="90 MINUTE", src="events")
_LUHN = " + ".join(
    f"(CASE WHEN {k} % 2 = 1 THEN CASE WHEN 2 * {{d}} > 9 THEN 2 * {{d}} - 9 ELSE 2 * {{d}} END ELSE {{d}} END)".replace("{d}", f"coalesce(try_cast(substr(reverse(dg), {k + 1}, 1) AS INT), 0)")
    for k in range(24)
)
ORACLES = {
    "company_names": f"""WITH e AS (SELECT company_id, unnest(string_split(concat_ws('|', canonical_name, aliases), '|')) AS n FROM cohort_companies), m AS (SELECT company_id, {_NORMAL.format(x='n')} AS name FROM e)
        SELECT name, count(DISTINCT company_id) AS companies, min(company_id) AS first_company FROM m WHERE name <> '' GROUP BY 1""",
    "isin_check": f"""WITH c AS (SELECT company_id, max(isin) AS isin FROM cohort_companies GROUP BY 1),
        g AS (SELECT *, upper(trim(isin)) AS u, array_to_string(list_transform(regexp_split_to_array(upper(trim(isin)), ''), lambda x: CASE WHEN regexp_matches(x, '[A-Z]') THEN (ascii(x) - 55)::VARCHAR ELSE x END), '') AS dg FROM c)
        SELECT company_id, isin, CASE WHEN u IS NULL THEN NULL WHEN NOT regexp_matches(u, '^[A-Z]{{2}}[A-Z0-9]{{9}}[0-9]$') THEN false ELSE ({_LUHN}) % 10 = 0 END AS valid FROM g""",
    "entity_components": f"""WITH RECURSIVE k AS (SELECT company_id AS c, 'c' || trim(cin) AS k FROM cohort_companies WHERE trim(cin) <> '' UNION SELECT company_id, 'i' || trim(isin) FROM cohort_companies WHERE trim(isin) <> ''
        UNION SELECT company_id, 'n' || {_NORMAL.format(x='canonical_name')} FROM cohort_companies WHERE {_NORMAL.format(x='canonical_name')} <> ''),
        e AS (SELECT DISTINCT a.c AS u, b.c AS v FROM k a JOIN k b USING (k) WHERE a.c <> b.c), t AS (SELECT u, v FROM e UNION SELECT t.u, e.v FROM t JOIN e ON t.v = e.u)
        SELECT u AS company_id, least(min(v), u) AS entity FROM t GROUP BY u""",
    "former_name_chain": f"""WITH o AS (SELECT DISTINCT company_id, {_NORMAL.format(x='a')} AS name FROM (SELECT company_id, unnest(string_split(aliases, '|')) AS a FROM cohort_companies)),
        n AS (SELECT DISTINCT company_id AS other, {_NORMAL.format(x='canonical_name')} AS name FROM cohort_companies) SELECT DISTINCT company_id, name, other FROM o JOIN n USING (name) WHERE name <> '' AND company_id <> other""",
    "locator_parts": r"""SELECT DISTINCT document_id, ingested_at, lower(regexp_extract(trim(source_locator), '^[a-zA-Z]+://([^/?#]+)', 1)) AS host,
        try_cast(regexp_extract(trim(source_locator), '(?i)/ar/([0-9]{4})/', 1) AS INT) AS year, regexp_extract(trim(source_locator), '/([0-9]+)\.[pP][dD][fF]', 1) AS number FROM doc_records""",
    "url_redaction": f"""WITH r AS (SELECT DISTINCT regexp_replace(trim(source_locator), '{T.SECRET}', '\\1%5BREDACTED%5D', 'g') AS redacted FROM doc_records WHERE source_locator IS NOT NULL)
        SELECT redacted, sha256(redacted) AS url_sha256 FROM r""",
    "storage_path": """WITH h AS (SELECT lower(trim(sha256)) AS h FROM doc_records) SELECT DISTINCT 'blobs/' || h[1:2] || '/' || h[3:4] || '/' || h || '.pdf' AS path FROM h WHERE regexp_matches(h, '^[0-9a-f]{64}$')""",
    "title_slugs": "SELECT DISTINCT company_id, upper(regexp_replace(trim(canonical_name), '[^A-Za-z0-9._-]+', '_', 'g'))[1:80] AS slug FROM cohort_companies",
    "heading_normal_form": "SELECT trim(regexp_replace(regexp_replace(lower(heading_text), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS heading, count(DISTINCT label_id) AS labels FROM annexure_audit_document_labels WHERE heading_text IS NOT NULL GROUP BY 1",
    "character_error_rate": """WITH n AS (SELECT DISTINCT company_id, lower(trim(n)) AS l FROM (SELECT company_id, unnest(string_split(concat_ws('|', canonical_name, aliases), '|')) AS n FROM cohort_companies) WHERE trim(n) <> ''),
        t AS (SELECT DISTINCT document_id, company_id, lower(trim(issuer)) AS "read" FROM doc_records WHERE trim(issuer) <> '')
        SELECT document_id, company_id, "read", min(levenshtein("read", l) * 1000 / length(l)) AS per_mille FROM t JOIN n USING (company_id) GROUP BY ALL""",
    "gold_prediction_status": """WITH a AS (SELECT label_id, max(true_start_page) AS t, max(proposed_start_page) AS p FROM annexure_audit_document_labels GROUP BY 1)
        SELECT CASE WHEN t IS NULL THEN 'NO_GOLD' WHEN p IS NULL THEN 'NO_PREDICTION' WHEN p < 0 THEN 'INVALID' WHEN t = p THEN 'EXACT' WHEN abs(t - p) <= 2 THEN 'NEAR' ELSE 'WRONG' END AS status,
        count(*) AS n, CAST(sum(abs(t - p)) AS BIGINT) AS pages_off FROM a GROUP BY 1""",
    "next_terminator": """WITH p AS (SELECT document_id, physical_page, bool_or(section_title IN ('Management Discussion and Analysis', 'Industry Structure')) AS st,
        bool_or(section_title IN ('Corporate Governance', 'Directors'' Report', 'Cautionary Statement')) AS en FROM documents WHERE document_id IS NOT NULL AND physical_page IS NOT NULL GROUP BY ALL),
        o AS (SELECT *, min(CASE WHEN en THEN physical_page END) OVER (PARTITION BY document_id ORDER BY physical_page ROWS BETWEEN 1 FOLLOWING AND 60 FOLLOWING) AS end_page FROM p)
        SELECT document_id, physical_page, end_page FROM o WHERE st""",
    "taxonomy_predicates": " UNION ALL ".join(
        f"SELECT '{k}' AS predicate, count(*) AS pages, count(DISTINCT document_id) AS documents FROM page_census WHERE {v} HAVING count(*) > 0"
        for k, v in {"dense": "char_count >= 2000", "picture": "image_area_frac > 0.5", "two_column": "estimated_columns >= 2", "rotated": "rotation <> 0", "late": "physical_page * 2 > page_count"}.items()
    ),
    "font_usage": "SELECT font, count(*) AS pages, count(DISTINCT document_id) AS documents FROM (SELECT document_id, unnest(font_names) AS font FROM page_census) GROUP BY 1",
    "rarest_documents": f"""WITH {_CO}, o AS (SELECT DISTINCT document_id, condition FROM co), w AS (SELECT condition, 1000000 // count(*) AS w FROM o GROUP BY 1)
        SELECT document_id, CAST(sum(w) AS BIGINT) AS score FROM o JOIN w USING (condition) GROUP BY 1 ORDER BY score DESC, document_id LIMIT 45""",
    "widest_gap": """WITH p AS (SELECT DISTINCT document_id, page_no, blocks FROM ocr_pages WHERE blocks IS NOT NULL), b AS (SELECT document_id, page_no, unnest(blocks) AS b FROM p),
        r AS (SELECT document_id, page_no, b.y0 AS y0, max(b.y1) OVER (PARTITION BY document_id, page_no ORDER BY b.y0, b.y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM b),
        g AS (SELECT *, y0 - reach AS gap, row_number() OVER (PARTITION BY document_id, page_no ORDER BY y0 - reach DESC, reach) AS rn FROM r WHERE y0 - reach > 0) SELECT document_id, page_no, gap, reach AS at FROM g WHERE rn = 1""".replace(" AS at ", ' AS "at" '),
    "text_area": """WITH p AS (SELECT DISTINCT document_id, page_no, blocks FROM ocr_pages WHERE blocks IS NOT NULL), b AS (SELECT document_id, page_no, unnest(blocks) AS b FROM p),
        c AS (SELECT document_id, page_no, least(39, greatest(0, floor(b.x0 * 40 / 595.0)))::INT AS c0, least(39, greatest(0, floor(b.x1 * 40 / 595.0)))::INT AS c1,
        least(39, greatest(0, floor(b.y0 * 40 / 842.0)))::INT AS r0, least(39, greatest(0, floor(b.y1 * 40 / 842.0)))::INT AS r1 FROM b),
        x AS (SELECT document_id, page_no, r0, r1, unnest(range(c0, c1 + 1)) AS c FROM c), y AS (SELECT DISTINCT document_id, page_no, c, unnest(range(r0, r1 + 1)) AS r FROM x)
        SELECT document_id, page_no, count(*) AS cells FROM y GROUP BY ALL""",
    "error_classes": """WITH e AS (SELECT *, try_cast(json_extract_string(props, '$.k') AS INT) AS k FROM events), f AS (SELECT user_id, CASE WHEN event_type <> 'error' THEN 'none' WHEN k IS NULL THEN 'malformed' WHEN k < 20 THEN 'timeout'
        WHEN k < 50 THEN 'http_status' WHEN value > 50 THEN 'too_large' ELSE 'content' END AS kind FROM e)
        SELECT kind, CASE WHEN kind = 'none' THEN 'none' WHEN kind IN ('timeout', 'http_status') THEN 'network' ELSE 'payload' END AS layer, count(*) AS n, count(DISTINCT user_id) AS users FROM f GROUP BY ALL""",
    "retry_sequences": """WITH e AS (SELECT *, event_type = 'error' AS bad, coalesce(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM events),
        s AS (SELECT user_id, run, count(*) AS attempts, count_if(bad) AS errors, bool_or(NOT bad) AS ended_well FROM e GROUP BY ALL) SELECT attempts, ended_well, count(*) AS sequences FROM s WHERE errors > 0 GROUP BY ALL""",
    "failure_windows": _TUMBLE,
    "failure_windows_sliding": _WIN.format(start="s", width="3 HOUR", src="(SELECT *, time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL (h) HOUR AS s FROM events, range(0, 3) r(h))"),
    "retry_sessions": """WITH a AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS c FROM events),
        b AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM a)
        SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS attempts, count_if(event_type = 'error') AS failures FROM b GROUP BY user_id, i""",
    "stream_failure_windows": _TUMBLE,
    # An event is delayed if it comes before the slot that the events before it leave free, slots being an hour apart.
    "stream_paced_users": """WITH r AS (SELECT user_id, epoch_us(ts) - 3600000000 * row_number() OVER (PARTITION BY user_id ORDER BY ts) AS u, ts FROM events WHERE user_id IS NOT NULL),
        m AS (SELECT user_id, u < max(u) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS late FROM r) SELECT user_id, count(*) AS granted, count_if(late) AS delayed FROM m GROUP BY 1""",
    "stream_first_deliveries": "SELECT DISTINCT event_id, ts, user_id, event_type FROM events",
    "stream_latest_per_user": """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE user_id IS NOT NULL)
        SELECT user_id, event_id, ts, event_type FROM r WHERE rn = 1""",
}
