"""Queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

from foliant.llm import consensus, encode, langid, names, ocr, pack, repetition, sample, splits
from foliant.llm.labels import label_language
from foliant.session import table
from pyspark.sql import functions as F


def _t(spark, d, *names):
    return [table(spark, d, n) for n in names]


def _identified(documents):
    return langid.identify(documents, langid.fitted(*langid.training_lines(documents)))


def p1_found(spark, d):
    (documents,) = _t(spark, d, "documents")
    return langid.label_cases(documents, _identified(documents))


def p1_languages(spark, d):
    (documents,) = _t(spark, d, "documents")
    return _identified(documents)


def p2_found(spark, d):
    (records,) = _t(spark, d, "raw_records")
    return consensus.disputed(consensus.consensus(consensus.votes_of(records))[0])


def p2_consensus(spark, d):
    (records,) = _t(spark, d, "raw_records")
    items, people = consensus.consensus(consensus.votes_of(records))
    return items.join(consensus.span_consensus(records, people, items), "item")


def p2_annotators(spark, d):
    (records,) = _t(spark, d, "raw_records")
    return consensus.consensus(consensus.votes_of(records))[1]


def p3_found(spark, d):
    labels, companies = _t(spark, d, "annexure_audit_document_labels", "cohort_companies")
    return names.link_names(labels, companies).select("label_id", "company_id")


def p3_error_rate(spark, d):
    """Edit distance of each linked label's name to the closest name of the company it means, over its length."""
    labels, companies = _t(spark, d, "annexure_audit_document_labels", "cohort_companies")
    linked = names.link_names(labels, companies).select("label_id", F.col("company_id").alias("issuer"))
    typed = labels.select("label_id", F.lower(F.trim("company")).alias("typed")).filter("typed <> ''").distinct()
    listed = names.listed_names(companies).select("issuer", F.lower("name").alias("listed")).distinct()
    rate = F.levenshtein("typed", "listed") * 1000 / F.length("listed")
    return typed.join(linked, "label_id").join(listed, "issuer").groupBy("label_id", "typed").agg(F.min(rate).alias("per_mille"))


def p3_issuers(spark, d):
    (companies,) = _t(spark, d, "cohort_companies")
    return names.issuers(companies)


def p4_found(spark, d):
    return splits.related_pairs(*_t(spark, d, "doc_records", "cohort_companies"))


def p4_split(spark, d):
    records, companies, register = _t(spark, d, "doc_records", "cohort_companies", "coverage_register")
    return splits.grouped_split(records, companies, splits.split_targets(register))


def p4_integrity(spark, d):
    """One row on the split: documents, documents and components in more than one split (none), splits in use."""
    own = p4_split(spark, d)
    by = lambda c: own.groupBy(c).agg(F.count_distinct("split").alias("n"), F.count_if(F.col("split").isNull()).alias("none"))
    docs = by("document_id").agg(F.count("*").alias("documents"), F.count_if((F.col("n") != 1) | (F.col("none") > 0)).alias("parted_documents"))
    parts = by("component").agg(F.count_if(F.col("n") > 1).alias("parted_components"))
    used = own.agg(F.count_distinct("split").alias("splits"))
    return docs.join(F.broadcast(parts)).join(F.broadcast(used))  # one row each


def p5_found(spark, d):
    return sample.selection_cases(*_t(spark, d, "doc_records", "selections"))


def p5_sample(spark, d):
    (records,) = _t(spark, d, "doc_records")
    return sample.document_sample(records).filter("selected").select("id", "batch", "digest", "batch_rank", "quota")


def p6_found(spark, d):
    pages, documents = _t(spark, d, "ocr_pages", "documents")
    return ocr.analyse(pages, [documents])[0]


def p6_paragraphs(spark, d):
    pages, documents = _t(spark, d, "ocr_pages", "documents")
    return ocr.repair(pages, [documents])


def p7_ids(spark, d):
    (documents,) = _t(spark, d, "documents")
    return encode.encode_corpus(documents)


def p8_containers(spark, d):
    (documents,) = _t(spark, d, "documents")
    return pack.pack_items(encode.token_counts(documents))


def p9_found(spark, d):
    (documents,) = _t(spark, d, "documents")
    return repetition.repetition_cases(documents, F.coalesce(label_language(F.col("lang")), F.lit("")))


def p9_outliers(spark, d):
    """Documents at or over the threshold of their own language and source, whatever the fixed four tenths say."""
    (documents,) = _t(spark, d, "documents")
    own = documents.select("doc_id", "text", F.coalesce(label_language(F.col("lang")), F.lit("")).alias("language"), "source")
    found = repetition.repetition_outliers(own, F.col("language"), F.col("source"), ceiling=1.0)
    return found.select("doc_id", "language", "source", "n_words", "n_repeated", "threshold")


def p9_shares(spark, d):
    (documents,) = _t(spark, d, "documents")
    return repetition.repetition_share(documents.select("doc_id", "text")).select("doc_id", "n_words", "n_repeated")


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_languages, p2_found, p2_consensus, p2_annotators, p3_found, p3_error_rate, p3_issuers, p4_found, p4_split, p4_integrity, p5_found, p5_sample,
        p6_found, p6_paragraphs, p7_ids, p8_containers, p9_found, p9_outliers, p9_shares,
    )
}

_NORMAL_ID = r"upper(replace(regexp_replace(document_id, '^\s+|\s+$', '', 'g'), '_', '-'))"

_RUNS = r"""
w AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(regexp_replace(coalesce(text, ''),
        '[^\p{L}\p{M}\s\p{Z}]+', '', 'g')), '[\s\p{Z}]+'), lambda x: x <> '') AS ws FROM documents),
i AS (SELECT doc_id, len(ws) AS n, unnest(range(1, len(ws) + 1)) AS p, ws FROM w),
g AS (SELECT doc_id, p, CASE WHEN p + 7 <= n THEN array_to_string(ws[p:p + 7], ' ') END AS gram FROM i),
c AS (SELECT doc_id, p, gram IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, gram) > 1 AS again FROM g),
r AS (SELECT doc_id, max(CASE WHEN again THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p
        ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS inside FROM c),
s AS (SELECT doc_id, count(*) AS n_words, sum(inside) AS n_repeated FROM r GROUP BY doc_id)
"""

ORACLES = {
    "p3_issuers": r"""
WITH own AS (SELECT company_id, max(CASE WHEN series_type = 'ordinary' THEN 1 WHEN series_type IS NOT NULL THEN 0 END) AS o, max(alternate_isins) AS alternate
    FROM cohort_companies WHERE company_id IS NOT NULL GROUP BY 1),
l AS (SELECT company_id, trim(x) AS other FROM (SELECT company_id, unnest(string_split(alternate, '|')) AS x FROM own)),
b AS (SELECT company_id, other FROM l UNION ALL SELECT other, company_id FROM l),
m AS (SELECT b.company_id, arg_max(b.other, (coalesce(x.o, -1), b.other)) AS other, max(x.o) AS o FROM b JOIN own x ON x.company_id = b.other JOIN own y ON y.company_id = b.company_id GROUP BY 1)
SELECT own.company_id, CASE WHEN m.o = 1 AND coalesce(own.o, 0) = 0 THEN m.other ELSE own.company_id END AS issuer FROM own LEFT JOIN m USING (company_id)
""",
    "p4_integrity": "SELECT count(DISTINCT document_id) AS documents, 0 AS parted_documents, 0 AS parted_components, 3 AS splits FROM doc_records",
    "p4_found": r"""
WITH RECURSIVE rec AS (SELECT company_id AS c, lower(regexp_replace(sha256, '^\s+|\s+$', '', 'g')) AS h,
    lower(regexp_replace(source_locator, '^\s+|\s+$', '', 'g')) AS l FROM doc_records WHERE trim(company_id) <> ''),
k AS (SELECT DISTINCT c, 'h' || h AS k FROM rec WHERE NOT regexp_matches(h, '^0*$')
  UNION SELECT DISTINCT c, 'l' || regexp_replace(regexp_replace(l, '^https?://', ''), '[?#].*$', '') FROM rec
  WHERE regexp_matches(l, '^https?://[^?#]')),
e AS (SELECT a.c AS u, b.c AS v FROM k a JOIN k b USING (k) WHERE a.c <> b.c
  UNION SELECT company_id, trim(x) FROM (SELECT company_id, unnest(string_split(alternate_isins, '|')) AS x FROM cohort_companies)
  WHERE trim(company_id) <> '' AND trim(x) <> '' AND company_id <> trim(x)),
s AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
t AS (SELECT u, v FROM s UNION SELECT t.u, s.v FROM t JOIN s ON t.v = s.u)
SELECT DISTINCT u AS company_id_a, v AS company_id_b FROM t WHERE u < v
""",
    "p5_found": rf"""
WITH s AS (SELECT {_NORMAL_ID} AS id, regexp_replace(regexp_replace(lower(regexp_replace(digest_hex, '\s+', '', 'g')),
    '^(sha-?256[:=]?)?(0x)?', ''), '[-:_]', '', 'g') AS g FROM selections)
SELECT DISTINCT document_id FROM doc_records WHERE {_NORMAL_ID} IN
  (SELECT id FROM s WHERE regexp_matches(g, '^[0-9a-f]{{64}}$') AND g <= '0{'c' * 63}')
""",
    "p5_sample": rf"""
WITH d AS (SELECT {_NORMAL_ID} AS id, strftime(min(ingested_at), '%Y-%m') AS batch FROM doc_records
    WHERE document_id IS NOT NULL GROUP BY 1),
h AS (SELECT id, batch, sha256('foliant-sample-1|' || id) AS digest FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY batch ORDER BY digest, id) - 1 AS batch_rank,
    CAST(ceil(count(*) OVER (PARTITION BY batch) / 20.0) AS BIGINT) AS quota FROM h)
SELECT id, batch, digest, batch_rank, quota FROM r WHERE batch_rank < quota
""",
    "p9_found": f"WITH {_RUNS} SELECT doc_id FROM s WHERE n_repeated * 10 >= n_words * 4",
    "p9_shares": f"""WITH {_RUNS} SELECT doc_id, CAST(coalesce(n_words, 0) AS INT) AS n_words,
    CAST(coalesce(n_repeated, 0) AS INT) AS n_repeated FROM documents LEFT JOIN s USING (doc_id)""",
}
