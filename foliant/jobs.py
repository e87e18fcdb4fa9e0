"""Jobs from a shell: ``python -m foliant.jobs NAME --tables DIR --out DIR``.

A job is a named list of queries over the tables of a folder; each result is written as Parquet
under its query's name. Any single query is a job of its own. Results that exist are left alone
unless ``--again`` is given, so an interrupted job goes on where it stopped.
"""

from __future__ import annotations

import argparse
import sys

from foliant.plans.catalogue import QUERIES
from foliant.session import table
from pyspark.sql import SparkSession

JOBS = {
    "universe": ("company_names", "isin_check", "entity_components", "rename_chains", "series_types", "master_outer_join"),
    "discover": ("locator_parts", "best_source_per_company_year", "missing_years"),
    "fetch": ("storage_path", "url_redaction", "duplicate_content", "latest_delivery"),
    "triage": ("page_triage", "doc_kind_rollup", "page_provenance", "page_languages", "broken_text", "index_pages"),
    "extract": ("section_outline", "section_contents", "section_heading", "section_body", "section_arbiter", "end_refinement", "document_grade", "reason_codes"),
    "audit": ("corpus_summary", "duplicate_content", "condition_coverage", "condition_interactions", "length_buckets", "review_manifest"),
    "orderqc": ("order_quality_doc", "order_quality_hidden", "threshold_sweep", "document_threshold_metrics", "subgroup_stability"),
    "sample-for-labelling": ("stratified_hash_sample", "pilot_draw", "cell_minimum_sample", "pages_of_interest"),
    "label": ("gold_violations", "record_violations", "superseded_records", "annotator_triggers"),
    "evaluate": ("prediction_status", "presence_table", "presence_scores", "stratified_evaluation", "worst_strata", "label_precision", "agreement_kappa"),
    "coverage": ("coverage_funnel", "funnel_grouping_sets", "loss_reason_distribution", "loss_concentration", "funnel_reconciliation"),
}
#: What ``preflight`` looks for: tables and the columns the jobs read.
TABLES = {
    "cohort_companies": ("company_id", "canonical_name"), "doc_records": ("document_id", "company_id"), "page_census": ("document_id", "physical_page"),
    "documents": ("doc_id", "text"), "ocr_pages": ("document_id", "page_no"), "raw_records": ("document_id", "presence_state"), "input_rows": ("document_id",),
    "annexure_audit_document_labels": ("label_id",), "events": ("event_id", "ts"),
}


def preflight(spark: SparkSession, tables: str) -> list[str]:
    """What is missing for the jobs to run; empty if nothing is."""
    missing = []
    for name, columns in TABLES.items():
        try:
            have = set(table(spark, tables, name).columns)
        except Exception as e:  # noqa: BLE001
            missing.append(f"{name}: {type(e).__name__}")
            continue
        missing += [f"{name}.{c}" for c in columns if c not in have]
    return missing


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def run(spark: SparkSession, name: str, tables: str, out: str, again: bool = False) -> list[str]:
    """Runs a job or a query; returns the names of the results written."""
    names = JOBS.get(name) or ((name,) if name in QUERIES else None)
    if names is None:
        raise ValueError(f"no such job or query: {name}")
    done = []
    for q in names:
        path = f"{out}/{q}"
        if again or not _exists(spark, path):
            QUERIES[q](spark, tables).write.mode("overwrite").parquet(path)
            done.append(q)
    return done


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="foliant.jobs", description="Runs a job over a folder of tables.")
    p.add_argument("name", help=f"{', '.join(JOBS)}, preflight, or a query")
    p.add_argument("--tables", required=True)
    p.add_argument("--out")
    p.add_argument("--again", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"foliant {a.name}").getOrCreate()
    if a.name == "preflight":
        missing = preflight(spark, a.tables)
        print("\n".join(missing) or "ready")
        return int(bool(missing))
    if not a.out:
        p.error("--out is needed")
    try:
        print("\n".join(run(spark, a.name, a.tables, a.out, a.again)))
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main())
