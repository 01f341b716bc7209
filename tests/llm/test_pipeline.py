from __future__ import annotations

import corpus_pipeline as cp
from test_operators import brute_components, brute_lines, docs_of, line_key, rows_of  # noqa: F401

from trawl.llm import decontamination, quality_rules

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = cp.quality(spark, docs, SF).cache()
    assert rows_of(kept, "doc_id") == rows_of(quality_rules.quality_verdicts(docs).where("kept"), "doc_id")
    lined = cp.lines(spark, kept, SF).cache()
    want = {i: n - d for i, n, d, _ in brute_lines(docs_of(kept))}
    assert {r["doc_id"]: len(r["text"].split("\n")) if r["text"] else min(1, want[r["doc_id"]]) for r in lined.collect()} == want
    single = cp.near_duplicates(spark, lined, SF).cache()
    assert rows_of(single, "doc_id") == sorted([(i,) for i, n, c, k in brute_components(docs_of(lined), cp.NEAR_PERCENT) if k], key=repr)
    clean = cp.decontaminate(spark, single, SF).cache()
    leaks = decontamination.contaminated(single, spark.read.parquet(f"{SF}/benchmark.parquet"))
    assert clean.count() == single.count() - leaks.select("doc_id").distinct().count()
    out = cp.mixed(spark, clean, SF)
    assert [d.columns for d in (kept, lined, single, clean)] == [columns] * 4 and set(columns) < set(out.columns)
    assert {r["doc_id"] for r in out.collect()} <= {r["doc_id"] for r in clean.collect()}


def test_odd_documents_pass_every_stage(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, stage in cp.STAGES:
            docs = stage(spark, docs, SF).cache()
            docs.count()
