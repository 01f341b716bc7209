"""Benchmark: wall time of the headline work at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Two kinds of timings, as the engine is used:
  * build jobs over the page archive: extract + index + store (`index_build`),
    the crawl (`crawl_build`), the incremental stream index, and registered
    end-to-end driver queries that read the raw tables;
  * queries over the stored relations (postings partitioned by letter and
    sorted by term, documents, discoveries): the two searches, the batch
    search, the export and the fetch plan.
Every timed job runs to completion (noop sink or a parquet write); no rows
are collected. A small warm-up runs first so JIT set-up is not charged to
the first timing. Prints one JSON line.
"""
from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from trawl.functions.text import tokenize_py  # noqa: E402
from trawl.operators import batch, export, index, search  # noqa: E402
from trawl.plans import catalog, derived  # noqa: E402
from trawl.session import build_session, checkpoint_dir  # noqa: E402
from trawl.sources import index_store as store  # noqa: E402

END_TO_END = ["page_text", "url_normalize", "url_resolve_links", "term_freq_docs", "inverted_index",
              "search_weighted", "robots_allowed", "stream_index"]


def _noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        _noop(catalog.QUERIES["url_resolve_links"](spark, warm))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
        return out

    base = f"{checkpoint_dir(spark).rstrip('/')}/bench-{uuid.uuid4().hex[:8]}"
    corpus = derived.Corpus(spark, sf_dir)

    def build_index():
        docs = corpus.docs()
        store.write_table(docs, f"{base}/docs")
        store.write_postings(index.inverted_index(spark.read.parquet(f"{base}/docs")), f"{base}/page_terms")

    def build_crawl():
        r = corpus.crawl()
        store.write_table(r.discovered, f"{base}/discovered")
        store.write_table(r.page_discoveries, f"{base}/page_discoveries")

    timed("index_build", build_index)
    timed("crawl_build", build_crawl)
    docs = spark.read.parquet(f"{base}/docs")
    disc = spark.read.parquet(f"{base}/page_discoveries")
    discovered = spark.read.parquet(f"{base}/discovered")

    def q_weighted():
        post = store.postings_for(spark, f"{base}/page_terms", tokenize_py(catalog.QUERY_MAIN))
        _noop(search.weighted_search(post, docs, disc, catalog.QUERY_MAIN))

    def q_relevance():
        post = store.postings_for(spark, f"{base}/page_terms", tokenize_py(catalog.QUERY_RELEVANCE))
        _noop(search.relevance_search(post, docs, disc, catalog.QUERY_RELEVANCE, limit=None))

    def q_batch():
        qs = docs.select(F.col("page_id").alias("query_id"), F.col("title").alias("query"))
        _noop(batch.batch_search(store.read_postings(spark, f"{base}/page_terms"), docs, disc, qs))

    def q_export():
        export.write_letter_index(export.export_rows(store.read_postings(spark, f"{base}/page_terms"), docs, disc),
                                  f"{base}/letters")

    timed("stored_search_weighted", q_weighted)
    timed("stored_search_relevance", q_relevance)
    timed("stored_search_batch", q_batch)
    timed("stored_export_letters", q_export)
    for name in END_TO_END:
        timed(name, lambda n=name: _noop(catalog.QUERIES[n](spark, sf_dir)))

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
