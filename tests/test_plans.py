"""Plan assertions (no html in a shuffle, pushdown, partition pruning), the
export round trip, stream-versus-batch equality, and the driver entry."""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from trawl.functions.urls import normalize_url
from trawl.operators import export, extract, index
from trawl.streaming import incremental
SF001 = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_html_in_any_exchange(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    plan = _plan(index.inverted_index(extract.page_docs(pages)))
    for line in plan.splitlines():
        if "Exchange" in line:
            assert "html" not in line


def test_scan_prunes_columns(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    from trawl.functions.urls import normalize_url
    plan = _plan(pages.select(normalize_url(F.col("url"))))
    assert "ReadSchema: struct<url:string>" in plan


def test_export_round_trip_and_partition_pruning(spark, closed_web):
    docs = extract.page_docs(closed_web)
    post = index.inverted_index(docs)
    disc = docs.select("page_id", F.lit(1).cast("long").alias("job_id"), F.col("url").alias("origin_url"),
                       F.lit(0).alias("depth"))
    rows = export.export_rows(post, docs, disc)
    path = os.path.join(tempfile.mkdtemp(prefix="trawl-export-"), "index")
    export.write_letter_index(rows, path)
    back = export.read_letter_index(spark, path)
    assert sorted(map(tuple, back.select("term", "url", "frequency", "letter").collect())) == \
        sorted(map(tuple, rows.select("term", "url", "frequency", "letter").collect()))
    look = export.lookup(back, "Shared")
    assert "PartitionFilters: [isnotnull(letter" in _plan(look) and "= s)" in _plan(look)
    assert {x.term for x in look.collect()} == {"shared"}
    files = [f for f in os.listdir(path) if f.startswith("letter=")]
    assert "letter=s" in files


def test_stream_equals_batch(spark, closed_web):
    base = tempfile.mkdtemp(prefix="trawl-stream-")
    src = os.path.join(base, "src")
    # Repeated URLs stay in one file: which of two files comes first is up to their times.
    closed_web.select("page_id", "url", "html", normalize_url(F.col("url")).alias("n")).repartition(3, "n").drop("n").write.parquet(src)
    sink, ck = os.path.join(base, "sink"), os.path.join(base, "ck")
    incremental.run_index_stream(spark, src, sink, ck, max_files_per_trigger=1)
    streamed = incremental.read_postings(spark, sink)
    ext = extract.extract_pages(spark.read.parquet(src))
    first = (ext.groupBy("normalized_url")
             .agg(F.min_by(F.struct("page_id", "title", "body_text"), "page_id").alias("d"))
             .select("normalized_url", "d.*"))
    batch = index.inverted_index(first)
    cols = ["page_id", "field", "term", "frequency"]
    assert sorted(map(tuple, streamed.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
    # restart: nothing new is indexed twice
    incremental.run_index_stream(spark, src, sink, ck, max_files_per_trigger=1)
    assert incremental.read_registry(spark, sink).count() == first.count()


def test_stream_over_a_restart(spark):
    """New files after a restart: known URLs give nothing, segments change no result."""
    base = tempfile.mkdtemp(prefix="trawl-stream-")
    src, sink, ck = (os.path.join(base, x) for x in ("src", "sink", "ck"))

    def arrive(rows):
        spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(src)
        incremental.run_index_stream(spark, src, sink, ck, max_files_per_trigger=1)

    arrive([(5, "http://h.test/a#x", "<title>five</title>zebra"), (3, "http://h.test/a", "<title>three</title>apple"), (3, "http://h.test/a", "<title>three</title>apple")])
    arrive([(1, "http://H.test/a/", "<title>one</title>late"), (7, "http://h.test/b", "<title>seven</title>zoo")])
    post = incremental.read_postings(spark, sink)
    everything = sorted(map(tuple, post.select("page_id", "field", "term", "frequency").collect()))
    assert incremental.merge_batches(spark, sink) == 1
    arrive([(8, "http://h.test/c", "<title>eight</title>zinc"), (9, "not a url", "x"), (10, "http://h.test/b", "<title>again</title>")])
    docs = incremental.read_docs(spark, sink).select("page_id", "title", "batch_id").collect()
    assert sorted(map(tuple, docs)) == [(3, "three", 0), (7, "seven", 1), (8, "eight", 2)]
    after = incremental.read_postings(spark, sink)
    kept = after.filter(F.col("page_id") != 8).select("page_id", "field", "term", "frequency").collect()
    assert sorted(map(tuple, kept)) == everything
    found = incremental.read_postings(spark, sink, ["zoo", "zinc", "apple"])
    assert {x.term for x in found.collect()} == {"zoo", "zinc", "apple"}
    plan = _plan(found)
    assert plan.count("PartitionFilters") == 2 and "letter" in plan.split("PartitionFilters")[1][:200] and "letter" in plan.split("PartitionFilters")[2][:200]
    assert incremental.merge_batches(spark, sink) == 2
    assert incremental.read_postings(spark, sink).count() == after.count()


def test_stream_state_does_not_read_earlier_batches(spark):
    base = tempfile.mkdtemp(prefix="trawl-stream-")
    spark.createDataFrame([(1, "http://h.test/a", "x")], "page_id long, url string, html string").write.parquet(os.path.join(base, "s"))
    stream = incremental.new_urls(incremental.page_stream(spark, os.path.join(base, "s")))
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "html" not in plan.split("FlatMapGroupsInPandasWithState")[0] and "registry" not in plan


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["page_id", "relevant_url", "origin_url", "depth", "score", "title"]
