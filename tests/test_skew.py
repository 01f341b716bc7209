"""Hot keys and measured sizes: what must not end in one task or a broadcast."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trawl.operators import _util, batch, crawl, export, search
from trawl.sources import index_store


def test_broadcast_follows_measured_bytes(spark):
    long_texts = spark.range(100).select("id", F.repeat(F.lit("x"), 10_000).alias("t"))
    assert _util.measured(long_texts) == (100, 100 * (_util.ROW_OVERHEAD + 8 + 10_000))
    assert not _util.fits_broadcast(long_texts, max_bytes=500_000)[0]
    assert _util.fits_broadcast(long_texts.select("id"), max_bytes=500_000)[0]
    assert _util.measured(spark.range(0)) == (0, 0)


@pytest.fixture
def uncoalesced(spark):
    """Rows this few would be put into one task again."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, was)


def test_one_term_with_half_the_postings_spans_files(spark, tmp_path, uncoalesced):
    post = spark.range(20_000).select(
        F.col("id").alias("page_id"), F.lit("body").alias("field"), F.lit(1).cast("long").alias("frequency"),
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("term"),
    ).withColumn("letter", F.substring("term", 1, 1))
    index_store.write_postings(post, str(tmp_path / "post"))
    back = index_store.postings_for(spark, str(tmp_path / "post"), ["hot"])
    assert back.count() == 10_000
    assert back.select(F.input_file_name().alias("f")).distinct().count() > 1
    rows = post.select("term", F.concat(F.lit("http://h/"), F.col("page_id").cast("string")).alias("url"),
                       F.lit("o").alias("origin_url"), F.lit(0).cast("long").alias("depth"), "frequency", "letter")
    export.write_letter_index(rows, str(tmp_path / "letters"))
    hot = export.lookup(export.read_letter_index(spark, str(tmp_path / "letters")), "hot")
    assert hot.count() == 10_000
    assert hot.select(F.input_file_name().alias("f")).distinct().count() > 1


def test_lineage_of_paths_of_several_lengths(spark):
    rows = [("o", 1, 0, None), ("a", 1, 1, "o"), ("b", 1, 2, "a"), ("c", 1, 3, "b"), ("p", 2, 0, None)]
    d = spark.createDataFrame(rows, "normalized_url string, job_id long, depth int, discovered_from_url string")
    got = {r.normalized_url: r.path for r in crawl.lineage_paths(d, 3).collect()}
    assert got == {"o": "o", "a": "o > a", "b": "o > a > b", "c": "o > a > b > c", "p": "p"}


def test_equal_queries_get_equal_rows(spark):
    docs = spark.createDataFrame([(1, "http://h/1", "pear jam", "pear"), (2, "http://h/2", "fig", "pear fig")],
                                 "page_id long, url string, title string, body_text string")
    post = spark.createDataFrame([(1, "pear", "title", 1), (1, "pear", "body", 1), (2, "pear", "body", 1)],
                                 "page_id long, term string, field string, frequency long")
    qs = spark.createDataFrame([(7, "pear"), (3, " pear"), (9, "pear jam"), (4, None)], "query_id long, query string")
    out = batch.batch_search(post, docs, None, qs).collect()
    by = {q: sorted((r.rank, r.page_id, r.score) for r in out if r.query_id == q) for q in (3, 4, 7, 9)}
    assert by[3] == by[7] and len(by[3]) == 2 and by[4] == [] and len(by[9]) == 2


def test_totals_of_no_and_some_groups(spark):
    groups = spark.range(41).select(F.col("id").alias("url"))
    assert tuple(search.relevance_totals(groups).first()) == (41, 1, 20, 3)
    assert tuple(search.relevance_totals(groups.limit(0)).first()) == (0, 1, 20, 0)
