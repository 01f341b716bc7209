"""The streamed tables: one file or a folder of them, shares of many files, a batch's first pages."""
from __future__ import annotations

import glob
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from trawl.plans import catalog
from trawl.streaming import incremental

PAGES = [(k, f"http://h{k % 3}.test/{'same' if k in (2, 11) else k}", f"<title>t{k}</title><p>word{k} apple</p>") for k in range(12)]


def _table(spark, files):
    """The pages from the highest id down, so that a folder's first file has not the least ids."""
    at = tempfile.mkdtemp(prefix="trawl-table-")
    rows = spark.createDataFrame(PAGES, "page_id long, url string, html string").orderBy(F.desc("page_id"))
    if files == 1:
        rows.toPandas().to_parquet(f"{at}/pages.parquet", index=False)
    else:
        for k in range(files):
            rows.where(F.floor(F.col("page_id") / (12 // files)) == files - 1 - k).coalesce(1).write.mode("append").parquet(f"{at}/pages.parquet")
    return at


@pytest.mark.parametrize("name", ["stream_counts", "stream_index"])
def test_a_table_may_be_a_folder(spark, name):
    one, folder = (sorted(map(tuple, catalog.QUERIES[name](spark, _table(spark, n)).collect())) for n in (1, 3))
    assert one and one == folder
    if name == "stream_index":
        assert {r[0] for r in one} == set(range(11))   # 11 has the URL of 2


def test_a_share_has_many_files(spark, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_BYTES", 60)
    sf = _table(spark, 1)
    sink = catalog._streamed(spark, sf, "stream-shares")
    files = glob.glob(os.path.join(sink.removeprefix("file:"), os.pardir, "pages", "*.parquet"))
    assert len(files) > 2 * catalog.FILES
    docs = incremental.read_docs(spark, sink).select("page_id", "normalized_url", "batch_id").collect()
    assert len({d.batch_id for d in docs}) <= 2 * catalog.FILES
    first = {d.normalized_url: d.page_id for d in docs}
    assert len(first) == len(docs) == 11 + 6   # the URLs, and those of the odd ids after the restart


def test_first_page_of_a_batch_over_its_files(spark, monkeypatch):
    """The least id of a batch's files; pages without an id leave the others as they are."""
    monkeypatch.setattr(incremental, "URL_GROUPS", 2)
    monkeypatch.setattr(incremental, "GROUP_ROWS", 1)
    base = tempfile.mkdtemp(prefix="trawl-first-")
    for rows in ([(7, "http://a.test/x", "a"), (None, "http://a.test/y", "b"), (3, "http://a.test/z", "c")],
                 [(5, "http://a.test/x#f", "d"), (9, "http://a.test/y", "e"), (3, "http://a.test/z", "c")],
                 [(6, "http://a.test/x", "f"), (2 ** 60 + 1, "http://a.test/w", "g")]):
        spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.mode("append").parquet(f"{base}/src")
    incremental.run_index_stream(spark, f"{base}/src", f"{base}/sink", f"{base}/ck")
    found = incremental.read_docs(spark, f"{base}/sink").select("normalized_url", "page_id").collect()
    assert sorted(r.page_id for r in found) == [3, 5, 9, 2 ** 60 + 1]
