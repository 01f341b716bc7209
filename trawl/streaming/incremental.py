"""Incremental index with Structured Streaming (ST1-ST6).

A file stream of fetched pages (explicit schema) is reduced to (normalized URL,
page id, file), of a batch's rows of one URL to the first page, and then to the URLs
that are not in the state store: a URL that has come before gives nothing. The store
(RocksDB) has an entry for each URL, so a batch costs its own size however many URLs
are known, and dedup is global and unbounded like a unique index (ST2). `foreachBatch` then reads
the texts of the batch's new pages from the batch's files, and writes pages and
postings under the batch's id, so a batch that is run again replaces its own output.

A page is searchable as soon as its batch commits (ST1, ST3); the checkpoint makes a
restart continue after the last committed batch (ST6); `maxFilesPerTrigger` bounds
the intake of a batch (ST4). Batches leave a file for each letter; `merge_batches`
rewrites those committed so far into one segment of term-sorted files, and searches
read that segment and the batches after it, of the letters they need.
"""
from __future__ import annotations

import os
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trawl import schemas
from trawl.functions.urls import with_normalized_url, with_url_facts
from trawl.operators import extract, index
from trawl.operators._util import broadcast_if_small
from trawl.session import cut_lineage, materialize
from trawl.sources.index_store import letters_of, write_postings
from trawl.sources.pages import accept_responses

URL_GROUPS = 1024        # a batch's URLs meet in so many groups at most
GROUP_ROWS = 100_000     # rows of a group that are held before they are reduced
PAGE_STREAM_SCHEMA = T.StructType(schemas.ARCHIVE.fields[:3])   # page_id, url, html


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def page_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None,
                glob: str | None = None) -> DataFrame:
    """ST1 source: parquet files of fetched pages in `source_dir` (optionally
    only names matching `glob`), schema given, never inferred."""
    r = spark.readStream.schema(PAGE_STREAM_SCHEMA)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(source_dir)


def _url_rows(pages: DataFrame) -> DataFrame:
    """(normalized_url, page_id, file) of accepted pages; no text is kept."""
    ok = accept_responses(pages.select("page_id", "url", "html", F.col("_metadata.file_path").alias("file"))).drop("html")
    return (with_normalized_url(ok, "url", "normalized_url").filter(F.col("normalized_url").isNotNull())
            .select("normalized_url", "page_id", "file"))


def new_urls(stream: DataFrame) -> DataFrame:
    """ST2: (normalized_url, page_id, file) of the URLs that no earlier batch had. A
    batch's rows meet by groups of URLs, each of which leaves its URLs' pages of the
    least id; the state store keeps the URLs. Pages without an id are left out."""

    def first_pages(key, frames, state):
        import pandas as pd

        held, rows, least = [], 0, 0
        for f in frames:
            held.append(f)
            rows += len(f)
            if rows > 2 * least + GROUP_ROWS:
                held = [pd.concat(held).sort_values(["page_id", "file"]).drop_duplicates("normalized_url")]
                rows = least = len(held[0])
        yield pd.concat(held).sort_values(["page_id", "file"]).drop_duplicates("normalized_url")[["page_id", "file", "normalized_url"]]

    rows = _url_rows(stream).where("page_id IS NOT NULL").withColumn("urls", F.pmod(F.xxhash64("normalized_url"), F.lit(URL_GROUPS)))
    first = rows.groupBy("urls").applyInPandasWithState(
        first_pages, "page_id long, file string, normalized_url string", "none boolean", "append", "NoTimeout")
    # Other columns than Python's, so that a projection makes Spark's own rows of them: the next exchange takes no others.
    return first.select("normalized_url", "page_id", "file").dropDuplicates(["normalized_url"])


def index_batch(spark: SparkSession, fresh: DataFrame, sink: str, batch_id: int = 0) -> None:
    """Pages and postings of a batch's new URLs, under `batch_id=<id>` (dynamic
    overwrite). The pages are read from the batch's files again and parsed where
    they are scanned; only the new URLs' ids meet them, broadcast when their
    measured size allows."""
    fresh = cut_lineage(fresh.select("page_id", "file"))
    files = [r["file"] for r in fresh.select("file").distinct().collect()]   # the files of one batch
    if not files:
        return
    numbers = F.broadcast(spark.createDataFrame(list(enumerate(files)), "no int, file string"))
    fresh, _ = broadcast_if_small(fresh.join(numbers, "file").select("page_id", "no"), materialize=False)
    rows = spark.read.schema(PAGE_STREAM_SCHEMA).parquet(*map(unquote, files)).withColumn("file", F.col("_metadata.file_path"))
    # A page repeated in a file is one page.
    docs = extract.extract_pages(rows.join(numbers, "file").join(fresh, ["page_id", "no"]).drop("file", "no"))
    docs = materialize(docs.withColumn("batch_id", F.lit(batch_id).cast("long")), "stream-batch")
    if docs.groupBy("page_id").count().where("count > 1").limit(1).count():
        docs = docs.dropDuplicates(["page_id"])

    def write(df: DataFrame, name: str, *by: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", *by).parquet(f"{sink}/{name}"))

    write(index.inverted_index(docs).withColumn("batch_id", F.lit(batch_id).cast("long")), "postings", "letter")
    write(docs.select("page_id", "normalized_url", "url", "title", "body_text", "content_length", "batch_id"), "docs")
    write(docs.select("normalized_url", "page_id", "batch_id"), "registry")


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run_index_stream(spark: SparkSession, source_dir: str, sink: str, checkpoint: str,
                     max_files_per_trigger: int | None = None, glob: str | None = None) -> None:
    """Run the incremental index over everything available now, then stop. Run again
    with the same checkpoint, it goes on with the files that have come since."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        q = (new_urls(page_stream(spark, source_dir, max_files_per_trigger, glob)).writeStream
             .outputMode("append")
             .foreachBatch(lambda df, batch_id: index_batch(spark, df, sink, batch_id))
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def merge_batches(spark: SparkSession, sink: str) -> int | None:
    """Rewrites the postings of all committed batches as one segment, dealt by ranges
    and sorted by term; returns the last batch in it. The segment counts once its row
    in `merged` is written, so a failed merge changes nothing. Batches and segments
    that it replaces stay until their owner deletes them."""
    if not _exists(spark, f"{sink}/registry"):
        return None
    # The registry is written last: a batch in it has its postings.
    last = spark.read.parquet(f"{sink}/registry").agg(F.max("batch_id")).first()[0]
    name = fresh_dir(f"{sink}/segments", f"upto-{last}")
    write_postings(read_postings(spark, sink).filter(F.col("batch_id") <= last), name)
    spark.createDataFrame([(last, name)], "last long, segment string").write.mode("append").parquet(f"{sink}/merged")
    return last


def read_postings(spark: SparkSession, sink: str, terms: list[str] | None = None) -> DataFrame:
    """ST3: what is committed is searchable: the newest segment and the batches after
    it. With `terms`, only their letters' folders are read."""
    segment, last = None, -1
    if _exists(spark, f"{sink}/merged"):
        last, segment = spark.read.parquet(f"{sink}/merged").agg(F.max(F.struct("last", "segment")).alias("m")).first()["m"]
    cols = ["page_id", "field", "term", "frequency", "letter", "batch_id"]
    out = spark.read.parquet(f"{sink}/postings").filter(F.col("batch_id") > last).select(*cols)
    if segment:
        # Not told apart any more: all rows of a segment are of its last batch or an earlier one.
        out = spark.read.parquet(segment).withColumn("batch_id", F.lit(last).cast("long")).select(*cols).unionByName(out)
    if terms is not None:
        out = out.filter(F.col("letter").isin(*letters_of(terms)) & F.col("term").isin(*terms)) if terms else out.limit(0)
    return out


def read_docs(spark: SparkSession, sink: str) -> DataFrame:
    """Documents indexed so far (first fetch of each URL)."""
    return spark.read.parquet(f"{sink}/docs")


def read_registry(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(f"{sink}/registry")


def run_host_counts(spark: SparkSession, source_dir: str, checkpoint: str, sink: str,
                    glob: str | None = None) -> DataFrame:
    """ST5: running page counts per host: a stateful streaming aggregation
    (state store, update mode); each batch's changed counts are merged into
    the parquet table at `sink` (latest count per host wins)."""
    s = with_url_facts(page_stream(spark, source_dir, glob=glob).select("url"), "url", host="host").select("host")

    def merge(df, batch_id):
        df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append").parquet(sink)

    q = (s.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
         .writeStream.outputMode("update").foreachBatch(merge)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    latest = spark.read.parquet(sink)
    return (latest.groupBy("host").agg(F.max_by("pages", "batch_id").alias("pages")))


def fresh_dir(base: str, name: str) -> str:
    import uuid

    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
