"""Stored index: the engine's relations written once, searched many times.

`page_terms` is written partitioned by `letter` and sorted by term inside each
file, so a search reads it with two derived predicates: `letter IN (first
letters of the query tokens)` prunes folders, `term IN (tokens)` is pushed to
the parquet reader and skips row groups by their min/max statistics.

Relations that are kept up to date are written by hash buckets of their key. A
change reads and rewrites the buckets of its keys only, by dynamic partition
overwrite; the files of all others stay.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.operators.index import replace_postings, upsert_pages
from trawl.session import materialize


def write_postings(postings: DataFrame, path: str) -> None:
    """Dealt by ranges, so a letter or term with a third of all postings is
    written by many tasks, and each task writes few letters."""
    (postings.repartitionByRange("letter", "term", "page_id")
     .sortWithinPartitions("letter", "term", "page_id")
     .write.mode("overwrite").partitionBy("letter").parquet(path))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def letters_of(terms: list[str]) -> list[str]:
    return sorted({t[0] if t and t[0].isascii() and t[0].isalnum() else "_" for t in terms})


def postings_for(spark: SparkSession, path: str, terms: list[str]) -> DataFrame:
    """Postings of `terms` only: partition pruning on letter + pushed term filter."""
    p = read_postings(spark, path)
    if not terms:
        return p.filter(F.lit(False))
    return p.filter(F.col("letter").isin(*letters_of(terms)) & F.col("term").isin(*terms))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A folder for each bucket of `key`; the first write, or all of them anew."""
    _overwrite(df.withColumn("bucket", bucket_of(key, buckets)), path)


def _overwrite(df: DataFrame, path: str) -> None:
    (df.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket").parquet(path))


def _touched(spark: SparkSession, path: str, changed: DataFrame, key: str, buckets: int) -> tuple[DataFrame, list[int]]:
    """The stored rows of the buckets that `changed` has keys in, and those buckets."""
    numbers = [r[0] for r in changed.select(bucket_of(key, buckets).alias("b")).distinct().collect()]   # `buckets` rows at most
    return read_buckets(spark, path, key, numbers), numbers


def upsert_stored_pages(spark: SparkSession, path: str, incoming: DataFrame, buckets: int, seq: str = "seq") -> list[int]:
    """I3 on stored pages (`write_buckets` by normalized_url). Returns the buckets rewritten."""
    old, numbers = _touched(spark, path, incoming, "normalized_url", buckets)
    # Written aside first: the folders that are overwritten are read for it.
    merged = materialize(upsert_pages(old, incoming, seq), "pages-upsert")
    _overwrite(merged.withColumn("bucket", bucket_of("normalized_url", buckets)), path)
    return numbers


def replace_stored_postings(spark: SparkSession, path: str, new: DataFrame, changed: DataFrame, buckets: int) -> list[int]:
    """I2 on stored postings (`write_buckets` by page_id): those of the pages in
    `changed` (page_id) become `new`, or none. Returns the buckets rewritten."""
    old, numbers = _touched(spark, path, changed, "page_id", buckets)
    merged = materialize(replace_postings(old, new, changed), "postings-replace")
    # A bucket whose last posting went is not overwritten by rows; a row that no reader sees empties it.
    gone = spark.createDataFrame([(b,) for b in numbers], "bucket int")
    rows = merged.withColumn("bucket", bucket_of("page_id", buckets))
    empty = gone.join(rows.select("bucket").distinct(), "bucket", "left_anti")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in merged.schema.fields]
    _overwrite(rows.unionByName(empty.select(*columns, "bucket")), path)
    return numbers


def read_buckets(spark: SparkSession, path: str, key: str, numbers: list[int] | None = None) -> DataFrame:
    rows = spark.read.parquet(path).filter(F.col(key).isNotNull())
    return (rows if numbers is None else rows.filter(F.col("bucket").isin(numbers))).drop("bucket")
