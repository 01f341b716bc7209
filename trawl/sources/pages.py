"""Page archive source (S1, S2) and table scans (S3)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl import schemas

# Fixed values that must equal the reference's.
MAX_BODY_SIZE = 2 * 1024 * 1024          # bytes declared / chars kept
HTML_CONTENT_TYPES = ("text/html", "application/xhtml+xml")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """The fetched-page archive (page_id, url, html[, content_type,
    content_length, http_status]); explicit schema, never inferred."""
    df = spark.read.parquet(path)
    wanted = [f.name for f in schemas.ARCHIVE.fields if f.name in df.columns]
    return df.select(*wanted)


def accept_responses(pages: DataFrame) -> DataFrame:
    """Keep HTML responses within the size limit, truncate the html, drop
    empty bodies. HTTP status is deliberately not checked (as in the
    reference: a 404 HTML page is indexed). Predicates on absent columns are
    skipped, so the plain driver table passes through."""
    df = pages
    cols = set(df.columns)
    if "content_type" in cols:
        ct = F.lower(F.coalesce(F.col("content_type"), F.lit("")))
        ok = F.lit(False)
        for t in HTML_CONTENT_TYPES:
            ok = ok | ct.contains(t)
        df = df.filter(ok)
    if "content_length" in cols:
        df = df.filter(F.coalesce(F.col("content_length"), F.lit(0)) <= MAX_BODY_SIZE)
    df = df.filter(F.col("html").isNotNull() & (F.col("html") != ""))
    return df.withColumn("html", F.left(F.col("html"), F.lit(MAX_BODY_SIZE)))
