"""Tables the registered queries derive from the driver's `pages` table.

* the archive: page documents, unique by normalized URL;
* a link graph: the generated pages link only to URLs outside the table, so
  the traversal queries re-target every (page, href) edge to a page of the
  table: target page_id = first 15 hex digits of md5(page_id || '|' || href)
  modulo the page count (page ids are 0..n-1);
* crawl jobs: one job per host, whose origin is the host's lowest page_id
  page; job_id = that page_id; all with max_depth = CRAWL_DEPTH, created at a
  second of one day that follows from the id.

All three grow with the table; the crawl runs over all of it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.urls import with_normalized_url, with_url_facts
from trawl.operators import crawl as C
from trawl.operators import extract
from trawl.session import materialize
from trawl.sources.pages import read_table

CRAWL_DEPTH = 3
EDGE_HEX_DIGITS = 15   # 60 bits


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "pages")


class Corpus:
    """The archive of one scale factor, extracted and de-duplicated once per
    query (html parsed a single time), written to the checkpoint folder and
    shared by the documents, the link graph and the crawl."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self._rows: DataFrame | None = None
        self._urls: DataFrame | None = None

    @property
    def urls(self) -> DataFrame:
        """(page_id, url, normalized_url) of every row of `pages`."""
        if self._urls is None:
            p = with_normalized_url(pages(self.spark, self.sf).select("page_id", "url"), "url", "normalized_url")
            self._urls = materialize(p, "page-urls")
        return self._urls

    @property
    def rows(self) -> DataFrame:
        if self._rows is None:
            ext = extract.extract_pages(pages(self.spark, self.sf), with_links=True)
            self._rows = materialize(extract.dedup_by_normalized_url(ext), "archive")
        return self._rows

    def docs(self) -> DataFrame:
        return self.rows.select("page_id", "normalized_url", "url", "title", "body_text", "content_length")

    def closure_edges(self) -> DataFrame:
        """(src_url, pos, href, dst_url, stored_url, src_page_id, dst_page_id);
        links of the row that provides each URL's content."""
        n = self.urls.count()
        raw = self.rows.select("source_id", F.col("normalized_url").alias("src_url"),
                               F.col("page_id").alias("src_page_id"),
                               F.posexplode("links").alias("pos", "href"))
        target = (F.conv(F.substring(F.md5(F.concat(F.col("source_id").cast("string"), F.lit("|"),
                                                    F.col("href"))), 1, EDGE_HEX_DIGITS), 16, 10)
                  .cast("long") % F.lit(n))
        tgt = self.urls.select(F.col("page_id").alias("dst_page_id"), F.col("url").alias("stored_url"),
                               F.col("normalized_url").alias("dst_url"))
        return (raw.withColumn("dst_page_id", target).join(tgt, "dst_page_id")
                .select("src_url", F.col("pos").cast("long").alias("pos"), "href", "dst_url", "stored_url",
                        "src_page_id", "dst_page_id"))

    def real_edges(self) -> DataFrame:
        """The pages' own links resolved against the page URL."""
        links = self.rows.select(F.col("normalized_url").alias("src_url"),
                                 F.posexplode("links").alias("pos", "href"))
        links = with_normalized_url(links, "href", "dst_url", base="src_url")
        links = links.withColumn("stored_url", F.when(F.col("href").rlike(r"(?i)^https?://"), F.col("href"))
                                 .otherwise(F.col("dst_url")))
        links = with_url_facts(links.filter(F.col("dst_url").isNotNull()), "dst_url", skip="skip").filter(~F.col("skip"))
        return links.select("src_url", F.col("pos").cast("long").alias("pos"), "href", "dst_url", "stored_url")

    def jobs(self, depth: int = CRAWL_DEPTH) -> DataFrame:
        return jobs(self.spark, self.sf, depth)

    def archive(self) -> DataFrame:
        fetched = self.urls.select(
            "normalized_url", F.lit(None).cast("int").alias("http_status"), F.lit(None).cast("string").alias("content_type"))
        return C.prepare_archive(self.docs(), fetched.filter(F.col("normalized_url").isNotNull()))

    def crawl(self, depth: int = CRAWL_DEPTH, stop_after=None, rules: DataFrame | None = None) -> C.CrawlResult:
        return C.crawl(self.archive(), self.closure_edges(), self.jobs(depth), stop_after=stop_after, rules=rules)

    def real_crawl(self, depth: int = CRAWL_DEPTH) -> C.CrawlResult:
        return C.crawl(C.prepare_archive(self.docs()), self.real_edges(), self.jobs(depth))


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return extract.page_docs(pages(spark, sf))


def jobs(spark: SparkSession, sf: str, depth: int = CRAWL_DEPTH) -> DataFrame:
    p = with_url_facts(pages(spark, sf).select("page_id", "url"), "url", host="host")
    first = p.filter(F.col("host").isNotNull()).groupBy("host").agg(F.min_by("url", "page_id").alias("origin_url"),
                                                                      F.min("page_id").alias("job_id"))
    return first.select(F.col("job_id").cast("long").alias("job_id"), "origin_url",
                        F.lit(depth).cast("int").alias("max_depth"),
                        (F.lit(C.EPOCH).cast("timestamp_ntz") + F.make_dt_interval(
                            secs=((F.col("job_id") * 7919) % 86400).cast("decimal(18,6)"))).alias("created_at"))


def run_crawl(spark: SparkSession, sf: str, depth: int = CRAWL_DEPTH, stop_after=None) -> C.CrawlResult:
    return Corpus(spark, sf).crawl(depth, stop_after)


def run_real_crawl(spark: SparkSession, sf: str, depth: int = CRAWL_DEPTH) -> C.CrawlResult:
    return Corpus(spark, sf).real_crawl(depth)


def page_lang(html: str = "html"):
    return F.regexp_extract(F.col(html), r'<html lang="([a-z]+)"', 1)


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """Response headers derived from each page (the driver table has none):
    German pages are served as XHTML, French ones as JSON, pages with a query
    string with an upper-case HTML type; length = UTF-8 bytes of the html."""
    p = pages(spark, sf)
    lang = page_lang()
    ct = (F.when(lang == "de", "application/xhtml+xml").when(lang == "fr", "application/json")
          .when(F.col("url").contains("?"), "TEXT/HTML; charset=UTF-8").otherwise("text/html"))
    return p.select("page_id", "url", "html", ct.alias("content_type"),
                    F.octet_length("html").cast("long").alias("content_length"),
                    F.lit(200).alias("http_status"))


def robots(spark: SparkSession, sf: str) -> DataFrame:
    """One robots.txt per host, built from the host's first page: its language
    folder is disallowed except the first page itself; an upper-case path with
    an inline comment; a second agent group that does not apply."""
    p = with_url_facts(pages(spark, sf).select("page_id", "url"), "url", host="host")
    first = (p.filter(F.col("host").isNotNull()).groupBy("host")
             .agg(F.min_by("url", "page_id").alias("url")))
    seg = F.regexp_extract(F.col("url"), r"^https?://[^/]+/([^/?#]+)/([^/?#]+)", 1)
    pid = F.regexp_extract(F.col("url"), r"^https?://[^/]+/([^/?#]+)/([^/?#]+)", 2)
    text = F.concat_ws("\n", F.lit("User-agent: *"), F.concat(F.lit("Disallow: /"), seg, F.lit("/")),
                       F.concat(F.lit("  Allow: /"), seg, F.lit("/"), pid), F.lit("Disallow: /Private # keep out"),
                       F.lit("User-agent: OtherBot"), F.lit("Disallow: /"))
    return first.select("host", text.alias("text"))
