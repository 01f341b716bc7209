"""Extraction jobs over the page archive: page documents (H1/H3/U1/I3/I6) and
links (H2/U2/C1).

Only narrow columns leave the map side: html is read, parsed and dropped in
the same stage, so no Exchange ever carries it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.functions.html import with_page_fields
from trawl.functions.urls import with_normalized_url, with_url_facts
from trawl.operators._util import broadcast_if_small
from trawl.session import materialize
from trawl.sources.pages import accept_responses


def extract_pages(pages: DataFrame, *, with_links: bool = False) -> DataFrame:
    """Per archive row: page_id, url, normalized_url, title, body_text,
    content_length (and the raw href list when asked). Rows whose URL does not
    normalize, or whose response is not accepted (S2), are dropped."""
    acc = accept_responses(pages).select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    out = with_page_fields(acc, "html", title="title", text="body_text",
                           links="links" if with_links else None).drop("html")
    out = with_normalized_url(out, "url", "normalized_url").filter(F.col("normalized_url").isNotNull())
    return out.withColumn("content_length", F.length("body_text").cast("long"))


def dedup_by_normalized_url(ext: DataFrame) -> DataFrame:
    """I3 applied to the archive in page_id order: one row per normalized URL;
    page_id and url of the first row, content of the last (`source_id` names
    the archive row the content came from).

    Duplicates are found on narrow columns, written once; only the (normally tiny) set of
    duplicated ids is joined back, broadcast when its counted size allows, so
    the wide rows are never shuffled for this."""
    narrow = materialize(ext.select("page_id", "normalized_url", "url"), "urls")
    stats = (narrow.groupBy("normalized_url")
             .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_id"),
                  F.min_by("url", "page_id").alias("first_url"), F.max("page_id").alias("last_id"))
             .filter(F.col("n") > 1))
    ext = ext.withColumn("source_id", F.col("page_id"))
    stats, n_dup_urls = broadcast_if_small(stats)
    if n_dup_urls == 0:          # the common case: nothing to rewrite
        return ext
    dup_ids = (narrow.join(stats, "normalized_url")
               .select("page_id", (F.col("page_id") == F.col("last_id")).alias("keep"),
                       "first_id", "first_url"))
    dup_ids, _ = broadcast_if_small(dup_ids)
    return (ext.join(dup_ids, "page_id", "left")
            .filter(F.coalesce(F.col("keep"), F.lit(True)))
            .withColumn("page_id", F.coalesce("first_id", "page_id"))
            .withColumn("url", F.coalesce("first_url", "url"))
            .drop("keep", "first_id", "first_url"))


def page_docs(pages: DataFrame) -> DataFrame:
    """The `pages` relation of the engine: unique by normalized_url."""
    return dedup_by_normalized_url(extract_pages(pages)).select(
        "page_id", "normalized_url", "url", "title", "body_text", "content_length")


def page_links(pages: DataFrame, *, drop_skipped: bool = True) -> DataFrame:
    """H2 + C1: one row per (page, distinct href) in document order, with the
    href resolved against the page's normalized URL.

    Output: src_page_id, src_url (normalized), pos, href, dst_url (normalized),
    stored_url (raw href if it is an absolute http(s) URL, else dst_url)."""
    ext = extract_pages(pages, with_links=True)
    links = ext.select(F.col("page_id").alias("src_page_id"), F.col("normalized_url").alias("src_url"),
                       F.posexplode("links").alias("pos", "href"))
    links = with_normalized_url(links, "href", "dst_url", base="src_url")
    links = links.withColumn("pos", F.col("pos").cast("long"))
    links = links.withColumn(
        "stored_url", F.when(F.col("href").rlike(r"(?i)^https?://"), F.col("href")).otherwise(F.col("dst_url")))
    if drop_skipped:
        links = with_url_facts(links.filter(F.col("dst_url").isNotNull()), "dst_url", skip="_skip")
        links = links.filter(~F.col("_skip")).drop("_skip")
    return links
