"""Inverted index build and maintenance.

Postings come from two explodes (one row per field, then one per token), a
filter, and one aggregate keyed by (page_id, field, term), all inside
whole-stage code generation. For the whole index pages are dealt by id before:
their text is smaller than their postings, which then move neither for this
aggregate nor for a later one by page. The postings of a few terms are counted
where pages are read and only they are shuffled.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.functions.text import SPLIT_RE, keep_token
from trawl.functions.urls import url_token_text
from trawl.operators._util import broadcast_if_small

FIELDS = ("title", "body", "url")


def letter_of(term: Column) -> Column:
    """First character if [a-z0-9], else '_'."""
    first = F.substring(term, 1, 1)
    return F.when(first.rlike("^[a-z0-9]$"), first).otherwise(F.lit("_"))


def _field_texts(docs: DataFrame) -> DataFrame:
    """(page_id, field, text): one row per field; the url field's text is
    host + path + query of the normalized URL (T4)."""
    d = docs.select("page_id", "title", "body_text", url_token_text(F.col("normalized_url")).alias("_url_text"))
    return d.select("page_id", F.explode(F.array(
        F.struct(F.lit("title").alias("field"), F.col("title").alias("text")),
        F.struct(F.lit("body").alias("field"), F.col("body_text").alias("text")),
        F.struct(F.lit("url").alias("field"), F.col("_url_text").alias("text")))).alias("f")
    ).select("page_id", "f.field", "f.text")


def _exploded_terms(df: DataFrame, text: str) -> DataFrame:
    """T1 as explode + filter: both run inside whole-stage code generation
    (a per-token lambda would be evaluated interpreted)."""
    t = df.withColumn("term", F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SPLIT_RE))).drop(text)
    return t.filter(keep_token(F.col("term")))


def _postings(docs: DataFrame, terms: list[str] | None) -> DataFrame:
    if terms is None:
        docs = docs.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "page_id")
    t = _exploded_terms(_field_texts(docs), "text")
    if terms is not None:
        t = t.filter(F.col("term").isin(*terms) if terms else F.lit(False))
    return (t.groupBy("page_id", "field", "term")
            .agg(F.count(F.lit(1)).alias("frequency"))
            .withColumn("letter", letter_of(F.col("term"))))


def inverted_index(docs: DataFrame) -> DataFrame:
    """page_terms(page_id, field, term, frequency, letter) for every page."""
    return _postings(docs, None)


def postings_for_terms(docs: DataFrame, terms: list[str]) -> DataFrame:
    """I1 restricted to `terms`; the term filter sits right after the explode,
    in the same code-generated stage, before any shuffle."""
    return _postings(docs, list(dict.fromkeys(terms)))


def term_frequencies(df: DataFrame, key: str, text: str) -> DataFrame:
    """T3 over any text column: (key, term, frequency)."""
    t = _exploded_terms(df.select(key, text), text)
    return t.groupBy(key, "term").agg(F.count(F.lit(1)).alias("frequency"))


def replace_postings(old: DataFrame, new: DataFrame, changed: DataFrame | None = None) -> DataFrame:
    """Every page present in `new` has its postings replaced wholesale, or every
    page of `changed` (page_id), which may also have none left."""
    changed = (new if changed is None else changed).select("page_id").distinct()
    return old.join(changed, "page_id", "left_anti").unionByName(new)


def upsert_pages(existing: DataFrame, incoming: DataFrame, seq: str = "seq") -> DataFrame:
    """Upsert by normalized_url. `existing` rows come first; within
    `incoming`, `seq` orders the writes. page_id and url keep the first value;
    title, body_text, content_length (and fetched_at when present) take the last.

    Which rows those are is found on narrow columns. Existing pages that nothing
    comes for are passed on where they are; only URLs meet them, broadcast when
    their measured size allows."""
    cols = ["page_id", "normalized_url", "url", "title", "body_text", "content_length"]
    if "fetched_at" in existing.columns and "fetched_at" in incoming.columns:
        cols.append("fetched_at")
    order = F.struct(F.col(seq).cast("long").alias("s"), "page_id")
    narrow = incoming.select("normalized_url", "page_id", "url", order.alias("o"))
    coming = narrow.groupBy("normalized_url").agg(F.min_by(F.struct("page_id", "url"), "o").alias("new"), F.max("o").alias("last"))
    coming, _ = broadcast_if_small(coming)
    urls = coming.select("normalized_url")
    old = existing.select("normalized_url", "page_id", "url").join(urls, "normalized_url").groupBy("normalized_url").agg(
        F.min(F.struct("page_id", "url")).alias("old"))
    first = coming.join(old, "normalized_url", "left").select(
        "normalized_url", F.coalesce("old", "new").alias("first"), "last")
    first, _ = broadcast_if_small(first)
    last = (incoming.withColumn("o", order).join(first, "normalized_url").where(F.col("o") == F.col("last"))
            .dropDuplicates(["normalized_url"])
            .withColumns({"page_id": F.col("first.page_id"), "url": F.col("first.url")}))
    return existing.join(urls, "normalized_url", "left_anti").select(*cols).unionByName(last.select(*cols))


def add_discoveries(existing: DataFrame, new: DataFrame) -> DataFrame:
    """I4: insert-or-ignore on (page_id, job_id, origin_url, depth)."""
    key = ["page_id", "job_id", "origin_url", "depth"]
    fresh = new.select(*key).dropDuplicates(key).join(existing.select(*key), key, "left_anti")
    return existing.select(*key).unionByName(fresh)


def page_count(docs: DataFrame) -> DataFrame:
    """I5."""
    return docs.agg(F.count(F.lit(1)).alias("page_count"))
