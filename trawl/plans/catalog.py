"""Registered driver queries: each is `(spark, sf_dir) -> DataFrame` over the
driver's parquet tables. Column names match the oracle SQL in `oracle.py`.

The page archive is the `pages` table (page_id, url, html). Every query reads
the whole table; nothing is sampled, capped or filtered by id.
"""
from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trawl.functions.html import decode_entities, extract_links, extract_text, extract_title
from trawl.functions.text import tokenize
from trawl.functions.urls import with_normalized_url, with_url_facts
from trawl.operators import batch, extract, index, search
from trawl.operators._util import broadcast_if_small
from trawl.session import checkpoint_dir, materialize
from trawl.sources import index_store as store
from trawl.sources.pages import read_table

# Fixed query strings of the search queries (chosen from words that occur in
# the generated pages at every scale factor).
QUERY_MAIN = "attion thanedble"
QUERY_PHRASE = "heed the"
QUERY_RELEVANCE = "ciónque des"

Query = Callable[[SparkSession, str], DataFrame]


def _pages(spark, sf):
    return read_table(spark, sf, "pages")


def q_page_title(spark, sf):
    return _pages(spark, sf).select("page_id", extract_title("html").alias("title"))


def q_page_text(spark, sf):
    p = _pages(spark, sf).select("page_id", extract_text("html").alias("body_text"))
    return p.select("page_id", "body_text", F.length("body_text").cast("long").alias("content_length"))


def q_page_links(spark, sf):
    p = _pages(spark, sf).select("page_id", F.posexplode(extract_links("html")).alias("pos", "href"))
    return p.select("page_id", F.col("pos").cast("long").alias("pos"), "href")


def q_entity_decode(spark, sf):
    d = _pages(spark, sf).select("page_id", decode_entities(F.col("html")).alias("d"))
    return d.select("page_id", F.length("d").cast("long").alias("decoded_length"), F.md5("d").alias("decoded_md5"))


def q_url_normalize(spark, sf):
    p = with_normalized_url(_pages(spark, sf).select("page_id", "url"), "url", "normalized_url")
    return p.select("page_id", "url", "normalized_url")


def q_url_resolve_links(spark, sf):
    links = extract.page_links(_pages(spark, sf), drop_skipped=False)
    return links.select(F.col("src_page_id").alias("page_id"), "pos", "href", "dst_url", "stored_url")


def q_url_skip_ext(spark, sf):
    links = extract.page_links(_pages(spark, sf), drop_skipped=False)
    links = with_url_facts(links, "dst_url", skip="skip", extension="extension")
    return links.select(F.col("src_page_id").alias("page_id"), "pos", "dst_url", "extension", "skip")


def q_url_host(spark, sf):
    p = with_url_facts(_pages(spark, sf).select("page_id", "url"), "url", host="host")
    return p.select("page_id", "host")


def q_url_hosts(spark, sf):
    """For each page, hosts that have more than one form or none, from its id."""
    n = (F.col("page_id") * 2654435761) % (1 << 32)
    y = F.lower(F.hex(F.col("page_id") % 65535 + 1))
    raw = [F.concat(F.lit("http://"), n, F.lit("/p")),
           F.concat(F.lit("http://0x"), F.hex(n), F.lit("/p")),
           F.concat(F.lit("http://0"), F.conv(F.shiftright(n, 24).cast("string"), 10, 8), F.lit("."), n % (1 << 24), F.lit("/p")),
           F.concat(F.lit("http://"), n % 300, F.lit(".1.1.1/")),
           F.concat(F.lit("http://[0:0:0:"), n % 2, F.lit(":0:0:0:"), y, F.lit("]:81/")),
           F.concat(F.lit("http://P"), F.col("page_id"), F.lit(".B\u00fccher.de/")),
           F.concat(F.lit("http://ex%4"), F.hex(F.col("page_id") % 15 + 1), F.lit("mple.com/")),
           F.concat(F.lit("http://h.test/?b=%C3%BC&a=%20"), F.col("page_id"), F.lit("%zz"))]
    cases = _pages(spark, sf).select("page_id", F.posexplode(F.array(*raw)).alias("case_no", "raw"))
    cases = with_url_facts(with_normalized_url(cases, "raw", "normalized_url"), "raw", host="host")
    return cases.select("page_id", F.col("case_no").cast("long").alias("case_no"), "normalized_url", "host")


def q_url_crawlable(spark, sf):
    p = with_url_facts(_pages(spark, sf).select("page_id", "url"), "url", crawlable="crawlable")
    return p.select("page_id", "crawlable")


def q_tokens_body(spark, sf):
    t = _pages(spark, sf).select("page_id", F.posexplode(tokenize(extract_text("html"))).alias("pos", "token"))
    return t.select("page_id", F.col("pos").cast("long").alias("pos"), "token")


def q_tokens_url(spark, sf):
    p = with_normalized_url(_pages(spark, sf).select("page_id", "url"), "url", "normalized_url")
    p = with_url_facts(p, "normalized_url", tokens="toks")
    t = p.select("page_id", F.posexplode("toks").alias("pos", "token"))
    return t.select("page_id", F.col("pos").cast("long").alias("pos"), "token")


def q_term_freq_body(spark, sf):
    p = _pages(spark, sf).select("page_id", extract_text("html").alias("body_text"))
    return index.term_frequencies(p, "page_id", "body_text")


def q_term_freq_docs(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", "text")
    return index.term_frequencies(d, "doc_id", "text")


def docs_of(spark, sf) -> DataFrame:
    return extract.page_docs(_pages(spark, sf))


def q_page_upsert(spark, sf):
    return docs_of(spark, sf).select("page_id", "normalized_url", "url", "title", "content_length")


def q_page_count(spark, sf):
    return index.page_count(docs_of(spark, sf))


def q_inverted_index(spark, sf):
    return index.inverted_index(docs_of(spark, sf)).select("page_id", "field", "term", "frequency", "letter")


def _docs_once(spark, sf) -> DataFrame:
    """Documents materialized once for queries that read them twice."""
    from trawl.plans.derived import Corpus
    return Corpus(spark, sf).docs()


def q_search_weighted(spark, sf):
    docs = _docs_once(spark, sf)
    post = index.postings_for_terms(docs, search.tokenize_py(QUERY_MAIN))
    return search.weighted_search(post, docs, None, QUERY_MAIN)


def q_search_phrase(spark, sf):
    docs = _docs_once(spark, sf)
    post = index.postings_for_terms(docs, search.tokenize_py(QUERY_PHRASE))
    return search.weighted_search(post, docs, None, QUERY_PHRASE)


def q_search_topk(spark, sf):
    docs = _docs_once(spark, sf)
    post = index.postings_for_terms(docs, search.tokenize_py(QUERY_MAIN))
    return search.weighted_search(post, docs, None, QUERY_MAIN, top_k=search.CLI_TOP_K)


QUERIES: dict[str, Query] = {
    "page_title": q_page_title,
    "page_text": q_page_text,
    "page_links": q_page_links,
    "entity_decode": q_entity_decode,
    "url_normalize": q_url_normalize,
    "url_resolve_links": q_url_resolve_links,
    "url_skip_ext": q_url_skip_ext,
    "url_host": q_url_host,
    "url_hosts": q_url_hosts,
    "url_crawlable": q_url_crawlable,
    "tokens_body": q_tokens_body,
    "tokens_url": q_tokens_url,
    "term_freq_body": q_term_freq_body,
    "term_freq_docs": q_term_freq_docs,
    "page_upsert": q_page_upsert,
    "page_count": q_page_count,
    "inverted_index": q_inverted_index,
    "search_weighted": q_search_weighted,
    "search_phrase": q_search_phrase,
    "search_topk": q_search_topk,
}


# ------------------------------------------------------------------ crawl
from trawl.operators import crawl as C  # noqa: E402
from trawl.plans import derived  # noqa: E402

BOUNDED_CAPACITY = 100   # that the status row reports against


def q_crawl_bfs(spark, sf):
    r = derived.run_crawl(spark, sf)
    return r.discovered.select("normalized_url", "url", "job_id", F.col("depth").cast("long").alias("depth"),
                               "discovered_from_url", "state", "page_id")


def q_crawl_multi_origin(spark, sf):
    r = derived.run_crawl(spark, sf)
    return (r.discovered.groupBy("job_id", F.col("depth").cast("long").alias("depth"))
            .agg(F.count(F.lit(1)).alias("urls")))


def q_crawl_lineage(spark, sf):
    r = derived.run_crawl(spark, sf)
    return C.lineage_paths(r.discovered, derived.CRAWL_DEPTH).select(
        "normalized_url", "job_id", F.col("depth").cast("long").alias("depth"), "path")


def q_frontier_admit(spark, sf):
    r = derived.run_crawl(spark, sf, depth=1)
    return (r.discovered.filter(F.col("depth") == 1)
            .select("normalized_url", "url", "job_id", F.col("depth").cast("long").alias("depth"),
                    "discovered_from_url", "parent_page_id", "pos"))


def _paused(spark, sf):
    """A crawl paused after fetching level 1: level 2 is admitted, not fetched."""
    return derived.run_crawl(spark, sf, depth=2, stop_after=1)


def q_frontier_pending(spark, sf):
    r = _paused(spark, sf)
    pend = C.frontier_of(r.discovered, derived.jobs(spark, sf, 2))
    return pend.select("normalized_url", "url", "job_id", "origin_url", F.col("depth").cast("long").alias("depth"),
                       "discovered_from_url")


def q_frontier_count(spark, sf):
    """J6."""
    return R.frontier_count(_paused(spark, sf).discovered)


QUERIES.update({
    "crawl_bfs": q_crawl_bfs,
    "crawl_multi_origin": q_crawl_multi_origin,
    "crawl_lineage": q_crawl_lineage,
    "frontier_admit": q_frontier_admit,
    "frontier_pending": q_frontier_pending,
    "frontier_count": q_frontier_count,
})


# ------------------------------------------------------- search over a crawl
def _crawled(spark, sf):
    c = derived.Corpus(spark, sf)
    return c.docs(), c.crawl()


def q_search_triples(spark, sf):
    d, r = _crawled(spark, sf)
    post = index.postings_for_terms(d, search.tokenize_py(QUERY_MAIN))
    return search.weighted_search(post, d, r.page_discoveries, QUERY_MAIN)


def batch_queries(spark, sf):
    """One query per page: its whole title (grows with the table)."""
    return _pages(spark, sf).select(F.col("page_id").alias("query_id"), extract_title("html").alias("query"))


def q_search_batch(spark, sf):
    d, r = _crawled(spark, sf)
    post = index.inverted_index(d)
    return batch.batch_search(post, d, r.page_discoveries, batch_queries(spark, sf),
                               top_k=search.CLI_TOP_K, dealt=True)


def q_search_stop_words(spark, sf):
    """Q14: of the titles as queries, every second one replaced by stop words, which find nothing."""
    d, r = _crawled(spark, sf)
    qs = batch_queries(spark, sf).withColumn("query", F.when(F.col("query_id") % 2 == 0, "the Of  and").otherwise(F.col("query")))
    return batch.batch_search(index.inverted_index(d), d, r.page_discoveries, qs, top_k=1, dealt=True)


def _relevance(spark, sf, sort_by="relevance", page=1, limit=None):
    d, r = _crawled(spark, sf)
    post = index.postings_for_terms(d, search.tokenize_py(QUERY_RELEVANCE))
    return search.relevance_search(post, d, r.page_discoveries, QUERY_RELEVANCE, sort_by=sort_by,
                                   page=page, limit=limit)


def q_search_relevance(spark, sf):
    return _relevance(spark, sf).drop("terms")


def q_search_relevance_terms(spark, sf):
    g = _relevance(spark, sf)
    return g.select("url", "origin_url", "depth", F.posexplode("terms").alias("term_rank", "t")).select(
        "url", "origin_url", "depth", F.col("term_rank").cast("long").alias("term_rank"),
        "t.term", "t.field", "t.frequency")


def q_search_by_frequency(spark, sf):
    return _relevance(spark, sf, sort_by="frequency", limit=search.DEFAULT_LIMIT).drop("terms")


def q_search_page2(spark, sf):
    return _relevance(spark, sf, sort_by="relevance", page=2, limit=search.DEFAULT_LIMIT).drop("terms")


def q_search_totals(spark, sf):
    """Q13: total and number of pages of the relevance search."""
    d, r = _crawled(spark, sf)
    post = index.postings_for_terms(d, search.tokenize_py(QUERY_RELEVANCE))
    return search.relevance_totals(search.relevance_groups(post, d, r.page_discoveries, QUERY_RELEVANCE))


# ------------------------------------------------------------ index upkeep
def q_index_replace(spark, sf):
    """Index built from the first fetch of every URL, then the postings of
    re-fetched URLs replaced by those of their latest fetch."""
    ext = materialize(extract.extract_pages(_pages(spark, sf)), "fetches")
    # Which fetch is the first is found on narrow columns; texts stay where they are.
    seen = ext.groupBy("normalized_url").agg(F.min("page_id").alias("page_id"), F.count(F.lit(1)).alias("n"))
    seen, _ = broadcast_if_small(seen)
    old = index.inverted_index(ext.join(seen.select("page_id"), "page_id", "left_semi"))
    docs = extract.dedup_by_normalized_url(ext)
    refetched = seen.filter(F.col("n") > 1).select("normalized_url")
    new = index.inverted_index(docs.join(refetched, "normalized_url", "left_semi"))
    return index.replace_postings(old, new).select("page_id", "field", "term", "frequency", "letter")


BUCKETS = 16


def _fetched(seconds):
    return F.lit(C.EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _refetched(spark, sf):
    """Stored pages, and what a later fetch brings: every fourth page with other texts,
    every next one again under a new URL."""
    base = ST.fresh_dir(checkpoint_dir(spark), "stored")
    d = materialize(_docs_once(spark, sf).withColumn("fetched_at", _fetched(F.col("page_id"))), "fetched")
    store.write_buckets(d, f"{base}/pages", "normalized_url", BUCKETS)
    n = d.agg(F.max("page_id")).first()[0] + 1
    new = F.col("page_id") % 4 == 1
    url = F.concat(F.lit("http://later.test/p"), F.col("page_id"))
    later = d.filter(F.col("page_id") % 4 < 2).select(
        (F.col("page_id") + n).alias("page_id"), F.when(new, url).otherwise(F.col("normalized_url")).alias("normalized_url"),
        F.when(new, url).otherwise(F.col("url")).alias("url"), F.concat(F.lit("Later "), "title").alias("title"),
        F.concat(F.lit("later "), "body_text").alias("body_text"), (F.col("content_length") + 6).alias("content_length"),
        _fetched(F.col("page_id") + 86400).alias("fetched_at"), F.col("page_id").alias("seq"))
    return base, d, later


def q_page_upsert_stored(spark, sf):
    """I3 on a stored table, with times."""
    base, _, later = _refetched(spark, sf)
    store.upsert_stored_pages(spark, f"{base}/pages", later, BUCKETS)
    return store.read_buckets(spark, f"{base}/pages", "normalized_url").select(
        "page_id", "normalized_url", "url", "title", "content_length", F.col("fetched_at").cast("string").alias("fetched_at"))


def q_index_replace_stored(spark, sf):
    """I2 on stored postings: those of the pages that the upsert changed."""
    base, d, later = _refetched(spark, sf)
    store.write_buckets(index.inverted_index(d), f"{base}/postings", "page_id", BUCKETS)
    store.upsert_stored_pages(spark, f"{base}/pages", later, BUCKETS)
    changed = (store.read_buckets(spark, f"{base}/pages", "normalized_url")
               .join(later.select("normalized_url"), "normalized_url", "left_semi"))
    changed = materialize(changed, "changed")
    store.replace_stored_postings(spark, f"{base}/postings", index.inverted_index(changed), changed, BUCKETS)
    return store.read_buckets(spark, f"{base}/postings", "page_id").select("page_id", "field", "term", "frequency", "letter")


def q_discovery_dedup(spark, sf):
    """I4: discoveries of a depth-1 crawl, then insert-or-ignore those of the
    full crawl."""
    c = derived.Corpus(spark, sf)
    r1 = c.crawl(depth=1)
    r3 = c.crawl()
    return index.add_discoveries(r1.page_discoveries, r3.page_discoveries).select(
        "page_id", "job_id", "origin_url", F.col("depth").cast("long").alias("depth"))


def q_response_accept(spark, sf):
    from trawl.sources.pages import accept_responses
    resp = derived.responses(spark, sf)
    acc = accept_responses(resp).select("page_id", F.length("html").cast("long").alias("html_length"))
    return (resp.select("page_id", "content_type", "content_length").join(acc, "page_id", "left")
            .select("page_id", "content_type", "content_length", F.col("html_length").isNotNull().alias("accepted"),
                    "html_length"))


# ---------------------------------------------------------------- reports
from trawl.operators import reports as R  # noqa: E402


def _real(spark, sf):
    """Crawl over the pages' own links (no re-targeting): level 1 URLs are
    not in the archive and fail."""
    return derived.run_real_crawl(spark, sf)


def q_url_outcomes(spark, sf):
    r = _real(spark, sf)
    return r.discovered.select("normalized_url", "job_id", F.col("depth").cast("long").alias("depth"), "state",
                               "error_message")


def _status_jobs(spark, sf, r, depth=derived.CRAWL_DEPTH):
    return R.job_status(r.jobs, r.discovered)


def q_job_counters(spark, sf):
    r = _real(spark, sf)
    return R.job_counters(r.jobs, r.discovered)


def q_job_list(spark, sf):
    r = derived.run_crawl(spark, sf, depth=2, stop_after=1)
    return R.job_list(_status_jobs(spark, sf, r)).select(
        "job_id", "origin_url", F.col("max_depth").cast("long").alias("max_depth"), "status",
        F.col("created_at").cast("string").alias("created_at"))


def q_jobs_active(spark, sf):
    r = derived.run_crawl(spark, sf, depth=2, stop_after=1)
    return R.active_jobs(_status_jobs(spark, sf, r)).select("job_id", "origin_url", "status")


def q_job_summary(spark, sf):
    r = _real(spark, sf)
    return R.job_summary(_status_jobs(spark, sf, r), r.discovered).select(
        "job_id", "origin_url", F.col("max_depth").cast("long").alias("max_depth"), "status",
        "discovered_count", "processed_count", "indexed_count", "error_count", "queued_count")


def q_url_state_stats(spark, sf):
    r = derived.run_crawl(spark, sf, depth=1)
    return R.url_state_stats(r.discovered)


def q_recent_errors(spark, sf):
    r = _real(spark, sf)
    return R.recent_errors(r.discovered, R.RECENT_ERRORS_STATUS).select(
        "normalized_url", "error_message", F.col("fetched_at").cast("string").alias("fetched_at"),
        F.col("depth").cast("long").alias("depth"), "job_id")


def q_status_row(spark, sf):
    r = derived.run_crawl(spark, sf, depth=1)
    return R.status_row(_status_jobs(spark, sf, r), r.discovered, capacity=BOUNDED_CAPACITY)


def _purged(spark, sf):
    d, r = _crawled(spark, sf)
    first_job = r.jobs.agg(F.min("job_id")).first()[0]
    return R.purge_job(first_job, r.jobs, r.discovered, r.page_discoveries, d, index.inverted_index(d))


def q_purge_job_pages(spark, sf):
    return _purged(spark, sf)["page_docs"].select("page_id", "normalized_url")


def q_purge_job_terms(spark, sf):
    return _purged(spark, sf)["page_terms"].select("page_id", "field", "term", "frequency")


def q_purge_job_jobs(spark, sf):
    return _purged(spark, sf)["jobs"].select("job_id", "origin_url")


def q_purge_job_urls(spark, sf):
    return _purged(spark, sf)["discovered"].select("normalized_url", "job_id",
                                                   F.col("depth").cast("long").alias("depth"), "state")


def q_purge_job_discoveries(spark, sf):
    return _purged(spark, sf)["page_discoveries"].select("page_id", "job_id", "origin_url",
                                                         F.col("depth").cast("long").alias("depth"))


# ------------------------------------------------------- reads by key (S3)
def q_page_by_url(spark, sf):
    """The page of one URL: the smallest of the table's."""
    d = _docs_once(spark, sf)
    url = d.agg(F.min("normalized_url")).first()[0]
    return d.filter(F.col("normalized_url") == F.lit(url)).select("page_id", "normalized_url", "url", "title",
                                                                  "content_length")


def q_job_by_id(spark, sf):
    """One job: the last of the table's."""
    j = derived.jobs(spark, sf)
    job = j.agg(F.max("job_id")).first()[0]
    return j.filter(F.col("job_id") == F.lit(job)).select("job_id", "origin_url")


def q_crawl_robots(spark, sf):
    """The crawl under the hosts' robots rules: processed, blocked or failed."""
    rules = RB.parse_rules(derived.robots(spark, sf))
    r = derived.Corpus(spark, sf).crawl(rules=rules)
    return r.discovered.select("normalized_url", "job_id", F.col("depth").cast("long").alias("depth"), "state",
                               "page_id", F.col("error_message").eqNullSafe(C.BLOCKED).alias("blocked"))


# ------------------------------------------------------------------ export
from trawl.operators import export as X  # noqa: E402
from trawl.streaming import incremental as ST  # noqa: E402

LOOKUP_TERM = "attion"


def q_export_letters(spark, sf):
    d, r = _crawled(spark, sf)
    return X.export_rows(index.inverted_index(d), d, r.page_discoveries)


def q_export_lookup(spark, sf):
    d, r = _crawled(spark, sf)
    path = ST.fresh_dir(checkpoint_dir(spark), "letter-index")
    X.write_letter_index(X.export_rows(index.inverted_index(d), d, r.page_discoveries), path)
    return X.lookup(X.read_letter_index(spark, path), LOOKUP_TERM).select(
        "term", "url", "origin_url", "depth", "frequency")


# ------------------------------------------------------------------ robots
from trawl.operators import robots as RB  # noqa: E402


def q_robots_rules(spark, sf):
    return RB.parse_rules(derived.robots(spark, sf)).select("host", "line", "path", "allow", "rank")


def q_robots_allowed(spark, sf):
    urls = docs_of(spark, sf).select("page_id", "normalized_url")
    return RB.allowed(urls, RB.parse_rules(derived.robots(spark, sf))).select("page_id", "normalized_url", "allowed")


# --------------------------------------------------------------- streaming
def _stream_dirs(spark, name):
    base = checkpoint_dir(spark)
    return ST.fresh_dir(base, f"{name}-sink"), ST.fresh_dir(base, f"{name}-ckpt")


def _page_files(sf):
    """The table as a stream's source: one file or a folder of them, which only a pattern may name alike."""
    return f"{sf.rstrip('/')}/{{pages.parquet}}"


def q_stream_index(spark, sf):
    """ST1: the table as one batch, so that a URL's first page is the one of the least
    id whatever files the table has."""
    sink, ck = _stream_dirs(spark, "stream-index")
    ST.run_index_stream(spark, _page_files(sf), sink, ck)
    return ST.read_postings(spark, sink).select("page_id", "field", "term", "frequency", "letter")


FILES = 3                # shares of the pages that come before the restart, and as many after it: a batch each
FILE_BYTES = 8 << 20     # of html in a file of a share, which one task reads


def _streamed(spark, sf, name):
    """The pages as files, indexed by a stream that takes a share of them a batch and is
    restarted between. First all pages, dealt by URL; after the restart the pages of
    even id once more under new ids, with another title, and the others' texts under
    a new URL. A share has as many files as its bytes fill."""
    base = ST.fresh_dir(checkpoint_dir(spark), name)
    p = _pages(spark, sf).select("page_id", "url", "html")
    last, size = p.agg(F.max("page_id"), F.sum(F.octet_length("html"))).first()
    n, files = last + 1, max(1, math.ceil((size or 0) / (FILES * FILE_BYTES)))
    dealt = with_normalized_url(p, "url", "n").repartition(FILES * files, "n").drop("n")
    dealt.write.parquet(f"{base}/pages")
    ST.run_index_stream(spark, f"{base}/pages", f"{base}/sink", f"{base}/checkpoint", max_files_per_trigger=files)
    later = p.select((F.col("page_id") + n).alias("page_id"),
                     F.when(F.col("page_id") % 2 == 0, F.col("url")).otherwise(F.concat(F.lit("http://later.test/p"), "page_id")).alias("url"),
                     F.replace("html", F.lit("<title>"), F.lit("<title>Later ")).alias("html"))
    later.repartition(FILES * files, "page_id").write.mode("append").parquet(f"{base}/pages")
    ST.run_index_stream(spark, f"{base}/pages", f"{base}/sink", f"{base}/checkpoint", max_files_per_trigger=files)
    return f"{base}/sink"


def q_stream_dedup(spark, sf):
    """ST2, ST4, ST6: the first page of each URL over several batches and a restart."""
    return ST.read_docs(spark, _streamed(spark, sf, "stream-dedup")).select("normalized_url", "page_id", "url", "title")


def q_stream_batches(spark, sf):
    """ST4, ST6: no page is indexed twice, and no batch has more than a file's share."""
    d = ST.read_docs(spark, _streamed(spark, sf, "stream-batches"))
    b = d.groupBy("batch_id").agg(F.count("*").alias("n"))
    return b.agg(F.sum("n").alias("pages"), (F.count("*") >= 4).alias("several_batches"),
                 (F.max("n") < 0.6 * F.sum("n")).alias("bounded"))


def q_stream_search(spark, sf):
    """ST3: search what the incremental index has committed, in part merged."""
    sink = _streamed(spark, sf, "stream-search")
    ST.merge_batches(spark, sink)
    post = ST.read_postings(spark, sink, search.tokenize_py(QUERY_MAIN))
    return search.weighted_search(post, ST.read_docs(spark, sink), None, QUERY_MAIN)


def q_stream_counts(spark, sf):
    sink, ck = _stream_dirs(spark, "stream-counts")
    return ST.run_host_counts(spark, _page_files(sf), ck, sink).select("host", "pages")


QUERIES.update({
    "search_triples": q_search_triples,
    "search_batch": q_search_batch,
    "search_stop_words": q_search_stop_words,
    "search_relevance": q_search_relevance,
    "search_relevance_terms": q_search_relevance_terms,
    "search_by_frequency": q_search_by_frequency,
    "search_page2": q_search_page2,
    "index_replace": q_index_replace,
    "index_replace_stored": q_index_replace_stored,
    "page_upsert_stored": q_page_upsert_stored,
    "discovery_dedup": q_discovery_dedup,
    "response_accept": q_response_accept,
    "url_outcomes": q_url_outcomes,
    "job_counters": q_job_counters,
    "job_list": q_job_list,
    "jobs_active": q_jobs_active,
    "job_summary": q_job_summary,
    "url_state_stats": q_url_state_stats,
    "recent_errors": q_recent_errors,
    "status_row": q_status_row,
    "purge_job_pages": q_purge_job_pages,
    "purge_job_terms": q_purge_job_terms,
    "purge_job_jobs": q_purge_job_jobs,
    "purge_job_urls": q_purge_job_urls,
    "purge_job_discoveries": q_purge_job_discoveries,
    "page_by_url": q_page_by_url,
    "job_by_id": q_job_by_id,
    "crawl_robots": q_crawl_robots,
    "search_totals": q_search_totals,
    "export_letters": q_export_letters,
    "export_lookup": q_export_lookup,
    "robots_rules": q_robots_rules,
    "robots_allowed": q_robots_allowed,
    "stream_index": q_stream_index,
    "stream_dedup": q_stream_dedup,
    "stream_batches": q_stream_batches,
    "stream_counts": q_stream_counts,
    "stream_search": q_stream_search,
})
