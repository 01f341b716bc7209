"""Traversal on the closed web against a brute-force Python BFS, plus the
pending frontier, robots, report and purge operators."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trawl.operators import crawl as C
from trawl.functions.urls import normalize_url
from trawl.operators import extract, reports, robots


def _inputs(spark, closed_web, jobs):
    docs = extract.page_docs(closed_web)
    fetched = closed_web.select(F.col("url")).select(
        normalize_url(F.col("url")).alias("normalized_url"),
        F.lit(None).cast("int").alias("http_status"), F.lit(None).cast("string").alias("content_type"))
    archive = C.prepare_archive(docs, fetched)
    rows = extract.dedup_by_normalized_url(extract.extract_pages(closed_web, with_links=True))
    links = extract.page_links(closed_web).join(rows.select(F.col("source_id").alias("src_page_id")),
                                                "src_page_id", "left_semi")
    j = spark.createDataFrame(jobs, "job_id long, origin_url string, max_depth int")
    return archive, links, j


def _brute_force(archive, links, jobs):
    """Level-synchronous BFS in plain Python (tiny inputs only)."""
    arch = {r.normalized_url: (r.page_id, r.indexed) for r in archive.collect()}
    out = {}
    for r in links.orderBy("src_url", "pos").collect():
        out.setdefault(r.src_url, []).append((r.pos, r.dst_url, r.stored_url))
    import urllib.parse as up

    def norm(u):  # the origins used here are already canonical
        return u if up.urlsplit(u).path else u + "/"

    seen, rows = set(), []
    level = {}
    for job_id, origin, k in sorted(jobs):
        n = norm(origin)
        if n not in level:
            level[n] = (job_id, None, None, origin, k, None)
    depth = 0
    while level:
        seen.update(level)
        nxt = {}
        for url, (job, _, _, origin, k, _) in level.items():
            pid, indexed = arch.get(url, (None, None))
            state = "failed" if indexed is None else "processed"
            rows.append((url, job, depth, state))
            if indexed and depth < k:
                for pos, dst, stored in out.get(url, []):
                    if dst in seen:
                        continue
                    cand = (job, pid, pos, origin, k, url)
                    if dst not in nxt or cand[:3] < nxt[dst][:3]:
                        nxt[dst] = cand
        level = nxt
        depth += 1
    return sorted(rows)


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_bfs_matches_brute_force(spark, closed_web, k):
    jobs = [(1, "http://a.test/", k), (2, "http://b.test/x", k), (3, "http://a.test/", k)]
    archive, links, j = _inputs(spark, closed_web, jobs)
    r = C.crawl(archive, links, j)
    got = sorted((x.normalized_url, x.job_id, x.depth, x.state) for x in r.discovered.collect())
    assert got == _brute_force(archive, links, jobs)


def test_bfs_semantics(spark, closed_web):
    jobs = [(1, "http://a.test/", 3), (2, "http://b.test/x", 3), (3, "http://a.test/", 3)]
    archive, links, j = _inputs(spark, closed_web, jobs)
    r = C.crawl(archive, links, j)
    d = {x.normalized_url: x for x in r.discovered.collect()}
    # one row per canonical URL: /p, /p/ and /p#x are one page
    assert "http://a.test/p" in d and sum(u.startswith("http://a.test/p") for u in d) == 1
    assert "http://a.test/img.png" not in d           # skipped extension
    assert d["http://a.test/missing"].state == "failed"   # not in the archive
    assert d["http://b.test/z"].state == "processed" and d["http://b.test/z"].page_id is None  # non-HTML
    assert d["http://a.test/404"].page_id is not None     # status is not checked
    assert d["http://a.test/r?a=1&b=2"].url == "http://a.test/r?a=1&b=2"
    # job 3 shares job 1's origin: it owns nothing
    assert not [x for x in d.values() if x.job_id == 3]
    status = {x.job_id: x.status for x in r.jobs.collect()}
    assert status == {1: "completed", 2: "completed", 3: "completed"}


def test_crawl_under_robots_rules(spark, closed_web):
    jobs = [(1, "http://a.test/", 3)]
    archive, links, j = _inputs(spark, closed_web, jobs)
    free = {x.normalized_url: x for x in C.crawl(archive, links, j).discovered.collect()}
    # /missing is linked from /p, so each is blocked in a crawl of its own
    for path in ("p", "missing"):
        url = f"http://a.test/{path}"
        text = spark.createDataFrame([("a.test", f"User-agent: *\nDisallow: /{path}")], "host string, text string")
        r = C.crawl(archive, links, j, rules=robots.parse_rules(text))
        got = {x.normalized_url: x for x in r.discovered.collect()}
        assert (got[url].state, got[url].page_id, got[url].error_message) == ("processed", None, C.BLOCKED)
        # nothing is discovered from a blocked page, and it is not indexed
        assert not [x for x in got.values() if x.discovered_from_url == url]
        assert free[url].page_id is None or free[url].page_id not in {x.page_id for x in r.page_discoveries.collect()}
    assert free["http://a.test/missing"].state == "failed"
    everything = spark.createDataFrame([("a.test", "User-agent: *\nDisallow: /")], "host string, text string")
    assert C.crawl(archive, links, j, rules=robots.parse_rules(everything)).discovered.count() == 1


def test_lineage_and_frontier_ops(spark, closed_web):
    jobs = [(1, "http://a.test/", 2)]
    archive, links, j = _inputs(spark, closed_web, jobs)
    r = C.crawl(archive, links, j, stop_after=0)
    pend = C.frontier_of(r.discovered, j)
    assert pend.count() == r.discovered.filter(F.col("depth") == 1).count() > 0
    assert reports.frontier_count(r.discovered).first()["count"] == pend.count()
    assert {x.fetched_at is None for x in pend.collect()} == {True}
    full = C.crawl(archive, links, j)
    paths = {x.normalized_url: x.path for x in C.lineage_paths(full.discovered, 2).collect()}
    assert paths["http://a.test/"] == "http://a.test/"
    assert paths["http://a.test/s"].startswith("http://a.test/ > ")


def test_robots_rules_and_match(spark):
    text = "\n".join([
        "User-agent: OtherBot", "Disallow: /", "",
        "User-agent: *", "Disallow: /private", "Allow: /private/ok", "Disallow: /Docs # old",
        "User-agent: TrawlBot", "Disallow: /tmp",
        "User-agent: nobody", "Disallow: /a"])
    rb = spark.createDataFrame([("h.test", text)], "host string, text string")
    rules = robots.parse_rules(rb)
    got = sorted((x.path, x.allow) for x in rules.collect())
    assert got == [("/docs # old", False), ("/private", False), ("/private/ok", True), ("/tmp", False)]
    urls = spark.createDataFrame([(u,) for u in [
        "http://h.test/private/x", "http://h.test/private/ok/1", "http://h.test/public",
        "http://h.test/tmp/x", "http://h.test/Docs", "http://other.test/private"]], "normalized_url string")
    allowed = {x.normalized_url: x.allowed for x in robots.allowed(urls, rules).collect()}
    assert allowed == {"http://h.test/private/x": False, "http://h.test/private/ok/1": True,
                       "http://h.test/public": True, "http://h.test/tmp/x": False,
                       "http://h.test/Docs": True, "http://other.test/private": True}


def test_reports_and_purge(spark):
    jobs = spark.createDataFrame([(1, "o1", 1, "completed"), (2, "o2", 1, "completed"), (3, "o3", 1, "completed")],
                                 "job_id long, origin_url string, max_depth int, status string")
    disc = spark.createDataFrame([
        ("u1", 1, "processed", 10), ("u2", 1, "failed", None), ("u3", 1, "skipped", None),
        ("u4", 2, "processed", 11), ("u5", 2, "queued", None)],
        "normalized_url string, job_id long, state string, page_id long")
    c = {x.job_id: x for x in reports.job_counters(jobs, disc).collect()}
    assert (c[1].discovered_count, c[1].processed_count, c[1].indexed_count, c[1].error_count,
            c[1].queued_count) == (2, 2, 1, 1, 0)
    assert (c[2].discovered_count, c[2].queued_count) == (2, 1)
    assert c[3].discovered_count == 0
    st = {x.job_id: x.status for x in reports.job_status(jobs, disc).collect()}
    assert st == {1: "completed", 2: "running", 3: "completed"}
    hist = {x.state: x["count"] for x in reports.url_state_stats(disc).collect()}
    assert hist == {"processed": 2, "failed": 1, "skipped": 1, "queued": 1}
    # purge: page 10 only job 1, page 11 shared by jobs 1 and 2
    pd = spark.createDataFrame([(10, 1, "o1", 0), (11, 1, "o1", 1), (11, 2, "o2", 0)],
                               "page_id long, job_id long, origin_url string, depth int")
    docs = spark.createDataFrame([(10, "u1"), (11, "u4"), (12, "u9")], "page_id long, normalized_url string")
    post = spark.createDataFrame([(10, "a", "body", 1), (11, "b", "body", 1)],
                                 "page_id long, term string, field string, frequency long")
    out = reports.purge_job(1, jobs, disc, pd, docs, post)
    assert sorted(x.page_id for x in out["page_docs"].collect()) == [11, 12]
    assert [x.page_id for x in out["page_terms"].collect()] == [11]
    assert sorted(x.job_id for x in out["jobs"].collect()) == [2, 3]


def test_response_acceptance(spark, closed_web):
    """HTML/XHTML content types (any case), declared size within the
    limit, non-empty body; the HTTP status is not checked."""
    from trawl.sources.pages import accept_responses
    kept = {r.page_id for r in accept_responses(closed_web).collect()}
    assert 7 not in kept           # application/pdf
    assert 8 not in kept           # declared 3,000,000 bytes
    assert 10 not in kept          # empty body
    assert {5, 9, 2} <= kept       # upper-case type, 404 status, type with charset


def test_one_antijoin_a_level(spark, closed_web):
    """Earlier levels are one bucketed table, which no exchange deals out again."""
    rows = spark.createDataFrame([(f"http://a.test/{i}",) for i in range(50)], "normalized_url string")
    seen = C.SeenTable(spark, 3)
    for k in range(4):
        seen.add(rows.filter(F.crc32("normalized_url") % 5 == k).repartition(3, "normalized_url"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        left = seen.unseen(rows)
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert plan.count("LeftAnti") == 1 and plan.split("LeftAnti")[1].count("Exchange") == 1, plan
        assert {x[0] for x in left.collect()} == {x[0] for x in rows.filter(F.crc32("normalized_url") % 5 == 4).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        seen.drop()


@pytest.mark.parametrize("depth", [0, 1, 40])
def test_lineage_doubles_paths(spark, depth):
    rows = [(f"u{i}", 1, i, f"u{i - 1}" if i else None) for i in range(depth + 1)] + [("alone", 2, 1, "gone")]
    d = spark.createDataFrame(rows, "normalized_url string, job_id long, depth int, discovered_from_url string")
    got = {x.normalized_url: x.path for x in C.lineage_paths(d, max(depth, 1)).collect()}
    assert got == {f"u{i}": " > ".join(f"u{k}" for k in range(i + 1)) for i in range(depth + 1)} | {"alone": "gone > alone"}


def test_robots_of_a_hot_host(spark):
    """Many rules times many paths on one host meet by prefix, never all with all."""
    n = 20_000
    rules = spark.range(n).select(F.lit("h.test").alias("host"), F.concat(F.lit("/d"), F.col("id") * 7 % n, F.lit("/")).alias("path"),
                                  (F.col("id") % 2 == 0).alias("allow"), (F.col("id") + 1).alias("rank"))
    urls = spark.range(n).select("id", F.concat(F.lit("http://h.test/d"), "id", F.lit("/x")).alias("normalized_url"))
    got = robots.allowed(urls, rules)
    inverse = pow(7, -1, n)
    assert {x.id: x.allowed for x in got.collect()} == {i: (i * inverse % n) % 2 == 0 for i in range(n)}
