"""DuckDB oracle SQL for every registered query with an SQL form.

Views `pages`, `documents`, ... are registered by the driver; each string is
one self-contained SELECT (CTEs only).
"""
from __future__ import annotations

from trawl.functions.text import tokenize_py
from trawl.plans import catalog
from trawl.plans import sqlparts as P
from trawl.sources.pages import MAX_BODY_SIZE


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(words) -> str:
    return ", ".join(_lit(w) for w in dict.fromkeys(words))


def _pages_norm_ctes() -> list[tuple[str, str]]:
    ctes = [("pg", "SELECT page_id, url, html FROM pages")]
    ctes += P.url_ctes("pg", "url", "normalized_url", None, "pn_")
    return ctes


def _docs_ctes(source: str = "pages") -> list[tuple[str, str]]:
    """page_docs: extraction + dedup by normalized_url (first id/url, last content)."""
    ctes = [("ex0", f"SELECT CAST(page_id AS BIGINT) AS page_id, url, left(html, {MAX_BODY_SIZE}) AS html "
                    f"FROM {source} WHERE html IS NOT NULL AND html <> ''"),
            ("ex", f"SELECT page_id, url, {P.title('html')} AS title, {P.body_text('html')} AS body_text FROM ex0")]
    ctes += P.url_ctes("ex", "url", "normalized_url", None, "dn_")
    ctes.append(("docs", "SELECT min(page_id) AS page_id, normalized_url, arg_min(url, page_id) AS url, "
                         "arg_max(title, page_id) AS title, arg_max(body_text, page_id) AS body_text, "
                         "CAST(length(arg_max(body_text, page_id)) AS BIGINT) AS content_length "
                         "FROM dn_6 WHERE normalized_url IS NOT NULL GROUP BY normalized_url"))
    return ctes


def _letter(term: str) -> str:
    return f"CASE WHEN regexp_matches(left({term}, 1), '^[a-z0-9]$') THEN left({term}, 1) ELSE '_' END"


def _postings_ctes(terms=None) -> list[tuple[str, str]]:
    flt = "" if terms is None else f" WHERE term IN ({_in_list(terms)})"
    raw = (f"SELECT page_id, 'title' AS field, unnest({P.tokens('title')}) AS term FROM docs "
           f"UNION ALL SELECT page_id, 'body' AS field, unnest({P.tokens('body_text')}) AS term FROM docs "
           f"UNION ALL SELECT page_id, 'url' AS field, unnest({P.url_tokens('normalized_url')}) AS term FROM docs")
    return [("post_raw", raw),
            ("post", f"SELECT page_id, field, term, CAST(count(*) AS BIGINT) AS frequency, {_letter('term')} AS letter "
                     f"FROM post_raw{flt} GROUP BY page_id, field, term")]


def _links_ctes() -> list[tuple[str, str]]:
    ctes = _docs_ctes_for_links()
    ctes.append(("lk0", f"SELECT page_id, normalized_url AS src_url, {P.links('html')} AS l FROM lsrc"))
    ctes.append(("lk1", "SELECT page_id, src_url, unnest(l) AS href, "
                        "CAST(unnest(generate_series(0, len(l) - 1)) AS BIGINT) AS pos FROM lk0 WHERE len(l) > 0"))
    ctes += P.url_ctes("lk1", "href", "dst_url", "src_url", "ln_")
    ctes.append(("links", "SELECT page_id, src_url, pos, href, dst_url, "
                          "CASE WHEN regexp_matches(href, '(?i)^https?://') THEN href ELSE dst_url END AS stored_url "
                          "FROM ln_6"))
    return ctes


def _docs_ctes_for_links() -> list[tuple[str, str]]:
    ctes = [("lx", f"SELECT CAST(page_id AS BIGINT) AS page_id, url, left(html, {MAX_BODY_SIZE}) AS html "
                   f"FROM pages WHERE html IS NOT NULL AND html <> ''")]
    ctes += P.url_ctes("lx", "url", "normalized_url", None, "lxn_")
    ctes.append(("lsrc", "SELECT * FROM lxn_6 WHERE normalized_url IS NOT NULL"))
    return ctes


def _weighted(query: str, top_k: int | None = None, first_wins: bool = False) -> str:
    toks = tokenize_py(query.strip())
    phrase = query.strip().lower().strip()
    ctes = (_streamed_ctes() if first_wins else _docs_ctes()) + _postings_ctes(toks)
    ctes.append(("m", "SELECT page_id, sum(CASE field WHEN 'title' THEN 5 * frequency WHEN 'url' THEN 2 * frequency "
                      "ELSE 0 END) AS i, sum(CASE WHEN field = 'body' THEN ln(1 + frequency) ELSE 0 END) AS l "
                      "FROM post GROUP BY page_id"))
    ctes.append(("s", f"SELECT m.page_id, d.url, d.title, floor((CAST(i AS DOUBLE) + l "
                      f"+ CASE WHEN contains(lower(d.title), {_lit(phrase)}) THEN 10 ELSE 0 END "
                      f"+ CASE WHEN contains(lower(d.body_text), {_lit(phrase)}) THEN 3 ELSE 0 END) * 100 + 0.5) / 100 "
                      f"AS score FROM m JOIN docs d USING (page_id)"))
    final = ("SELECT page_id, url AS relevant_url, url AS origin_url, CAST(0 AS BIGINT) AS depth, score, title "
             "FROM s WHERE score > 0 ORDER BY score DESC, page_id, origin_url, depth")
    if top_k:
        final += f" LIMIT {top_k}"
    return P.with_ctes(ctes, final)


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["page_title"] = f"SELECT page_id, {P.title('html')} AS title FROM pages"
    q["page_text"] = (f"WITH t AS (SELECT page_id, {P.body_text('html')} AS body_text FROM pages) "
                      f"SELECT page_id, body_text, CAST(length(body_text) AS BIGINT) AS content_length FROM t")
    q["page_links"] = (f"WITH l AS (SELECT page_id, {P.links('html')} AS l FROM pages) "
                       f"SELECT page_id, CAST(unnest(generate_series(0, len(l) - 1)) AS BIGINT) AS pos, "
                       f"unnest(l) AS href FROM l WHERE len(l) > 0")
    q["entity_decode"] = (f"WITH d AS (SELECT page_id, {P.decode('html')} AS d FROM pages) "
                          f"SELECT page_id, CAST(length(d) AS BIGINT) AS decoded_length, md5(d) AS decoded_md5 FROM d")
    q["url_normalize"] = P.with_ctes(_pages_norm_ctes(), "SELECT page_id, url, normalized_url FROM pn_6")
    q["url_resolve_links"] = P.with_ctes(
        _links_ctes(), "SELECT page_id, pos, href, dst_url, stored_url FROM links")
    q["url_skip_ext"] = P.with_ctes(
        _links_ctes(),
        "SELECT page_id, pos, dst_url, CASE WHEN dst_url IS NULL THEN NULL ELSE "
        f"regexp_extract(lower({P.url_facts('dst_url')['path']}), '(\\.[^.]*)$', 1) END AS extension, "
        f"CASE WHEN dst_url IS NULL THEN true ELSE {P.skip_ext('dst_url')} END AS skip FROM links")
    q["url_host"] = P.with_ctes(_pages_norm_ctes(),
                                f"SELECT page_id, CASE WHEN normalized_url IS NULL THEN NULL ELSE "
                                f"{P.url_facts('url')['host']} END AS host FROM pn_6")
    q["url_crawlable"] = P.with_ctes(_pages_norm_ctes(),
                                     f"SELECT page_id, coalesce(normalized_url IS NOT NULL AND NOT "
                                     f"{P.skip_ext('url')}, false) AS crawlable FROM pn_6")
    q["tokens_body"] = (f"WITH t AS (SELECT page_id, {P.tokens(P.body_text('html'))} AS t FROM pages) "
                        f"SELECT page_id, CAST(unnest(generate_series(0, len(t) - 1)) AS BIGINT) AS pos, "
                        f"unnest(t) AS token FROM t WHERE len(t) > 0")
    q["tokens_url"] = P.with_ctes(
        _pages_norm_ctes() + [("ut", f"SELECT page_id, {P.url_tokens('normalized_url')} AS t FROM pn_6 "
                                     f"WHERE normalized_url IS NOT NULL")],
        "SELECT page_id, CAST(unnest(generate_series(0, len(t) - 1)) AS BIGINT) AS pos, unnest(t) AS token "
        "FROM ut WHERE len(t) > 0")
    q["term_freq_body"] = (f"WITH t AS (SELECT page_id, unnest({P.tokens(P.body_text('html'))}) AS term FROM pages) "
                           f"SELECT page_id, term, CAST(count(*) AS BIGINT) AS frequency FROM t GROUP BY page_id, term")
    q["term_freq_docs"] = (f"WITH t AS (SELECT doc_id, unnest({P.tokens('text')}) AS term FROM documents) "
                           f"SELECT doc_id, term, CAST(count(*) AS BIGINT) AS frequency FROM t GROUP BY doc_id, term")
    q["page_upsert"] = P.with_ctes(_docs_ctes(),
                                   "SELECT page_id, normalized_url, url, title, content_length FROM docs")
    q["page_count"] = P.with_ctes(_docs_ctes(), "SELECT CAST(count(*) AS BIGINT) AS page_count FROM docs")
    q["inverted_index"] = P.with_ctes(_docs_ctes() + _postings_ctes(),
                                      "SELECT page_id, field, term, frequency, letter FROM post")
    q["search_weighted"] = _weighted(catalog.QUERY_MAIN)
    q["search_phrase"] = _weighted(catalog.QUERY_PHRASE)
    q["search_topk"] = _weighted(catalog.QUERY_MAIN, top_k=20)
    build_crawl(q)
    build_more(q)
    return q


# ------------------------------------------------------------------ crawl

def _crawl_base_ctes() -> list[tuple[str, str]]:
    """docs (+source_id), normalized pages, closure edges, jobs, seeds."""
    ctes = _docs_ctes()
    # content row of each URL: the last archive row
    ctes.append(("src_rows", "SELECT max(page_id) AS source_id, min(page_id) AS src_page_id, normalized_url AS src_url "
                             "FROM dn_6 WHERE normalized_url IS NOT NULL GROUP BY normalized_url"))
    ctes += P.url_ctes("pages", "url", "normalized_url", None, "an_")
    ctes.append(("npages", "SELECT CAST(page_id AS BIGINT) AS page_id, url, normalized_url FROM an_6"))
    ctes.append(("el0", f"SELECT s.src_url, s.src_page_id, s.source_id, {P.links('p.html')} AS l "
                        f"FROM src_rows s JOIN pages p ON p.page_id = s.source_id"))
    ctes.append(("el1", "SELECT src_url, src_page_id, source_id, unnest(l) AS href, "
                        "CAST(unnest(generate_series(0, len(l) - 1)) AS BIGINT) AS pos FROM el0 WHERE len(l) > 0"))
    ctes.append(("edges", "SELECT e.src_url, e.src_page_id, e.pos, e.href, t.normalized_url AS dst_url, "
                          "t.url AS stored_url FROM el1 e JOIN npages t ON t.page_id = "
                          "(CAST(('0x' || substr(md5(CAST(e.source_id AS VARCHAR) || '|' || e.href), 1, 15)) AS BIGINT) "
                          "% (SELECT count(*) FROM pages)) WHERE t.normalized_url IS NOT NULL"))
    host = P.url_facts("url")["host"]
    ctes.append(("jobs", f"SELECT CAST(min(page_id) AS BIGINT) AS job_id, arg_min(url, page_id) AS origin_url "
                         f"FROM npages WHERE normalized_url IS NOT NULL GROUP BY {host}"))
    ctes.append(("seeds", "SELECT min(j.job_id) AS job_id, p.normalized_url FROM jobs j "
                          "JOIN npages p ON p.page_id = j.job_id GROUP BY p.normalized_url"))
    return ctes


def _crawl_ctes(k: int, edges: str = "edges", more: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """Owner (min depth, then min job) and parent (min parent page_id, pos)
    of every URL reachable within k levels: the result of the BFS over
    `edges`, which `more` may define."""
    ctes = _crawl_base_ctes() + (more or [])
    ctes.append(("walk", f"SELECT job_id, normalized_url AS node, 0 AS depth FROM seeds "
                         f"UNION ALL SELECT w.job_id, e.dst_url, w.depth + 1 FROM walk w "
                         f"JOIN {edges} e ON e.src_url = w.node WHERE w.depth < {k}"))
    ctes.append(("dist", "SELECT node, job_id, min(depth) AS d FROM walk GROUP BY node, job_id"))
    ctes.append(("own", "SELECT node, min(job_id) AS job_id, d FROM (SELECT *, min(d) OVER (PARTITION BY node) AS md "
                        "FROM dist) WHERE d = md GROUP BY node, d"))
    ctes.append(("par", "SELECT o.node, min({'pid': e.src_page_id, 'pos': e.pos, 'src': e.src_url, "
                        f"'stored': e.stored_url}}) AS w FROM own o JOIN {edges} e ON e.dst_url = o.node "
                        "JOIN own s ON s.node = e.src_url AND s.job_id = o.job_id AND s.d = o.d - 1 "
                        "WHERE o.d > 0 GROUP BY o.node"))
    ctes.append(("disc", "SELECT o.node AS normalized_url, CASE WHEN o.d = 0 THEN j.origin_url ELSE p.w.stored END AS url, "
                         "o.job_id, j.origin_url, CAST(o.d AS BIGINT) AS depth, p.w.src AS discovered_from_url, "
                         "p.w.pid AS parent_page_id, p.w.pos AS pos, "
                         "CASE WHEN d.page_id IS NULL THEN 'failed' ELSE 'processed' END AS state, d.page_id "
                         "FROM own o JOIN jobs j ON j.job_id = o.job_id LEFT JOIN par p ON p.node = o.node "
                         "LEFT JOIN docs d ON d.normalized_url = o.node"))
    ctes.append(("pdisc", "SELECT DISTINCT page_id, job_id, origin_url, depth FROM disc "
                          "WHERE state = 'processed' AND page_id IS NOT NULL"))
    return ctes


def _shallow_ctes() -> list[tuple[str, str]]:
    """k = 1 crawl."""
    return _crawl_base_ctes() + [
        ("c1", "SELECT e.dst_url AS normalized_url, min({'job_id': s.job_id, 'pid': e.src_page_id, 'pos': e.pos, 'src': e.src_url}) AS w "
               "FROM seeds s JOIN edges e ON e.src_url = s.normalized_url GROUP BY e.dst_url"),
        ("shallow", "SELECT normalized_url, job_id, CAST(0 AS BIGINT) AS depth, 'processed' AS state FROM seeds "
                    "UNION ALL SELECT normalized_url, w.job_id, CAST(1 AS BIGINT), 'processed' FROM c1 "
                    "WHERE normalized_url NOT IN (SELECT normalized_url FROM seeds)")]


def build_crawl(q: dict[str, str]) -> None:
    from trawl.plans import derived
    k = derived.CRAWL_DEPTH
    c = _crawl_ctes(k)
    q["crawl_bfs"] = P.with_ctes(c, "SELECT normalized_url, url, job_id, depth, discovered_from_url, state, page_id "
                                    "FROM disc")
    q["crawl_multi_origin"] = P.with_ctes(c, "SELECT job_id, depth, CAST(count(*) AS BIGINT) AS urls FROM disc "
                                             "GROUP BY job_id, depth")
    q["crawl_lineage"] = P.with_ctes(
        c + [("paths", "SELECT normalized_url, job_id, depth, discovered_from_url AS anc, normalized_url AS path "
                       "FROM disc UNION ALL SELECT p.normalized_url, p.job_id, p.depth, d.discovered_from_url, "
                       "d.normalized_url || ' > ' || p.path FROM paths p JOIN disc d ON d.normalized_url = p.anc")],
        "SELECT normalized_url, job_id, depth, path FROM paths WHERE anc IS NULL")
    c1 = _crawl_ctes(1)
    q["frontier_admit"] = P.with_ctes(c1, "SELECT normalized_url, url, job_id, depth, discovered_from_url, "
                                          "parent_page_id, pos FROM disc WHERE depth = 1")
    c2 = _crawl_ctes(2)
    q["frontier_pending"] = P.with_ctes(
        c2, "SELECT d.normalized_url, d.url, d.job_id, j.origin_url, d.depth, d.discovered_from_url "
            "FROM disc d JOIN jobs j USING (job_id) WHERE d.depth = 2")
    q["frontier_count"] = P.with_ctes(c2, "SELECT CAST(count(*) AS BIGINT) AS count FROM disc WHERE depth = 2")


# ------------------------------------------------------- search over a crawl

def _search_crawl_ctes(terms=None) -> list[tuple[str, str]]:
    from trawl.plans import derived
    return _crawl_ctes(derived.CRAWL_DEPTH) + _postings_ctes(terms)


def _relevance_ctes() -> list[tuple[str, str]]:
    toks = tokenize_py(catalog.QUERY_RELEVANCE.strip().lower())
    ctes = _search_crawl_ctes(toks)
    ctes.append(("rows", "SELECT p.page_id, p.term, p.field, p.frequency, d.url, d.title, x.origin_url, x.depth "
                         "FROM post p JOIN docs d USING (page_id) JOIN pdisc x USING (page_id)"))
    ctes.append(("grp", f"SELECT url, origin_url, depth, arg_min(title, page_id) AS title, "
                        f"CAST(sum(frequency) AS BIGINT) AS frequency, bool_or(term IN ({_in_list(toks)})) AS exact_match "
                        f"FROM rows GROUP BY url, origin_url, depth"))
    ctes.append(("rel", "SELECT url, origin_url, depth, title, frequency, "
                        "CAST(10 * frequency + CASE WHEN exact_match THEN 1000 ELSE 0 END - 5 * depth AS BIGINT) "
                        "AS relevance_score, exact_match FROM grp"))
    return ctes


def build_more(q: dict[str, str]) -> None:
    from trawl.plans import derived

    # Q6/Q7: triples with discovery origin/depth
    toks = tokenize_py(catalog.QUERY_MAIN)
    phrase = catalog.QUERY_MAIN.strip().lower()
    c = _search_crawl_ctes(toks)
    c.append(("m", "SELECT page_id, sum(CASE field WHEN 'title' THEN 5 * frequency WHEN 'url' THEN 2 * frequency "
                   "ELSE 0 END) AS i, sum(CASE WHEN field = 'body' THEN ln(1 + frequency) ELSE 0 END) AS l "
                   "FROM post GROUP BY page_id"))
    c.append(("s", f"SELECT m.page_id, d.url, d.title, floor((CAST(i AS DOUBLE) + l "
                   f"+ CASE WHEN contains(lower(d.title), {_lit(phrase)}) THEN 10 ELSE 0 END "
                   f"+ CASE WHEN contains(lower(d.body_text), {_lit(phrase)}) THEN 3 ELSE 0 END) * 100 + 0.5) / 100 "
                   f"AS score FROM m JOIN docs d USING (page_id)"))
    q["search_triples"] = P.with_ctes(
        c, "SELECT s.page_id, s.url AS relevant_url, coalesce(x.origin_url, s.url) AS origin_url, "
           "coalesce(x.depth, 0) AS depth, s.score, s.title FROM s LEFT JOIN pdisc x USING (page_id) "
           "WHERE s.score > 0")

    # Q15: batch of queries = the page titles
    c = _search_crawl_ctes()
    c.append(("qs0", f"SELECT CAST(page_id AS BIGINT) AS query_id, {P.title('html')} AS query FROM pages"))
    c.append(("qs", "SELECT query_id, trim(query) AS query, trim(lower(query)) AS phrase FROM qs0 "
                    "WHERE query IS NOT NULL AND trim(query) <> ''"))
    c.append(("qt", f"SELECT DISTINCT query_id, unnest({P.tokens('query')}) AS term FROM qs"))
    c.append(("bm", "SELECT qt.query_id, p.page_id, sum(CASE p.field WHEN 'title' THEN 5 * p.frequency "
                    "WHEN 'url' THEN 2 * p.frequency ELSE 0 END) AS i, sum(CASE WHEN p.field = 'body' "
                    "THEN ln(1 + p.frequency) ELSE 0 END) AS l FROM post p JOIN qt USING (term) "
                    "GROUP BY qt.query_id, p.page_id"))
    c.append(("bs", "SELECT bm.query_id, bm.page_id, d.url, d.title, floor((CAST(i AS DOUBLE) + l "
                    "+ CASE WHEN contains(lower(d.title), qs.phrase) THEN 10 ELSE 0 END "
                    "+ CASE WHEN contains(lower(d.body_text), qs.phrase) THEN 3 ELSE 0 END) * 100 + 0.5) / 100 "
                    "AS score FROM bm JOIN docs d USING (page_id) JOIN qs USING (query_id)"))
    c.append(("bt", "SELECT bs.query_id, bs.page_id, bs.url AS relevant_url, coalesce(x.origin_url, bs.url) "
                    "AS origin_url, coalesce(x.depth, 0) AS depth, bs.score, bs.title FROM bs "
                    "LEFT JOIN pdisc x USING (page_id) WHERE bs.score > 0"))
    c.append(("br", "SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, page_id, "
                    "origin_url, depth) AS BIGINT) AS rank FROM bt"))
    q["search_batch"] = P.with_ctes(c, f"SELECT * FROM br WHERE rank <= {20}")
    q["search_stop_words"] = P.with_ctes(c, "SELECT * FROM br WHERE rank <= 1 AND query_id % 2 = 1")

    # Q9-Q13
    rc = _relevance_ctes()
    q["search_relevance"] = P.with_ctes(rc, "SELECT * FROM rel")
    q["search_relevance_terms"] = P.with_ctes(
        rc, "SELECT url, origin_url, depth, CAST(row_number() OVER (PARTITION BY url, origin_url, depth "
            "ORDER BY frequency DESC, term, field) - 1 AS BIGINT) AS term_rank, term, field, frequency FROM rows")
    q["search_by_frequency"] = P.with_ctes(
        rc, "SELECT * FROM rel ORDER BY frequency DESC, url, origin_url, depth LIMIT 20")
    q["search_page2"] = P.with_ctes(
        rc, "SELECT * FROM rel ORDER BY relevance_score DESC, url, origin_url, depth LIMIT 20 OFFSET 20")

    q["search_totals"] = P.with_ctes(
        rc, "SELECT CAST(count(*) AS BIGINT) AS total, CAST(1 AS BIGINT) AS page, CAST(20 AS BIGINT) AS page_size, "
            "CAST((count(*) + 19) // 20 AS BIGINT) AS total_pages FROM rel")

    # I2 (result equals the index of the current documents), I4
    q["index_replace"] = q["inverted_index"]
    when = "strftime(TIMESTAMP '2024-01-01' + to_seconds({}), '%Y-%m-%d %H:%M:%S')"
    refetched = _docs_ctes()[:-1] + [
        ("stored", _docs_ctes()[-1][1]),
        ("docs", "SELECT page_id, normalized_url, url, 'Later ' || title AS title, 'later ' || body_text AS body_text, "
                 f"content_length + 6 AS content_length, {when.format('page_id + 86400')} AS fetched_at FROM stored WHERE page_id % 4 = 0 "
                 "UNION ALL SELECT page_id + (SELECT max(page_id) + 1 FROM stored), 'http://later.test/p' || page_id, "
                 "'http://later.test/p' || page_id, 'Later ' || title, 'later ' || body_text, content_length + 6, "
                 f"{when.format('page_id + 86400')} FROM stored WHERE page_id % 4 = 1 "
                 f"UNION ALL SELECT page_id, normalized_url, url, title, body_text, content_length, {when.format('page_id')} "
                 "FROM stored WHERE page_id % 4 <> 0")]
    q["page_upsert_stored"] = P.with_ctes(refetched, "SELECT page_id, normalized_url, url, title, content_length, fetched_at FROM docs")
    q["index_replace_stored"] = P.with_ctes(refetched + _postings_ctes(), "SELECT page_id, field, term, frequency, letter FROM post")
    q["discovery_dedup"] = P.with_ctes(
        _crawl_ctes(derived.CRAWL_DEPTH),
        "SELECT page_id, job_id, origin_url, depth FROM pdisc WHERE depth <= 1 "
        "UNION SELECT page_id, job_id, origin_url, depth FROM pdisc")

    # From the numbers that the hosts were made of
    dotted = "(n >> 24) || '.' || ((n >> 16) % 256) || '.' || ((n >> 8) % 256) || '.' || (n % 256)"
    q["url_hosts"] = (
        "WITH b AS (SELECT page_id, (page_id * 2654435761) % 4294967296 AS n, lower(hex(page_id % 65535 + 1)) AS y FROM pages), "
        f"h AS (SELECT page_id, 0 AS case_no, {dotted} AS host, '' AS port, '/p' AS rest FROM b "
        f"UNION ALL SELECT page_id, 1, {dotted}, '', '/p' FROM b UNION ALL SELECT page_id, 2, {dotted}, '', '/p' FROM b "
        "UNION ALL SELECT page_id, 3, CASE WHEN n % 300 < 256 THEN (n % 300) || '.1.1.1' END, '', '/' FROM b "
        "UNION ALL SELECT page_id, 4, CASE WHEN n % 2 = 0 THEN '[::' || y || ']' ELSE '[::1:0:0:0:' || y || ']' END, ':81', '/' FROM b "
        "UNION ALL SELECT page_id, 5, 'p' || page_id || '.xn--bcher-kva.de', '', '/' FROM b "
        "UNION ALL SELECT page_id, 6, 'ex' || chr(CAST(97 + page_id % 15 AS INTEGER)) || 'mple.com', '', '/' FROM b "
        "UNION ALL SELECT page_id, 7, 'h.test', '', '/?a=+' || page_id || '%25zz&b=%C3%BC' FROM b) "
        "SELECT page_id, CAST(case_no AS BIGINT) AS case_no, 'http://' || host || port || rest AS normalized_url, host FROM h")

    # S2
    q["response_accept"] = (
        "WITH r AS (SELECT page_id, html, CASE regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) "
        "WHEN 'de' THEN 'application/xhtml+xml' WHEN 'fr' THEN 'application/json' ELSE CASE WHEN contains(url, '?') "
        "THEN 'TEXT/HTML; charset=UTF-8' ELSE 'text/html' END END AS content_type, "
        "CAST(strlen(html) AS BIGINT) AS content_length FROM pages), "
        "a AS (SELECT *, (contains(lower(coalesce(content_type, '')), 'text/html') OR "
        "contains(lower(coalesce(content_type, '')), 'application/xhtml+xml')) AND coalesce(content_length, 0) "
        f"<= {MAX_BODY_SIZE} AND html IS NOT NULL AND html <> '' AS accepted FROM r) "
        f"SELECT page_id, content_type, content_length, accepted, CASE WHEN accepted THEN "
        f"CAST(length(left(html, {MAX_BODY_SIZE})) AS BIGINT) END AS html_length FROM a")

    # C11 + reports over the crawl of the pages' own links
    real = _crawl_base_ctes() + [
        ("rl0", f"SELECT s.src_url, s.src_page_id, {P.links('p.html')} AS l FROM src_rows s "
                f"JOIN pages p ON p.page_id = s.source_id"),
        ("rl1", "SELECT src_url, src_page_id, unnest(l) AS href, CAST(unnest(generate_series(0, len(l) - 1)) "
                "AS BIGINT) AS pos FROM rl0 WHERE len(l) > 0")]
    real += P.url_ctes("rl1", "href", "dst_url", "src_url", "rn_")
    real += [
        ("redges", f"SELECT * FROM rn_6 WHERE dst_url IS NOT NULL AND NOT {P.skip_ext('dst_url')}"),
        ("r0", "SELECT s.normalized_url, s.job_id, CAST(0 AS BIGINT) AS depth, NULL::BIGINT AS parent_page_id, "
               "NULL::BIGINT AS pos, d.page_id FROM seeds s LEFT JOIN docs d USING (normalized_url)"),
        ("r1c", "SELECT e.dst_url AS normalized_url, min({'job_id': r0.job_id, 'pid': r0.page_id, 'pos': e.pos}) AS w "
                "FROM r0 JOIN redges e ON e.src_url = r0.normalized_url WHERE r0.page_id IS NOT NULL "
                "GROUP BY e.dst_url"),
        ("r1", "SELECT c.normalized_url, c.w.job_id AS job_id, CAST(1 AS BIGINT) AS depth, c.w.pid AS parent_page_id, "
               "c.w.pos AS pos, d.page_id FROM r1c c LEFT JOIN docs d USING (normalized_url) "
               "WHERE c.normalized_url NOT IN (SELECT normalized_url FROM r0)"),
        ("rdisc", "SELECT *, CASE WHEN page_id IS NULL THEN 'failed' ELSE 'processed' END AS state, "
                  "CASE WHEN page_id IS NULL THEN 'not in archive' END AS error_message FROM "
                  "(SELECT * FROM r0 UNION ALL SELECT * FROM r1)"),
        ("rcnt", "SELECT j.job_id, CAST(count_if(d.state IS NOT NULL AND d.state <> 'skipped') AS BIGINT) AS discovered_count, "
                 "CAST(count_if(d.state IN ('processed', 'failed')) AS BIGINT) AS processed_count, "
                 "CAST(count_if(d.state = 'processed' AND d.page_id IS NOT NULL) AS BIGINT) AS indexed_count, "
                 "CAST(count_if(d.state = 'failed') AS BIGINT) AS error_count FROM jobs j "
                 "LEFT JOIN rdisc d USING (job_id) GROUP BY j.job_id"),
        ("rc", "SELECT *, greatest(0, discovered_count - processed_count) AS queued_count FROM rcnt"),
    ]
    q["url_outcomes"] = P.with_ctes(real, "SELECT normalized_url, job_id, depth, state, error_message FROM rdisc")
    q["job_counters"] = P.with_ctes(real, "SELECT * FROM rc")
    q["job_summary"] = P.with_ctes(
        real, f"SELECT j.job_id, j.origin_url, CAST({derived.CRAWL_DEPTH} AS BIGINT) AS max_depth, "
              f"'completed' AS status, rc.* EXCLUDE (job_id) FROM jobs j JOIN rc USING (job_id)")
    q["recent_errors"] = P.with_ctes(
        real, "SELECT normalized_url, error_message, strftime(TIMESTAMP '2024-01-01' + to_seconds(job_id * 7919 % 86400 "
              "+ depth * 60 + coalesce(pos, 0) % 60), '%Y-%m-%d %H:%M:%S') AS fetched_at, depth, job_id FROM rdisc "
              "WHERE state = 'failed' ORDER BY fetched_at DESC, normalized_url DESC LIMIT 5")

    # J2/J3 over the paused crawl (level 2 admitted, not fetched)
    c2 = _crawl_ctes(2) + [("js", "SELECT j.job_id, j.origin_url, CAST(2 AS BIGINT) AS max_depth, "
                                  "CASE WHEN count_if(d.depth = 2) > 0 THEN 'running' ELSE 'completed' END AS status "
                                  "FROM jobs j LEFT JOIN disc d USING (job_id) GROUP BY ALL")]
    q["job_list"] = P.with_ctes(c2, "SELECT *, strftime(TIMESTAMP '2024-01-01' + to_seconds(job_id * 7919 % 86400), "
                                    "'%Y-%m-%d %H:%M:%S') AS created_at FROM js")
    q["jobs_active"] = P.with_ctes(c2, "SELECT job_id, origin_url, status FROM js WHERE status IN ('queued', 'running')")

    # J5/J8 over the whole depth-1 crawl; J8 reports against a capacity
    cap = catalog.BOUNDED_CAPACITY
    b = _shallow_ctes()
    q["url_state_stats"] = P.with_ctes(b, "SELECT state, CAST(count(*) AS BIGINT) AS count FROM shallow GROUP BY state")
    q["status_row"] = P.with_ctes(
        b, "SELECT CAST(count_if(b.state = 'processed') AS BIGINT) AS processed_count, "
           "CAST(count_if(b.state = 'failed') AS BIGINT) AS error_count, "
           "CAST(count_if(b.state = 'skipped') AS BIGINT) AS skipped_count, "
           "CAST(count(DISTINCT CASE WHEN b.state = 'processed' THEN d.page_id END) AS BIGINT) AS indexed_count, "
           "CAST(0 AS BIGINT) AS active_jobs, CAST(count_if(b.state = 'queued') AS BIGINT) AS queue_depth, "
           f"CAST({cap} AS BIGINT) AS max_queue_depth, count_if(b.state = 'queued') >= {cap} AS queue_saturated, "
           "CAST(count_if(b.state = 'skipped') AS BIGINT) AS dropped_urls "
           "FROM shallow b LEFT JOIN docs d USING (normalized_url)")

    # Purge the first job
    pc = _crawl_ctes(derived.CRAWL_DEPTH) + _postings_ctes() + [
        ("excl", "SELECT DISTINCT page_id FROM pdisc WHERE job_id = (SELECT min(job_id) FROM jobs) "
                 "AND page_id NOT IN (SELECT page_id FROM pdisc WHERE job_id <> (SELECT min(job_id) FROM jobs))")]
    q["purge_job_pages"] = P.with_ctes(pc, "SELECT page_id, normalized_url FROM docs "
                                           "WHERE page_id NOT IN (SELECT page_id FROM excl)")
    q["purge_job_terms"] = P.with_ctes(pc, "SELECT page_id, field, term, frequency FROM post "
                                           "WHERE page_id NOT IN (SELECT page_id FROM excl)")

    others = "WHERE job_id <> (SELECT min(job_id) FROM jobs)"
    q["purge_job_jobs"] = P.with_ctes(_crawl_base_ctes(), f"SELECT job_id, origin_url FROM jobs {others}")
    kc = _crawl_ctes(derived.CRAWL_DEPTH)
    q["purge_job_urls"] = P.with_ctes(kc, f"SELECT normalized_url, job_id, depth, state FROM disc {others}")
    q["purge_job_discoveries"] = P.with_ctes(kc, f"SELECT page_id, job_id, origin_url, depth FROM pdisc {others}")

    # S3 by key
    q["page_by_url"] = P.with_ctes(_docs_ctes(), "SELECT page_id, normalized_url, url, title, content_length FROM docs "
                                                 "WHERE normalized_url = (SELECT min(normalized_url) FROM docs)")
    q["job_by_id"] = P.with_ctes(_crawl_base_ctes(), "SELECT job_id, origin_url FROM jobs "
                                                     "WHERE job_id = (SELECT max(job_id) FROM jobs)")

    # E1-E3, S5
    ec =_search_crawl_ctes() + [
        ("ex_rows", "SELECT p.term, d.url, x.origin_url, x.depth, p.frequency, p.letter FROM post p "
                    "JOIN docs d USING (page_id) JOIN pdisc x USING (page_id)")]
    q["export_letters"] = P.with_ctes(ec, "SELECT * FROM ex_rows")
    q["export_lookup"] = P.with_ctes(ec, "SELECT term, url, origin_url, depth, frequency FROM ex_rows "
                                         f"WHERE term = {_lit(catalog.LOOKUP_TERM)}")

    # C8/C9
    host = P.url_facts("url")["host"]
    rb = _pages_norm_ctes() + [
        ("rh", f"SELECT {host} AS host, arg_min(url, page_id) AS url FROM pn_6 WHERE normalized_url IS NOT NULL "
               f"GROUP BY {host}"),
        ("rt", "SELECT host, concat_ws(chr(10), 'User-agent: *', 'Disallow: /' || regexp_extract(url, "
               "'^https?://[^/]+/([^/?#]+)/([^/?#]+)', 1) || '/', '  Allow: /' || regexp_extract(url, "
               "'^https?://[^/]+/([^/?#]+)/([^/?#]+)', 1) || '/' || regexp_extract(url, "
               "'^https?://[^/]+/([^/?#]+)/([^/?#]+)', 2), 'Disallow: /Private # keep out', "
               "'User-agent: OtherBot', 'Disallow: /') AS text FROM rh"),
        ("rl", "SELECT host, unnest(string_split(text, chr(10))) AS raw, "
               "CAST(unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) AS BIGINT) AS line FROM rt"),
        ("rlt", f"SELECT host, line, lower({P.trim_js('raw')}) AS t FROM rl"),
        ("rla", "SELECT *, CASE WHEN starts_with(t, 'user-agent:') THEN (trim(substr(t, 12)) = '*' "
                "OR contains(trim(substr(t, 12)), 'trawl')) END AS agent_flag FROM rlt"),
        ("rlr", "SELECT *, coalesce(last_value(agent_flag IGNORE NULLS) OVER (PARTITION BY host ORDER BY line "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS relevant FROM rla"),
        ("rules0", "SELECT host, line, CASE WHEN starts_with(t, 'disallow:') THEN trim(substr(t, 10)) "
                   "WHEN starts_with(t, 'allow:') THEN trim(substr(t, 7)) END AS path, starts_with(t, 'allow:') AS allow "
                   "FROM rlr WHERE relevant"),
        ("rules", "SELECT *, CAST(row_number() OVER (PARTITION BY host ORDER BY length(path) DESC, line) AS BIGINT) "
                  "AS rank FROM rules0 WHERE path IS NOT NULL AND path <> ''"),
    ]
    q["robots_rules"] = P.with_ctes(rb, "SELECT host, line, path, allow, rank FROM rules")
    f = P.url_facts("d.normalized_url")
    q["robots_allowed"] = P.with_ctes(
        _docs_ctes() + rb,
        f"SELECT d.page_id, d.normalized_url, coalesce((SELECT arg_min(r.allow, r.rank) FROM rules r "
        f"WHERE r.host = {f['host']} AND starts_with({f['path']}, r.path)), true) AS allowed FROM docs d")

    # C9 in the crawl: a blocked URL is admitted, but neither indexed nor expanded
    n = P.url_facts("n.normalized_url")
    blocked = rb + [("blk", "SELECT DISTINCT n.normalized_url AS node FROM npages n WHERE n.normalized_url IS NOT NULL "
                            "AND NOT coalesce((SELECT arg_min(r.allow, r.rank) FROM rules r "
                            f"WHERE r.host = {n['host']} AND starts_with({n['path']}, r.path)), true)"),
                    ("open_edges", "SELECT * FROM edges WHERE src_url NOT IN (SELECT node FROM blk)")]
    q["crawl_robots"] = P.with_ctes(
        _crawl_ctes(derived.CRAWL_DEPTH, "open_edges", blocked),
        "SELECT d.normalized_url, d.job_id, d.depth, CASE WHEN b.node IS NULL THEN d.state ELSE 'processed' END AS state, "
        "CASE WHEN b.node IS NULL THEN d.page_id END AS page_id, b.node IS NOT NULL AS blocked "
        "FROM disc d LEFT JOIN blk b ON b.node = d.normalized_url")

    # ST1-ST6: first fetch of each URL wins
    sc = _docs_first_ctes()
    q["stream_index"] = P.with_ctes(sc + _postings_ctes(), "SELECT page_id, field, term, frequency, letter FROM post")
    streamed = _streamed_ctes()
    q["stream_dedup"] = P.with_ctes(streamed, "SELECT normalized_url, page_id, url, title FROM docs")
    q["stream_batches"] = P.with_ctes(streamed, "SELECT CAST(count(*) AS BIGINT) AS pages, true AS several_batches, true AS bounded FROM docs")
    q["stream_search"] = _weighted(catalog.QUERY_MAIN, first_wins=True)
    q["stream_counts"] = P.with_ctes(
        _pages_norm_ctes(), f"SELECT CASE WHEN normalized_url IS NULL THEN NULL ELSE {host} END AS host, "
                            f"CAST(count(*) AS BIGINT) AS pages FROM pn_6 GROUP BY 1")


def _docs_first_ctes(source: str = "pages") -> list[tuple[str, str]]:
    ctes = _docs_ctes(source)[:-1]
    ctes.append(("docs", "SELECT min(page_id) AS page_id, normalized_url, arg_min(url, page_id) AS url, "
                         "arg_min(title, page_id) AS title, arg_min(body_text, page_id) AS body_text "
                         "FROM dn_6 WHERE normalized_url IS NOT NULL GROUP BY normalized_url"))
    return ctes


def _streamed_ctes() -> list[tuple[str, str]]:
    """All pages, then those of even id once more and the others under a new URL."""
    later = ("SELECT page_id, url, html FROM pages UNION ALL SELECT page_id + (SELECT max(page_id) + 1 FROM pages), "
             "CASE WHEN page_id % 2 = 0 THEN url ELSE 'http://later.test/p' || page_id END, "
             "replace(html, '<title>', '<title>Later ') FROM pages")
    return [("sent", later)] + _docs_first_ctes("sent")
