from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (SparkSession.builder.master("local[4]").appName("trawl-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trawl-test-ckpt-"))
    yield s
    s.stop()


# A closed web on two hosts (FIXTURES.md §4): a cycle (/ -> /q -> /), a
# diamond (/q reached from / and /p at equal depth), one URL in several
# spellings, skipped extensions, rejected schemes, a network-path and a
# dot-segment href, a missing page, a non-HTML page, an oversize page, a 404
# HTML page, an empty page and an entity-laden page.
def _a(*hrefs):
    return "".join(f'<a href="{h}">x</a>' for h in hrefs)


CLOSED_WEB = [
    (0, "http://a.test/", "<title>Home</title>" + _a("/p", "/q", "http://b.test/x", "/img.png", "mailto:x@y",
                                                    "//b.test/y", "../r?b=2&a=1", "#frag"),
     "text/html", 100, 200),
    (1, "http://a.test/p", "<title>P page</title>" + _a("/q", "/p/", "/missing", "/404"), "text/html", 100, 200),
    (2, "http://a.test/q", "<title>Q page</title>" + _a("/", "/s", "/p#x"), "text/html; charset=utf-8", 100, 200),
    (3, "http://a.test/r?a=1&b=2", "<title>R</title>" + _a("/s"), "text/html", 100, 200),
    (4, "http://a.test/s", "<title>S</title> shared leaf", "text/html", 100, 200),
    (5, "http://b.test/x", "<title>X</title>" + _a("/y", "http://a.test/p", "/big"), "TEXT/HTML", 100, 200),
    (6, "http://b.test/y", "<title>Y</title>" + _a("http://b.test/z", "/empty"), "text/html", 100, 200),
    (7, "http://b.test/z", "%PDF-1.4", "application/pdf", 100, 200),
    (8, "http://b.test/big", "<title>Big</title>", "text/html", 3_000_000, 200),
    (9, "http://a.test/404", "<title>Not found</title> gone", "text/html", 100, 404),
    (10, "http://b.test/empty", "", "text/html", 0, 200),
    (11, "http://a.test/ent", "<title>A &amp; B</title><script>var x='<p>';</script><style>p{}</style>"
     "<noscript>nojs</noscript><!-- hidden -->&#65;&#x42;&nbsp;&amp;lt; &copy; caf&#233;", "text/html", 100, 200),
]
CLOSED_WEB_SCHEMA = "page_id long, url string, html string, content_type string, content_length long, http_status int"


@pytest.fixture(scope="session")
def closed_web(spark):
    return spark.createDataFrame(CLOSED_WEB, CLOSED_WEB_SCHEMA)
