"""Unit cases of the reference's test files, one DataFrame row per case."""
from __future__ import annotations

from pyspark.sql import functions as F

from trawl.functions import html as H
from trawl.functions import text as T
from trawl.functions import urls as U

NORMALIZE = [
    ("gopher://old.museum/1", None, None),
    ("https://orchard.test/pears?size=9&kind=conference", None, "https://orchard.test/pears?kind=conference&size=9"),
    ("plums and figs", None, None),
    ("/harvest/2020", "https://orchard.test/pears/", "https://orchard.test/harvest/2020"),
    ("https://Orchard.TEST/Pears/", None, "https://orchard.test/Pears"),
    ("http://orchard.test:80/#top", None, "http://orchard.test/"),
    ("https://orchard.test:443/quince#seeds", None, "https://orchard.test/quince"),
    ("javascript:history.back()", "https://orchard.test/", None),
    ("mailto:gardener@orchard.test", "https://orchard.test/", None),
    ("", None, None),
    ("../x/./y", "http://h.com/a/b/c", "http://h.com/a/x/y"),
    ("?q=1", "http://h.com/a/b?z=2#f", "http://h.com/a/b?q=1"),
    ("#f", "http://h.com/a/b?z=2", "http://h.com/a/b?z=2"),
    ("//Other.COM:8080/x/", "http://h.com/a", "http://other.com:8080/x"),
    ("/für", "https://h.example.org/en/1", "https://h.example.org/f%C3%BCr"),
    ("/a b", "http://h.com/", "http://h.com/a%20b"),
    ("http://h.com/p?a&b=&c=1 2", None, "http://h.com/p?a=&b=&c=1+2"),
    ("http://h.com/p?", None, "http://h.com/p"),
    ("http://h.com/p?b=1&a=2&b=0", None, "http://h.com/p?a=2&b=1&b=0"),
    ("http://h.com", None, "http://h.com/"),
    ("http://h.com/a/..", None, "http://h.com/"),
    ("rel", "http://h.com/a/b", "http://h.com/a/rel"),
    ("https://h.com:0443/x", None, "https://h.com/x"),
    ("http://h.com:99999/x", None, None),
    ("  http://h.com/x  ", None, "http://h.com/x"),
    ("http://h.com:8080/x", None, "http://h.com:8080/x"),
]


def test_normalize_url(spark):
    df = spark.createDataFrame(NORMALIZE, "raw string, base string, expected string")
    rows = df.select("raw", "expected", U.normalize_url(F.col("raw"), F.col("base")).alias("got")).collect()
    assert [r for r in rows if r.got != r.expected] == []


def test_skip_extension_and_validity(spark):
    cases = [(None, True, False), ("", True, False), ("http://orchard.test/trees/oak.htm", False, True),
             ("https://orchard.test/map.PNG?zoom=2", True, False), ("https://orchard.test/walk.mp4", True, False),
             ("gopher://old.museum", False, False), ("http://orchard.test", False, True),
             ("https://orchard.test/a.b/c", False, True)]
    df = spark.createDataFrame(cases, "u string, skip boolean, valid boolean")
    rows = df.select("skip", "valid", U.skip_by_extension(F.col("u")).alias("s"),
                     U.is_crawlable(F.col("u")).alias("c")).collect()
    for r in rows:
        assert r.s == r.skip
        assert r.c == r.valid


def test_hostname_and_url_tokens(spark):
    df = spark.createDataFrame([("http://Orchard.test:8080/winter_pruning/pear-trees?month=june",), ("::bad",)], "u string")
    rows = df.select(U.hostname(F.col("u")).alias("h"), U.url_tokens(F.col("u")).alias("t")).collect()
    assert rows[0].h == "orchard.test"
    assert {"orchard", "pear", "trees", "june"} <= set(rows[0].t)
    assert rows[1].h is None and rows[1].t == []


def test_html_title_links_text(spark):
    df = spark.createDataFrame([
        ("<title>Pears &lt; Quinces</title><h1>Fruit</h1>",),
        ("<body><h1>No heading above</h1></body>",),
        ("<head><meta charset=utf-8><title>Orchard diary</title></head>",),
        ("<nav><a class=x href='/june'>June</a> <a href=\"http://old.museum/\">Museum</a></nav>",),
        ('<a href="/july">1</a> or <a href="/july">2</a>, <a href="/july">3</a>',),
        ("<a title='t' href='?month=8'>August</a>",),
        ("<style>li{top:0}</style><li>Prune</li><script>var frost = 1;</script><li>Graft</li>",),
        ("<ul><li>One <i>ripe</i> pear</li></ul>",),
    ], "h string")
    rows = df.select(H.extract_title("h").alias("t"), H.extract_links("h").alias("l"),
                     H.extract_text("h").alias("x")).collect()
    assert [r.t for r in rows[:3]] == ["Pears < Quinces", "", "Orchard diary"]
    assert rows[3].l == ["/june", "http://old.museum/"]
    assert rows[4].l == ["/july"]
    assert rows[5].l == ["?month=8"]
    assert rows[6].x.split() == ["Prune", "Graft"]
    assert rows[7].x == "One ripe pear"


def test_entities_single_pass(spark):
    df = spark.createDataFrame([("&#65;&#x42;&amp;lt;&#38;#67; &#8364;&nbsp;x &copy;",)], "h string")
    assert df.select(H.decode_entities(F.col("h"))).first()[0] == "AB<&#67; € x &copy;"


def test_tokenize(spark):
    df = spark.createDataFrame([(None,), ("Pears, PLUMS; figs",), ("the pear is of the orchard",),
                                ("x y 42",), ("für",), ("",)], "t string")
    rows = [r[0] for r in df.select(T.tokenize(F.col("t"))).collect()]
    assert rows == [[], ["pears", "plums", "figs"], ["pear", "orchard"], ["42"], [], []]


def test_term_frequencies(spark):
    from trawl.operators.index import term_frequencies
    df = spark.createDataFrame([(1, "pear fig Pear"), (2, "fig")], "id long, t string")
    got = {(r.id, r.term): r.frequency for r in term_frequencies(df, "id", "t").collect()}
    assert got == {(1, "pear"): 2, (1, "fig"): 1, (2, "fig"): 1}


def test_fast_path_equals_full_parse(spark):
    """The code-generated rewrite for simple URLs agrees with the full parse."""
    bases = ["https://h.example.org/en/1?x=1", "http://a.test/", "http://a.test/p/q"]
    hrefs = ["/The", "/the,", "/et.", "/a/b/", "/", "/x?k=v", "/x?k=", "/x#frag", "//b.test/y",
             "HTTP://Example.com/A/", "https://h.test", "https://h.test/p?utm_source=feed#top",
             "http://h.test/a/./b", "http://h.test/a/../b", "/a/%7Euser", "/a:b@c", "/x?b=2&a=1",
             "/für", "/x\"y<z>", "/èê/ü?q=1", "http://h.test/ñ/", "/a\u00a0", "/a b"]
    rows = [(h, b) for h in hrefs for b in bases]
    df = spark.createDataFrame(rows, "raw string, base string")
    out = df.select(U.normalize_url(F.col("raw"), F.col("base")).alias("fast"),
                    U._normalized(U.url_parts(F.col("raw"), F.col("base"))).alias("full"),
                    U.url_token_text(F.col("raw")).alias("tt_fast"),
                    U._with_parts(U.url_parts(F.col("raw")), lambda g: F.when(
                        g["valid"], F.concat_ws(" ", g["host"], g["path"], g["query"]))).alias("tt_full")).collect()
    assert [r for r in out if r.fast != r.full] == []
    norm = df.select(U.normalize_url(F.col("raw"), F.col("base")).alias("u")).filter(F.col("u").isNotNull())
    facts = norm.select(U.url_token_text(F.col("u")).alias("a"),
                        U._with_parts(U.url_parts(F.col("u")), lambda g: F.when(
                            g["valid"], F.concat_ws(" ", g["host"], g["path"], g["query"]))).alias("b")).collect()
    assert [r for r in facts if r.a != r.b] == []
