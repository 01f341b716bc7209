"""Hosts and escapes of URLs, one row per case of the URL standard."""
from __future__ import annotations

import ipaddress
import random

from pyspark.sql import functions as F

from trawl.functions import urls as U
from trawl.functions.hosts import ipv6, punycode

CASES = [
    ("http://[0:0:0:0:0:0:0:1]/", "http://[::1]/"), ("http://[::1]:8080/a", "http://[::1]:8080/a"),
    ("http://[2001:DB8:0:0:1:0:0:1]/x", "http://[2001:db8::1:0:0:1]/x"), ("http://[::ffff:1.2.3.4]/", "http://[::ffff:102:304]/"),
    ("http://[::1", None), ("http://[::1]x/", None), ("http://[:::1]/", None), ("http://[1:2:3:4:5:6:7]/", None), ("http://[::1.2.3]/", None),
    ("http://[1::2::3]/", None), ("http://[::12345]/", None), ("http://[::1%25eth0]/", None), ("http://[::01.2.3.4]/", None),
    ("http://ex%41mple.com/", "http://example.com/"), ("http://ex%zzmple.com/", None), ("http://a%2Fb/", None), ("http://a%00b/", None),
    ("http://0x7f.1/", "http://127.0.0.1/"), ("http://127.1/a", "http://127.0.0.1/a"), ("http://0x7f000001/", "http://127.0.0.1/"),
    ("http://2130706433/", "http://127.0.0.1/"), ("http://0177.0.0.01/", "http://127.0.0.1/"), ("http://256.1.1.1/", None),
    ("http://1.2.3.4.5/", None), ("http://1.2.3.256/", None), ("http://4294967296/", None), ("http://1.65536.1/", None), ("http://1.2.65536/", None),
    ("http://09.1.1.1/", None), ("http://1..2/", None), ("http://1.2.3.4./", "http://1.2.3.4/"), ("http://0x/", "http://0.0.0.0/"),
    ("http://a.0x1g/", "http://a.0x1g/"), ("http://a.1/", None), ("http://1.a/", "http://1.a/"), ("http://00000000000000000000000000000001.1/", "http://1.0.0.1/"),
    ("http://bücher.de/", "http://xn--bcher-kva.de/"), ("http://BÜCHER.de/", "http://xn--bcher-kva.de/"), ("http://faß.de/", "http://xn--fa-hia.de/"),
    ("http://例え.テスト/", "http://xn--r8jz45g.xn--zckzah/"), ("http://b%C3%BCcher.de/p", "http://xn--bcher-kva.de/p"),
    ("http://ＡＢＣ。com/", "http://abc.com/"), ("http://a­b.com/", "http://ab.com/"), ("http://ΣΣ.gr/", "http://xn--4xaa.gr/"),
    ("http://１２７.1/", "http://127.0.0.1/"), ("http://ex%FFmple.com/", None), ("http://a^b.com/", None), ("http://a b.com/", None),
    ("http://h.com/?a=%20b%zz", "http://h.com/?a=+b%25zz"), ("http://h.com/?%=1&b=%4", "http://h.com/?%25=1&b=%254"),
    ("http://h.com/?q=50%&x=%C3%BC", "http://h.com/?q=50%25&x=%C3%BC"), ("http://u:p@0x7f.1:80/", "http://u:p@127.0.0.1/"),
    ("http://h.com:/x", "http://h.com/x"), ("http://:80/", None), ("http://[::1]:99999/", None)]


def test_hosts_and_escapes(spark):
    df = spark.createDataFrame(CASES, "raw string, want string")
    rows = df.select("raw", "want", U.normalize_url(F.col("raw")).alias("got")).collect()
    assert [tuple(r) for r in rows if r.got != r.want] == []


def test_hosts_of_bases_and_facts(spark):
    df = spark.createDataFrame([("/a", "http://0x7f.1/b"), ("//[0::0]/c", "http://h.com/"), ("x", "http://[::1]:81/a/b")], "raw string, base string")
    assert [r[0] for r in df.select(U.normalize_url(F.col("raw"), F.col("base"))).collect()] == [
        "http://127.0.0.1/a", "http://[::]/c", "http://[::1]:81/a/x"]
    df = spark.createDataFrame([("http://010.1/",), ("http://[1::0:0]/",), ("http://zürich.ch/",), ("http://256.1/x.1.1.1",), ("http://300.300/",)], "u string")
    assert [r[0] for r in df.select(U.hostname("u")).collect()] == ["8.0.0.1", "[1::]", "xn--zrich-kva.ch", None, None]


def test_punycode_of_random_labels(spark):
    r = random.Random(9)
    labels = ["".join(chr(r.choice([r.randrange(97, 123), r.randrange(0xDF, 0x500), r.randrange(0x4E00, 0x9FA5), r.randrange(0x1F300, 0x1F600)]))
                      for _ in range(r.randint(1, 40))) for _ in range(300)]
    df = spark.createDataFrame([(x,) for x in labels], "x string")
    assert [p for _, p in df.select("x", punycode(F.col("x"))).collect()] == [
        x.encode("punycode").decode() for x in [q[0] for q in df.collect()]]


def test_random_ipv6(spark):
    r = random.Random(4)
    rows = []
    for _ in range(400):
        p = [r.choice([0, 0, 0, r.randrange(65536)]) for _ in range(8)]
        exploded = ":".join(r.choice(["%x", "%04x", "%X"]) % v for v in p)
        rows += [(exploded, p), (str(ipaddress.IPv6Address(exploded)), p)]

    def shortest(p):
        best = max(((e - s, -s, e) for s in range(8) for e in range(s + 2, 9) if not any(p[s:e])), default=None)
        if not best:
            return ":".join("%x" % v for v in p)
        s, e = -best[1], best[2]
        return ":".join("%x" % v for v in p[:s]) + "::" + ":".join("%x" % v for v in p[e:])

    got = spark.createDataFrame([(f"[{t}]", f"[{shortest(p)}]") for t, p in rows], "h string, want string")
    assert got.select("h", "want", ipv6(F.col("h")).alias("got")).where("got IS DISTINCT FROM want").collect() == []
