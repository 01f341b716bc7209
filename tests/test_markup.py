"""Titles, links and visible text of broken markup: equal to the plain patterns, in
linear time."""
from __future__ import annotations

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from trawl.functions.html import decode_entities, extract_links, extract_text, extract_title

WS = "\t\n\x0b\x0c\r                  　﻿"


def plain(html):
    """The same rules as patterns over the whole page, without entities."""
    title = re.search(r"<title[^>]*>([\s\S]*?)</title>", html, re.I | re.A)
    links = [m.strip(WS) for m in re.findall(f"<a[{WS}][^>]*href[{WS}]*=[{WS}]*[\"']([^\"']*?)[\"'][^>]*>", html, re.I | re.A)]
    text = html
    for pattern in (r"<script[\s\S]*?</script>", r"<style[\s\S]*?</style>", r"<noscript[\s\S]*?</noscript>", r"<!--[\s\S]*?-->", r"<[^>]+>"):
        text = re.sub(pattern, " ", text, flags=re.I | re.A)
    text = re.sub(f"[{WS}]+", " ", text).strip(WS)
    return (title.group(1).strip(WS)[:500] if title else "", list(dict.fromkeys(x for x in links if x)), text[:100_000])


PIECES = ["<title", "<TITLE>", "</title>", "</Title>", "<script", "<script>", "</script>", "</SCRIPT>", "<style>", "</style>", "<noscript>",
          "</noscript>", "<!--", "-->", "<!-->", "<", ">", "<a ", "<a\n", "<A href='", '<a href="', "href = '", "'", '"', "x>y", " ", " ", "word", "é",
          "<p class=a>", "</p>", "</a>", "<a title='q' href='/p'>", "=", "href"]


def test_random_markup_equals_the_patterns(spark):
    r = random.Random(17)
    pages = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    rows = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").repartition(8)
    got = rows.select("i", extract_title("html"), extract_links("html"), extract_text("html")).collect()
    assert len(got) == len(pages)
    for i, title, links, text in got:
        assert (title, links, text) == plain(pages[i]), pages[i]


BROKEN = {"script": "<script ", "style": "<style>", "comment": "<!-- ", "title": "<title>", "open title": "<title ", "anchor": "<a ", "href": "<a href ",
          "quotes": "<a href='x' ", "quoted": "href='", "one anchor": " href='x'", "less": "<", "tags": "<a href='x>"}


@pytest.mark.parametrize("tail", ["", "</title></script>--><p>end</p>", "\"'"])
def test_two_mebibytes_of_broken_markup(spark, tail):
    """Each pattern's beginning 2 MiB long, without an end, and with one of all at last."""
    pages = [("<a " if k == "one anchor" else "") + v * ((2 << 20) // len(v)) + tail for k, v in BROKEN.items()]
    rows = spark.createDataFrame([(p,) for p in pages], "html string").repartition(8)
    start = time.time()
    rows.select(extract_title("html"), F.size(extract_links("html")), F.length(extract_text("html"))).collect()
    assert time.time() - start < 60


def test_numeric_entities_round_like_doubles(spark):
    cases = ["&#65;", "&#65601;", "&#9007199254740993;", "&#" + "1" * 30 + ";", "&#" + "9" * 400 + ";", "&#0065;"]

    def plain(n):
        d = float(n)
        return chr(int(d) % 65536) if d != float("inf") else "\0"

    got = [x[0] for x in spark.createDataFrame([(c,) for c in cases], "t string").select(decode_entities("t")).collect()]
    assert got == [plain(c[2:-1]) for c in cases]
