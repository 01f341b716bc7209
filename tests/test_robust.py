"""No input aborts a job: bad ports, long runs of spaces, endless entities."""
from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from trawl import session
from trawl.functions.html import decode_entities
from trawl.functions.urls import normalize_url


def test_bad_ports_are_null(spark):
    urls = ["http://bad.test:abc/x", "http://bad.test:99999999999/x", "http://bad.test:70000/", "http://good.test:8080/x"]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(normalize_url(F.col("u"))).collect()]
    assert got == [None, None, None, "http://good.test:8080/x"]


def test_many_spaces(spark):
    n = 100_000
    u = "  http://wide.test/a" + " " * n + "b" + " " * n
    got = spark.createDataFrame([(u,)], "u string").select(F.length(normalize_url(F.col("u")))).first()[0]
    assert got == len("http://wide.test/a") + 3 * n + 1


def test_long_entities(spark):
    text = "a&#" + "7" * 1000 + ";b&#65;"
    got = spark.createDataFrame([(text,)], "t string").select(decode_entities(F.col("t"))).first()[0]
    assert got == "a\0bA"


def test_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Session())
