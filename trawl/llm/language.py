"""Language ID by Bayesian evidence fusion.

Posterior of a row: P(host's languages) * P(text | language) * P(declared markup
language | language) * P(address suffix | language). The text model is trained
here on byte trigrams of labelled texts; what declared languages and suffixes
are worth, and the languages of hosts, are estimated from all rows by grouped
aggregation of the text posteriors. Host priors are smoothed towards their
domain, domains towards everything; a row's own share is left out of its host.
"""
from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import as_bytes, batch_of, held_out, slices, stored

BUCKETS = 1 << 16       # hashed byte trigrams
STRENGTH = 5.0          # pseudo rows with which a level is smoothed towards the one above
EFFECTIVE = 200.0       # trigrams that a text counts as at most: they are not independent
ABSENT = "-"
_TAG = re.compile(rb"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|<[^>]*>", re.S | re.I)
_DECLARED = r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})"


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte trigrams of lower-cased texts, and the number of each text."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    flat = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
    if len(flat) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(texts)), lens)
    code = (flat[:-2] << 16) | (flat[1:-1] << 8) | flat[2:]
    code = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    inside = row[:-2] == row[2:]
    return code[inside], row[:-2][inside]


def _clean(text: bytes | None, html: bool) -> bytes:
    if not text:
        return b""
    return (_TAG.sub(b" ", text) if html else text).lower()


def train(labelled: DataFrame) -> tuple[list[str], np.ndarray]:
    """(text, lang) -> languages and log P(trigram | language). Counts of all rows
    are summed in the tasks and by Spark; BUCKETS rows for each language remain."""
    schema = [("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())]

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = as_bytes(b.column(0)), b.column(1).to_pylist()
            for i, j in slices(texts):
                for lang in set(langs[i:j]):
                    code, _ = trigrams([_clean(t, False) for t, x in zip(texts[i:j], langs[i:j]) if x == lang])
                    total.setdefault(lang, np.zeros(BUCKETS, np.int64))
                    total[lang] += np.bincount(code, minlength=BUCKETS)
        for lang, counts in total.items():
            at = np.flatnonzero(counts)
            yield batch_of(schema, [lang] * len(at), at, counts[at])

    rows = (labelled.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang IS NOT NULL")
            .mapInArrow(run, "lang string, bucket long, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows["lang"].unique())
    counts = np.full((len(langs), BUCKETS), 0.5)
    if len(rows):
        counts[[langs.index(x) for x in rows["lang"]], rows["bucket"].to_numpy()] += rows["n"].to_numpy()
    return langs, np.log(counts / counts.sum(axis=1, keepdims=True)) if langs else counts


def text_posteriors(rows: DataFrame, langs: list[str], model: np.ndarray, html: bool) -> DataFrame:
    """All columns but text, and loglik: the tempered log likelihood of the whole
    text in each language (all 0 for a text under 3 bytes)."""
    names = [c for c in rows.columns if c != "text"]
    table = np.ascontiguousarray(model.T)

    def run(batches):
        for b in batches:
            texts = as_bytes(b.column(len(names)))
            for i, j in slices(texts, 1 << 20):
                code, row = trigrams([_clean(t, html) for t in texts[i:j]])
                sums = np.stack([np.bincount(row, table[code, k], j - i) for k in range(len(langs))], axis=1)
                sums = sums.astype(float)   # without any trigram the counts are whole numbers
                n = np.maximum(np.bincount(row, minlength=j - i), 1)
                sums *= np.minimum(1.0, EFFECTIVE / n)[:, None]
                sums -= sums.max(axis=1, keepdims=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(len(names))] + [pa.array(sums.tolist(), pa.list_(pa.float64()))],
                    names=[*names, "loglik"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    return rows.select(*names, "text").mapInArrow(run, schema + ", loglik array<double>")


def _softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    e = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def fuse(rows: DataFrame, langs: list[str]) -> DataFrame:
    """rows with declared, suffix, host, domain and loglik -> plus lang, confidence, posterior."""
    k = range(len(langs))
    t = stored(rows.withColumn("own", _softmax(F.col("loglik"))), "lang-rows")
    sums = [F.sum(F.col("own")[i]).alias(f"s{i}") for i in k]
    total = t.agg(F.count("*").alias("n"), *sums).first()
    share = [((total[f"s{i}"] or 0.0) + 1.0) / (total["n"] + len(langs)) for i in k]

    def likelihood(name: str) -> DataFrame:
        """log P(value | language) for each value of a column, smoothed by the value's frequency."""
        n = F.col("n") / F.lit(float(max(total["n"], 1)))
        g = t.groupBy(name).agg(F.count("*").alias("n"), *sums)
        return g.select(F.col(name).alias(f"v_{name}"), F.array(*[
            F.ln((F.col(f"s{i}") + STRENGTH * n) / F.lit((total[f"s{i}"] or 0.0) + STRENGTH)) for i in k]).alias(f"l_{name}"))

    # Hosts towards domains, domains towards all rows.
    domain = t.groupBy("domain").agg(F.count("*").alias("n"), *sums)
    domain = domain.select(F.col("domain").alias("v_domain"), F.array(*[
        (F.col(f"s{i}") + STRENGTH * share[i]) / (F.col("n") + STRENGTH) for i in k]).alias("p_domain"))
    host = t.groupBy("host", "domain").agg(F.count("*").alias("n"), F.array(*sums).alias("p_host"))
    host = host.join(domain, F.col("domain") == F.col("v_domain")).select(
        F.col("host").alias("v_host"), F.col("domain").alias("vv_domain"), F.col("n").alias("n_host"), "p_host", "p_domain")
    out = (t.join(likelihood("declared"), F.col("declared") == F.col("v_declared"))
           .join(likelihood("suffix"), F.col("suffix") == F.col("v_suffix"))
           .join(host, (F.col("host") == F.col("v_host")) & (F.col("domain") == F.col("vv_domain"))))
    # The row itself is left out of its host.
    prior = [F.ln((F.greatest(F.col("p_host")[i] - F.col("own")[i], F.lit(0.0)) + STRENGTH * F.col("p_domain")[i])
                  / (F.col("n_host") - 1 + STRENGTH)) for i in k]
    logs = F.array(*[F.col("loglik")[i] + prior[i] + F.col("l_declared")[i] + F.col("l_suffix")[i] for i in k])
    out = out.withColumn("posterior", _softmax(logs)).withColumn("confidence", F.array_max("posterior"))
    named = F.element_at(F.array(*map(F.lit, langs)), F.array_position("posterior", F.col("confidence")).cast("int"))
    return out.withColumn("lang", named)


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """One row per row of both tables: doc_id or page_id (the other null), lang,
    confidence (its posterior), text_lang (by the text alone), held_out.

    Labels of documents are learned only from rows that are not held out. A
    document's host is its source; it declares no language and has no suffix. A
    page's host, suffix and domain come from its URL, its declared language from
    its html tag.

    Null and empty texts have even likelihoods and follow the other evidence;
    nulls and values that aren't there are one value of their own. Equal
    posteriors go to the first language by name. Repeated rows count each. With
    no labels there is no language and lang is null. Other columns are ignored."""
    labelled = docs.where(~held_out(F.col("doc_id"))).select("text", "lang")
    langs, model = train(labelled)
    none = F.lit(None).cast("long")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), none.alias("page_id"), F.lit(ABSENT).alias("declared"),
                    F.lit(ABSENT).alias("suffix"), F.coalesce("source", F.lit(ABSENT)).alias("host"),
                    F.lit(ABSENT).alias("domain"), F.col("text").cast("string").alias("text"))
    name = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    host = F.when(name == "", F.lit(ABSENT)).otherwise(name)
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), _DECLARED, 1))
    p = pages.select(none.alias("doc_id"), F.col("page_id").cast("long").alias("page_id"),
                     F.when(declared == "", F.lit(ABSENT)).otherwise(declared).alias("declared"),
                     F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"),
                     F.substring_index(host, ".", -2).alias("domain"), F.col("html").cast("string").alias("text"))
    if not langs:
        empty = d.drop("text").union(p.drop("text"))
        return empty.select("doc_id", "page_id", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("confidence"),
                            F.lit(None).cast("string").alias("text_lang"), held_out(F.col("doc_id")).alias("held_out"))
    scored = text_posteriors(d, langs, model, False).union(text_posteriors(p, langs, model, True))
    out = fuse(scored, langs)
    alone = F.element_at(F.array(*map(F.lit, langs)), F.array_position("own", F.array_max("own")).cast("int"))
    return out.select("doc_id", "page_id", "lang", "confidence", alone.alias("text_lang"),
                      F.coalesce(F.col("doc_id").isNotNull() & held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
