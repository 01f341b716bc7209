"""Quality rules with host verdicts.

Each document is measured once; rule failures are summed by host (the source
column), shrunk towards all hosts with an empirical beta prior, and the host's
rate is joined back as the prior odds of each of its documents.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import byte_slices, stored, with_text

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
# Log odds that a failed rule adds to the host's log odds. One strong rule
# rejects on an ordinary host; a weak one only on a host that fails mostly.
RULE_WEIGHTS = {"symbols": 4.0, "dup_lines": 1.0, "word_length": 1.0}
SYMBOL_PERCENT = 10      # symbols per word characters
DUP_LINE_PERCENT = 50    # repeated lines per lines with a word
WORD_LENGTH = (2, 30)    # mean word characters

_STATS = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
          ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("n_lines", pa.int64())]


def numbered(values: pa.Array) -> tuple[np.ndarray, int]:
    """A number for each value, equal values equal ones, and how many there are."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), len(coded.dictionary)


def repeated_words(docs: list[list[bytes]], width: int = WINDOW) -> np.ndarray:
    """For each list of words, how many lie in windows of `width` words (a power
    of 2) that occur twice or more in that list. Exact: words and then windows
    of 2, 4, 8 words get numbers, equal windows equal ones."""
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    n = int(lens.sum())
    if n < width:
        return np.zeros(len(docs), np.int64)
    ids, size = numbered(pa.array([w for d in docs for w in d], pa.binary()))
    step = 1
    while step < width:
        ids, size = numbered(pa.array(ids[:-step] * size + ids[step:]))
        step *= 2
    doc = np.repeat(np.arange(len(docs)), lens)
    start = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:])
    code, distinct = numbered(pa.array(ids[start] * len(docs) + doc[start]))
    again = start[np.bincount(code, minlength=distinct)[code] >= 2]
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return np.bincount(doc[np.cumsum(edge[:n]) > 0], minlength=len(docs))


def measure(texts: list[bytes | None]) -> list[np.ndarray]:
    """The columns of _STATS for some texts (null: no words)."""
    words = [(t or b"").split() for t in texts]
    out = np.zeros((len(texts), len(_STATS)), np.int64)
    for i, (t, w) in enumerate(zip(texts, words)):
        if w:
            chars = b"".join(w)
            lines = [x for x in t.split(b"\n") if x.strip()]
            out[i] = (len(w), len(chars.decode("utf-8", "replace")), len(chars) - len(chars.translate(None, SYMBOLS)),
                      len(lines) - len(set(lines)), 0, len(lines))
    out[:, 4] = repeated_words(words)
    return list(out.T)


def document_stats(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of the documents and the measures of the whole text, as struct __stats."""
    fields = [docs.schema[c] for c in columns]
    stats = [pa.field(n, t) for n, t in _STATS]

    sent, at = with_text(docs, columns)

    def run(batches):
        for b in batches:
            for i, j, texts in byte_slices(b.column(at)):
                measures = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in measure(texts)], fields=stats)
                yield pa.RecordBatch.from_arrays([b.column(k).slice(i, j - i) for k in range(len(columns))] + [measures],
                                                 names=[*columns, "__stats"])

    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
                    + [f"__stats struct<{', '.join(f'{n}: long' for n, _ in _STATS)}>"])
    return sent.mapInArrow(run, out)


def _stat(name: str) -> Column:
    return F.col(f"__stats.{name}")


def base_failed() -> Column:
    return ((_stat("n_words") < MIN_WORDS)
            | (100 * _stat("n_repeat_words") > MAX_REPEAT_PERCENT * _stat("n_words")))


def soft_rules() -> dict[str, Column]:
    return {
        "symbols": 100 * _stat("n_symbols") > SYMBOL_PERCENT * _stat("word_chars"),
        "dup_lines": 100 * _stat("n_dup_lines") > DUP_LINE_PERCENT * _stat("n_lines"),
        "word_length": (_stat("word_chars") < WORD_LENGTH[0] * _stat("n_words"))
        | (_stat("word_chars") > WORD_LENGTH[1] * _stat("n_words")),
    }


def host_rates(stats: DataFrame) -> DataFrame:
    """(host, rate): each host's share of failing documents, shrunk by a beta
    prior fitted to all hosts by moments: mean m and variance v of the hosts'
    rates give a + b = m (1 - m) / v - 1. Two aggregations, both combined on the
    map side, so a host with a third of the rows is no hot task."""
    failed = base_failed()
    for rule in soft_rules().values():
        failed = failed | rule
    by = stored(stats.groupBy("source").agg(F.count("*").alias("n"), F.sum(failed.cast("long")).alias("k")), "hosts")
    own = F.col("k") / F.col("n")
    m, v, all_k, all_n = by.agg(F.avg(own), F.var_pop(own), F.sum("k"), F.sum("n")).first()
    if not all_n:
        return by.select("source", F.lit(0.0).alias("rate"))
    m = min(max(m, 1e-6), 1 - 1e-6)
    strength = min(max(m * (1 - m) / v - 1, 1.0), 1e6) if v else 1e6
    return by.select("source", ((F.col("k") + m * strength) / (F.col("n") + strength)).alias("rate"))


def _judged(measured: DataFrame, hosts: DataFrame) -> DataFrame:
    """`measured` with __rate, __base and __kept. The hosts are one narrow row
    each: Spark broadcasts them under its size threshold, else it joins by host
    and splits a hot one."""
    t = measured.join(hosts.select(F.col("source").alias("__host"), F.col("rate").alias("__rate")),
                      measured["source"].eqNullSafe(F.col("__host")), "left").drop("__host")
    rate = F.least(F.greatest("__rate", F.lit(1e-6)), F.lit(1 - 1e-6))
    weight = sum((rule.cast("double") * RULE_WEIGHTS[name] for name, rule in soft_rules().items()), F.lit(0.0))
    rejected = base_failed() | ((weight > 0) & (F.ln(rate / (1 - rate)) + weight > 0))
    return t.withColumns({"__base": base_failed(), "__kept": ~rejected})


def quality_verdicts(docs: DataFrame) -> DataFrame:
    """One row per row of documents: doc_id, the measures, base_failed, kept, host_rate.

    base_failed rejects. Else a document is rejected if it fails a soft rule and
    the host's log odds plus the weights of its failed rules are above 0; one that
    fails no rule stays, whatever its host.

    Nulls and empty texts have no words (base_failed); a null source is a host of
    its own; a null doc_id stays null. Repeated rows count each. No rows give no
    rows; other columns are ignored."""
    measured = stored(document_stats(docs, ["doc_id", "source"]), "quality-stats")
    return _judged(measured, host_rates(measured)).select(
        "doc_id", *[_stat(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col("__base").alias("base_failed"), F.col("__kept").alias("kept"), F.col("__rate").alias("host_rate"))


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows that `quality_verdicts` keeps, with all their columns. Texts are
    measured twice, for the hosts and for the rows, and never shuffled by id."""
    hosts = host_rates(stored(document_stats(docs, ["source"]), "quality-stats"))
    return _judged(document_stats(docs, docs.columns), hosts).where("__kept").select(*docs.columns)
