"""Quality classifier by co-training.

Two views of a page: its text's content, and its metadata. Each has a logistic
regression. In rounds, each view labels the rows of an unlabelled pool that it
is sure of, and the other view trains on them. At the end each view is
calibrated on labelled rows kept aside, and the calibrated views are combined.
"""
from __future__ import annotations

import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import batch_of, held_out, stored
from trawl.llm.logistic import Logistic
from trawl.llm.toxicity import labelled_sample, one_row_each

LABELLED = 10_000       # labelled rows that are used, at most
POOL = 10_000           # unlabelled rows that get pseudo-labels, at most
ROUNDS = 4
SURE = 0.95             # confidence of a pseudo-label
PER_ROUND = 2_000       # pseudo-labels that a view gives in a round, at most
PSEUDO_WEIGHT = 0.3
CALIBRATION = 4         # every 4th labelled row is kept for calibration
_HASHED = 16
_SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()-]")
_STOPS = re.compile(r"[.,;:!?]")


def text_view(text: str | None) -> list[float]:
    """Content of the whole text: lengths, characters, repetition."""
    t = text or ""
    words = t.split()
    n, chars = len(words), len(t)
    lines = [x for x in t.split("\n") if x.strip()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    ratio = lambda a, b: a / b if b else 0.0
    return [
        np.log1p(n), ratio(sum(map(len, words)), n), ratio(len(counts), n), ratio(max(counts.values(), default=0), n),
        ratio(len(_SYMBOLS.findall(t)), chars), ratio(t.count("|"), n), ratio(t.count("!"), n), ratio(len(_STOPS.findall(t)), n),
        ratio(sum(map(str.isupper, t)), chars), ratio(sum(map(str.isdigit, t)), chars),
        ratio(len(lines) - len(set(lines)), len(lines)), ratio(n, len(lines)), np.log1p(len(lines)),
        ratio(sum(a == b for a, b in zip(words, words[1:])), n), ratio(sum(w.isupper() for w in words), n),
        ratio(t.count("http") + t.count("@"), n),
    ]


def meta_view(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """Metadata of the page: its source and language (hashed) and its declared length."""
    out = [0.0] * (2 * _HASHED)
    out[crc32((source or "").encode()) % _HASHED] = 1.0
    out[_HASHED + crc32((lang or "").encode()) % _HASHED] = 1.0
    n = np.log1p(max(n_chars or 0, 0))
    return [*out, float(n), float(n * n / 10), float(n_chars is None)]


TEXT, META = 16, 2 * _HASHED + 3
_VIEW = [("source", "string"), ("lang", "string"), ("n_chars", "long")]


def _views(b: pa.RecordBatch, at: int) -> tuple[list, list]:
    """Both views of a batch whose text and metadata start at column `at`."""
    text, source, lang, n_chars = (b.column(at + k).to_pylist() for k in range(4))
    return [text_view(t) for t in text], [meta_view(*m) for m in zip(source, lang, n_chars)]


def _loss(p: np.ndarray, y: np.ndarray) -> float:
    return float(-np.mean(np.log(np.where(y == 1, p, 1 - p)))) if len(y) else np.inf


def co_train(x: tuple[np.ndarray, np.ndarray], y: np.ndarray, pool: tuple[np.ndarray, np.ndarray],
             aside: tuple[np.ndarray, np.ndarray], y_aside: np.ndarray, rounds: int = ROUNDS):
    """A model of each view after the rounds. A view gives labels only while it
    tells the rows kept aside better than the labels' share does."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    plain = _loss(np.full(len(y_aside), share), y_aside)
    given = [np.full(len(pool[0]), np.nan), np.full(len(pool[0]), np.nan)]   # labels given to each view

    def fit(v: int) -> Logistic:
        use = ~np.isnan(given[v])
        return Logistic().fit(np.vstack([x[v], pool[v][use]]), np.concatenate([y, given[v][use]]),
                              np.concatenate([np.ones(len(y)), np.full(use.sum(), PSEUDO_WEIGHT)]))

    models = [fit(0), fit(1)]
    for _ in range(rounds):
        for v in (0, 1):
            if not len(pool[v]) or _loss(models[v].predict(aside[v]), y_aside) >= plain:
                continue
            p = models[v].predict(pool[v])
            sure = np.flatnonzero((np.maximum(p, 1 - p) >= SURE) & np.isnan(given[1 - v]))
            sure = sure[np.argsort(-np.maximum(p, 1 - p)[sure], kind="stable")][:PER_ROUND]
            given[1 - v][sure] = (p[sure] >= 0.5).astype(float)
        models = [fit(0), fit(1)]
    return models


def combine(models, x) -> np.ndarray:
    return np.stack([m.logit(v) for m, v in zip(models, x)], axis=1)


def classify(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> DataFrame:
    """One row per row of documents: doc_id, held_out, text_score, meta_score,
    score (probability of quality 1), predicted, kept (score of 0.5 or more).

    Whole texts are read; labels come only from rows that are not held out.
    Nulls are values of their own in the metadata view, null and empty texts have
    zeros in the text view; a null doc_id is never labelled; repeated rows score
    alike; of several labels the highest counts. Without labels of both kinds the
    score is the labels' share (0.5 without any). No rows give no rows; other
    columns are ignored."""
    meta = [F.col(c).cast(kind).alias(c) for c, kind in _VIEW]
    picked = labelled_sample(docs.select("doc_id", "text"), labels, "quality", labelled).select("doc_id", "y")
    others = (docs.join(labels.select(F.col("doc_id").cast("long").alias("known")).distinct(),
                        F.col("doc_id").cast("long") == F.col("known"), "left_anti")
              .where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("y", F.lit(None).cast("int"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(pool))
    # Ids are bounded by the two parameters, so they are broadcast, and each has one row of the sample.
    ids = stored(picked.union(others), "quality-ids").withColumnRenamed("doc_id", "id")
    view = ["text", *(c for c, _ in _VIEW)]
    sample = one_row_each(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"), *meta)
                          .join(F.broadcast(ids), "id"), view).select("id", "y", *view)

    def features(batches):
        schema = [("id", pa.int64()), ("y", pa.int32()), ("t", pa.list_(pa.float64())), ("m", pa.list_(pa.float64()))]
        for b in batches:
            yield batch_of(schema, b.column(0), b.column(1), *_views(b, 2))

    rows = sample.mapInArrow(features, "id long, y int, t array<double>, m array<double>").toPandas()
    rows = rows.sort_values("id", kind="stable")
    t, m = (np.array(rows[c].tolist()).reshape(len(rows), k) for c, k in (("t", TEXT), ("m", META)))
    y = rows["y"].to_numpy(dtype=float)
    known = ~np.isnan(y)
    aside = known & (np.cumsum(known) % CALIBRATION == 0)
    train = known & ~aside
    models = co_train((t[train], m[train]), y[train], (t[~known], m[~known]), (t[aside], m[aside]), y[aside])
    # Each view's log odds are scaled on the rows kept aside, then both are weighed together.
    final = Logistic(penalty=0.1).fit(combine(models, (t[aside], m[aside])), y[aside])
    calibrated = [Logistic(penalty=0.1).fit(mod.logit(v[aside])[:, None], y[aside]) for mod, v in zip(models, (t, m))]
    schema = [("doc_id", pa.int64()), ("text_score", pa.float64()), ("meta_score", pa.float64()), ("score", pa.float64())]

    def score(batches):
        for b in batches:
            tv, mv = _views(b, 1)
            x = (np.array(tv).reshape(b.num_rows, TEXT), np.array(mv).reshape(b.num_rows, META))
            own = [c.predict(mod.logit(v)[:, None]) for c, mod, v in zip(calibrated, models, x)]
            yield batch_of(schema, b.column(0), *own, final.predict(combine(models, x)))

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *meta).mapInArrow(
        score, "doc_id long, text_score double, meta_score double, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text_score", "meta_score", "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), (F.col("score") >= 0.5).alias("kept"))
