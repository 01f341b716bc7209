"""Exact ranked search with sparse ball trees.

A document is a sparse vector over the terms of the items: the weight of a term
times its integer impact in the document. An item is the vector of how often it
holds each term, and a document's score is their inner product, in integers.

The documents' vectors are stored once. Tasks take them in blocks and build a ball
tree over each: a node knows the centroid of its vectors and the radius around it.
No vector x of a node scores more than q.c + |q| r, where q counts only with the
terms that the node holds. Subtrees are taken best first, those whose bound is
below the k-th best score so far are pruned, and the vectors of a leaf are scored
in integers. Floating point enters only the bounds, which are rounded up by more
than their error, so pruning never loses a result. Each task gives its k best for
each item, and Spark ranks those.

Items are a stated query set, taken in blocks of a measured size, so that what is
sent to the executors is bounded.
"""
from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trawl.llm.common import Shared, batch_of, byte_slices, stored

TOP = 10
LEAF = 48                # vectors of a leaf
TREE = 1 << 12           # vectors of a tree, and its entries, at most (one vector at least)
ENTRIES = 1 << 20
BLOCK_BYTES = 2 << 20    # of items searched at once

# Terms of a text are runs of bytes that are an ASCII digit or letter or not ASCII.
_LETTERS = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_LETTERS).split()


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Items:
    """A block of items: their terms, numbered, and how often each item holds them."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        self.ids = [i for i, _ in rows]
        self.vocabulary: dict[bytes, int] = {}
        found = [np.unique(np.array([self.vocabulary.setdefault(t, len(self.vocabulary)) for t in terms_of(x)], np.int64),
                           return_counts=True) for _, x in rows]
        self.ends = np.cumsum([0, *(len(t) for t, _ in found)])
        self.terms, self.times = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))


def vectors(docs: DataFrame, items: Items) -> DataFrame:
    """doc_id, n (terms of the whole text) and the items' terms in it, as numbers and times."""
    vocabulary = Shared(docs.sparkSession, items.vocabulary)
    schema = [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.binary()), ("times", pa.binary())]

    def run(batches):
        get = vocabulary.value.get
        for b in batches:
            for i, j, texts in byte_slices(b.column(1)):
                ns, terms, times = [], [], []
                for t in texts:
                    words = terms_of(t)
                    k, c = np.unique(np.array([x for x in map(get, words) if x is not None], np.int32), return_counts=True)
                    ns.append(len(words))
                    terms.append(k.tobytes())
                    times.append(c.astype(np.int32).tobytes())
                yield batch_of(schema, b.column(0).slice(i, j - i), ns, terms, times)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, terms binary, times binary")


def document_counts(rows: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the `size` terms of the block."""
    def run(batches):
        held = np.zeros(size, np.int64)
        for b in batches:
            held += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), np.int32), minlength=size)
        at = np.flatnonzero(held)
        yield batch_of([("term", pa.int64()), ("df", pa.int64())], at, held[at])

    df = rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for r in df.toLocalIterator():   # the terms of one block of items
        out[r["term"]] = r["df"]
    return out


def impacts(n: int, times: np.ndarray, documents: int, terms: int) -> np.ndarray:
    m = 25 + 75 * n * documents // terms
    return (1_000_000_000 * times) // (1000 * times + 8 * m)


class Vectors:
    """Sparse integer vectors, none of them empty, over columns 0 .. width - 1."""

    def __init__(self, ends: np.ndarray, cols: np.ndarray, values: np.ndarray, width: int):
        self.ends, self.cols, self.values, self.width = ends, cols, values, width
        self.squares = np.add.reduceat(values.astype(float) ** 2, ends[:-1]) if len(cols) else np.zeros(0)

    def take(self, rows: np.ndarray) -> Vectors:
        size = self.ends[rows + 1] - self.ends[rows]
        ends = np.append(0, np.cumsum(size))
        at = np.arange(ends[-1]) + np.repeat(self.ends[rows] - ends[:-1], size)
        return Vectors(ends, self.cols[at], self.values[at], self.width)

    def dot(self, dense: np.ndarray) -> np.ndarray:
        return np.add.reduceat(self.values * dense[self.cols], self.ends[:-1])

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(self.width)
        at = slice(self.ends[row], self.ends[row + 1])
        out[self.cols[at]] = self.values[at]
        return out


class BallTree:
    """A ball tree over sparse vectors, with the bound of each node for each query."""

    def __init__(self, vectors: Vectors, queries: Vectors, leaf: int = LEAF):
        self.queries, self.leaf = queries, leaf
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray | None] = []
        self.held: list[Vectors | None] = []
        self.bounds: list[np.ndarray] = []
        self._grow(vectors, np.arange(len(vectors.ends) - 1))
        self.bounds = np.array(self.bounds)   # node, query

    def _grow(self, v: Vectors, rows: np.ndarray) -> int:
        node = len(self.children)
        for kept in (self.children, self.rows, self.held):
            kept.append(None)
        centre = np.bincount(v.cols, v.values, v.width) / len(rows)
        own = centre @ centre
        apart = v.squares - 2 * v.dot(centre) + own
        # More than the error of a sum of up to ENTRIES rounded terms.
        radius = math.sqrt(max(float(apart.max()), 0) + 1e-8 * (float(v.squares.max()) + own))
        q = self.queries
        lengths = np.sqrt(np.add.reduceat((q.values * (centre[q.cols] > 0)).astype(float) ** 2, q.ends[:-1]))
        self.bounds.append((q.dot(centre) + lengths * radius) * (1 + 1e-8) + 1)
        if len(rows) <= self.leaf:
            self.rows[node], self.held[node] = rows, v
            return node
        # Halves along the line between two vectors that are far apart.
        a = v.dense(int(apart.argmax()))
        to_a = v.dot(a)
        b = v.dense(int((v.squares - 2 * to_a).argmax()))
        order = np.argsort(v.dot(b) - to_a, kind="stable")
        half = len(order) // 2
        self.children[node] = tuple(self._grow(v.take(part), rows[part]) for part in (order[:half], order[half:]))
        return node

    def search(self, query: int, least, found) -> int:
        """Calls found(rows, scores) for leaves, best first, while a bound reaches
        least(), the least score of interest. Returns the number of leaves scored."""
        q, dense, scored = self.queries, np.zeros(self.queries.width, np.int64), 0
        at = slice(q.ends[query], q.ends[query + 1])
        dense[q.cols[at]] = q.values[at]
        heap = [(-self.bounds[0, query], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least():
                break
            if self.children[node] is None:
                found(self.rows[node], self.held[node].dot(dense))
                scored += 1
            else:
                for c in self.children[node]:
                    if self.bounds[c, query] >= least():
                        heapq.heappush(heap, (-self.bounds[c, query], c))
        return scored


class Best:
    """The `top` best (score, doc_id) of one item; of equal scores the smaller ids, ids before null."""

    def __init__(self, top: int):
        self.top, self.heap = top, []

    def least(self) -> int:
        return self.heap[0][0] if len(self.heap) == self.top else 1

    def add(self, doc_ids: list[int | None], scores: np.ndarray) -> None:
        for k in np.flatnonzero(scores >= self.least()).tolist():
            one = (int(scores[k]), doc_ids[k] is not None, -(doc_ids[k] or 0))
            if len(self.heap) < self.top:
                heapq.heappush(self.heap, one)
            elif one > self.heap[0]:
                heapq.heapreplace(self.heap, one)

    def rows(self) -> list[tuple[int | None, int]]:
        return [(-i if has else None, s) for s, has, i in self.heap]


def search_block(doc_ids: list, rows: list[tuple[np.ndarray, np.ndarray]], items: Items, best: list[Best]) -> int:
    """Searches one block of documents (terms, weighted impacts) for all items;
    returns the number of leaves scored."""
    ends = np.cumsum([0, *(len(t) for t, _ in rows)])
    terms, values = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
    known, cols = np.unique(terms, return_inverse=True)
    # The items' terms that the block holds; an item with none has no part in it.
    at = np.minimum(np.searchsorted(known, items.terms), len(known) - 1)
    here = known[at] == items.terms
    size = np.add.reduceat(np.append(here, False).astype(np.int64), items.ends[:-1]) * (np.diff(items.ends) > 0)
    asked = np.flatnonzero(size)
    if not len(asked):
        return 0
    queries = Vectors(np.append(0, np.cumsum(size[asked])), at[here], items.times[here], len(known))
    tree = BallTree(Vectors(ends, cols, values, len(known)), queries)
    scored = 0
    for k, item in enumerate(asked.tolist()):
        one = best[item]
        scored += tree.search(k, one.least, lambda r, s, one=one: one.add([doc_ids[x] for x in r.tolist()], s))
    return scored


def best_of_tasks(rows: DataFrame, items: Items, weights: np.ndarray, documents: int, terms: int, top: int) -> DataFrame:
    """(item, doc_id, score): the `top` best of each task's documents for each item."""
    sent = Shared(rows.sparkSession, (items, weights))
    schema = [("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())]

    def run(batches):
        items, weights = sent.value
        best = [Best(top) for _ in items.ids]
        ids, held, entries = [], [], 0
        for b in batches:
            for i, n, t, c in zip(*(b.column(k).to_pylist() for k in range(4))):
                t = np.frombuffer(t, np.int32)
                x = impacts(n, np.frombuffer(c, np.int32).astype(np.int64), documents, terms) * weights[t]
                if not (x > 0).any():
                    continue
                if ids and (len(ids) >= TREE or entries + len(t) > ENTRIES):
                    search_block(ids, held, items, best)
                    ids, held, entries = [], [], 0
                ids.append(i)
                held.append((t[x > 0], x[x > 0]))
                entries += len(t)
        if ids:
            search_block(ids, held, items, best)
        out = [(k, i, s) for k, one in enumerate(best) for i, s in one.rows()]
        yield batch_of(schema, *([r[k] for r in out] for k in range(3)))

    return rows.mapInArrow(run, "item long, doc_id long, score long")


def blocks_of(items: DataFrame, limit: int):
    """The items (item_id, text bytes) in blocks of about `limit` bytes by a hash; their
    number follows from the measured size."""
    t = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL").distinct()
    total = t.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(2 * total / limit))
    for k in range(n):
        rows = t.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if rows:
            yield Items(sorted(((r[0], r[1].encode("utf-8", "replace")) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The `top` highest-scoring documents with a score above 0 of each item: item_id,
    rank (from 1), doc_id, score. All documents are searched, in their whole texts.

    Equal scores go by ascending doc_id, rows without one last. A row is a document,
    so repeated rows each take a rank. Items are distinct rows (item_id, text): two
    texts of one id are ranked apart, a null item_id stays null. Null and empty texts
    hold no terms; items without terms and empty tables give no rows. Other columns
    are ignored."""
    spark, out = docs.sparkSession, None
    for block in blocks_of(items, block_bytes):
        if not len(block.terms):
            continue
        rows = stored(vectors(docs, block).where("n > 0"), "search-vectors")
        documents, terms = rows.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            break
        weights = np.array([weight(documents, int(df)) for df in document_counts(rows, len(block.vocabulary))], np.int64)
        found = best_of_tasks(rows.where("length(terms) > 0"), block, weights, documents, terms, top)
        by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
        names = spark.createDataFrame(list(enumerate(block.ids)), "item long, item_id long")
        ranked = ranked.join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.union(ranked)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
