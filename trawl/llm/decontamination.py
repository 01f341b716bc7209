"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

The pairs of adjacent words of the test items are counted over all documents, and
each item is sought by its rare ones. Where a document holds one, the stretch around
it is aligned with the item by words; the score is the share of a perfect copy's.

Which pairs will do: a passage of score s that matches m of n words in r runs has
r - 1 breaks of one point at least, so s <= MATCH * m - (r - 1), and m - r pairs are
intact, p = s - n - 1 or more. Whatever was edited, one of them is left when the
p - 1 commonest of the item's pairs are not looked for; pairs that no document holds
need not be looked for either, and an item with fewer than p others is in none. A
passage spans 3 * n - s words of the document at most; stretches of that width are
aligned only if they hold enough of the item's words and pairs, each counted as often
as the item has it: from m words and i pairs no score above m + i + 1 follows. So no
passage of MIN_SCORE is lost, whatever its edits; the tests hold it against the
alignment of every item with every document.

EXCERPT words of an item in a row are reported too, however long the item is. Such a
run holds the rarest pair of each stretch of its length, which are sought as well.

Test items are a stated query set. They are handled in blocks of at most
BLOCK_BYTES (measured), so what is sent to the executors at once is bounded, and
documents are never shuffled.
"""
from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trawl.llm.common import Shared, batch_of, byte_slices, with_text

GRAM = 2
MIN_SCORE = 0.6          # of a perfect copy of the item
EXCERPT = 25             # words in a row that count whatever their share of the item
MIN_WORDS = 8            # shorter items are matched as a whole only
BLOCK_BYTES = 8 << 20
MATCH, MISMATCH, GAP = 2, -1, -1


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def align(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """Best local alignment of two word-number arrays: score, and the end in `stretch`.

    Row by row; gaps along a row are a running maximum of score - GAP * column."""
    slope = -GAP * np.arange(len(stretch) + 1)
    above = np.zeros(len(stretch) + 1, np.int64)
    best, end = 0, 0
    for w in item:
        row = np.zeros_like(above)
        row[1:] = np.maximum(above[:-1] + np.where(stretch == w, MATCH, MISMATCH), above[1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + slope) - slope
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k
        above = row
    return best, end


class Seeds:
    """A block of test items, their words numbered, and where their n-grams are."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items = [(i, np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words_of(t)], np.int64))
                      for i, t in items]
        self.base = len(self.vocabulary) + 1
        self.grams = [self._grams(w) if len(w) >= MIN_WORDS else np.zeros(0, np.int64) for _, w in self.items]
        # Of each item: the least score, the least pairs of such a passage, the most words it spans.
        size = np.array([len(w) for _, w in self.items], np.int64)
        self.least = np.ceil(MIN_SCORE * MATCH * size - 1e-9).astype(np.int64)
        self.pairs = np.maximum(1, self.least - size - 1)
        self.span = 3 * size - self.least
        held = [np.unique(g, return_counts=True) for g in self.grams]
        self.held = [(g, c, *np.unique(w, return_counts=True)) for (g, c), (_, w) in zip(held, self.items)]
        self.all_grams = np.unique(np.concatenate([np.zeros(0, np.int64), *(g for g, _ in held)]))
        self.choose(np.ones(len(self.all_grams), np.int64))
        # Items too short for seeds are looked up whole, by their first word.
        self.short: dict[int, list[int]] = defaultdict(list)
        for k, (_, w) in enumerate(self.items):
            if 0 < len(w) < MIN_WORDS:
                self.short[int(w[0])].append(k)

    def choose(self, df: np.ndarray) -> Seeds:
        """Takes the rare pairs of each item as seeds, by the number of documents that
        hold each of `all_grams`."""
        rare = []
        for k, (_, words) in enumerate(self.items):
            g = self.grams[k]
            if not len(g):
                rare.append(g)
                continue
            n = df[np.searchsorted(self.all_grams, g)]
            there = n > 0
            some = np.argsort(n, kind="stable")[:len(g) - int(self.pairs[k]) + 1] if there.sum() >= self.pairs[k] else np.zeros(0, np.int64)
            if len(words) > EXCERPT and self.least[k] > MATCH * EXCERPT:
                # The rarest of each EXCERPT - 1 pairs in a row that documents hold.
                wide = np.lib.stride_tricks.sliding_window_view(n, EXCERPT - 1)
                whole = np.flatnonzero(wide.min(axis=1) > 0)
                some = np.append(some, whole + wide[whole].argmin(axis=1))
            rare.append(np.unique(g[some[there[some]]]))
        # The seeds in order, and the items that seed s stands for: owner[first[s]:first[s + 1]].
        grams, owner = np.concatenate([np.zeros(0, np.int64), *rare]), np.repeat(np.arange(len(rare)), [len(g) for g in rare])
        order = np.argsort(grams, kind="stable")
        self.owner = owner[order]
        self.seed_grams, first = np.unique(grams[order], return_index=True)
        self.first = np.append(first, len(grams))
        return self

    def _grams(self, numbers: np.ndarray) -> np.ndarray:
        """One number for each window of GRAM words; -1 where a word is in no item."""
        n = len(numbers) - GRAM + 1
        if n < 1:
            return np.zeros(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            part = numbers[k:k + n]
            out = out * self.base + part
            known &= part >= 0
        return np.where(known, out, -1)

    @staticmethod
    def _among(grams: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Places of the n-grams that are in the sorted array `wanted`."""
        at = np.flatnonzero(grams >= 0)
        if not len(at) or not len(wanted):
            return at[:0]
        own = grams[at]
        return at[wanted[np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)] == own]

    def numbers(self, text: bytes | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, -1) for w in words_of(text)], np.int64)

    def hits(self, grams: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """(item, places of its seeds in the document)."""
        at = self._among(grams, self.seed_grams)
        if not len(at):
            return []
        seed = np.searchsorted(self.seed_grams, grams[at])
        n = self.first[seed + 1] - self.first[seed]
        item = self.owner[np.arange(n.sum()) + np.repeat(self.first[seed] - np.cumsum(n) + n, n)]
        order = np.argsort(item, kind="stable")
        item, place = item[order], np.repeat(at, n)[order]
        starts = np.flatnonzero(np.diff(item, prepend=-1))
        return list(zip(item[starts].tolist(), np.split(place, starts[1:])))

    @staticmethod
    def _both(found: np.ndarray, own: np.ndarray, times: np.ndarray) -> int:
        """How many of `found` are among `own`, each as often as `times` at most."""
        at = np.searchsorted(own, found)
        at = at[own[np.minimum(at, len(own) - 1)] == found]
        return int(np.minimum(np.bincount(at, minlength=len(own)), times).sum())

    def _passage(self, k: int, numbers: np.ndarray, grams: np.ndarray, places: np.ndarray) -> tuple[int, int]:
        """The best alignment, (score, end), of the item around its seeds; (0, 0) if none can reach `least`."""
        words, span = self.items[k][1], int(self.span[k])
        pairs, pair_times, own, times = self.held[k]
        step, best = -(-span // 4), (0, 0)
        # A passage that holds the pair at p begins at most `span` words before it, in one of these steps.
        starts = places[:, None] // step - np.arange(-(-span // step) + 1)
        for lo in np.unique(np.maximum(starts, 0) * step).tolist():
            hi = min(len(numbers), lo + span + step)
            intact = self._both(grams[lo:hi - 1], pairs, pair_times)
            if intact < self.pairs[k]:
                continue
            matched = self._both(numbers[lo:hi], own, times)
            # m matches with i intact pairs are in m - i runs or more.
            if min(MATCH * matched, matched + intact + 1) >= self.least[k]:
                score, end = align(words, numbers[lo:hi])
                best = max(best, (score, -lo - end))
        return best[0], -best[1]

    def _run(self, k: int, numbers: np.ndarray, grams: np.ndarray, places: np.ndarray) -> tuple[int, int]:
        """The longest run of the item's words in a row around its seeds, and its end."""
        words, own, best = self.items[k][1], self.grams[k], (0, 0)
        for p in places.tolist():
            for j in np.flatnonzero(own == grams[p]).tolist():
                back = min(p, j)
                same = numbers[p - back:p - back + len(words) - j + back] == words[j - back:j - back + len(numbers) - p + back]
                wrong = np.flatnonzero(~same)
                left, right = wrong[wrong < back], wrong[wrong > back]
                first = int(left[-1]) + 1 if len(left) else 0
                last = int(right[0]) if len(right) else len(same)
                best = max(best, (last - first, -(p - back + last)))
        return best[0], -best[1]

    def scores(self, text: bytes | None) -> list[tuple[int | None, float, int]]:
        """(item_id, score, where the passage ends) of the items found in the text."""
        numbers = self.numbers(text)
        grams = self._grams(numbers)
        found = []
        for k, places in self.hits(grams):
            item_id, words = self.items[k]
            score, end = self._passage(k, numbers, grams, places)
            if score >= self.least[k]:
                found.append((item_id, score / (MATCH * len(words)), end))
            elif self.least[k] > MATCH * EXCERPT:
                run, end = self._run(k, numbers, grams, places)
                if run >= EXCERPT:
                    found.append((item_id, run / len(words), end))
        if self.short:
            whole: dict[int, int] = {}
            for at in np.flatnonzero(np.isin(numbers, list(self.short))).tolist():
                for k in self.short[int(numbers[at])]:
                    words = self.items[k][1]
                    if k not in whole and np.array_equal(numbers[at:at + len(words)], words):
                        whole[k] = at + len(words)
            found += [(self.items[k][0], 1.0, end) for k, end in whole.items()]
        return found


def blocks_of(items: DataFrame, limit: int = BLOCK_BYTES):
    """The items (item_id, text bytes) in blocks of at most `limit` bytes, one item at
    least. Items go to a block by a hash; the number of blocks follows from the measured size."""
    t = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL").distinct()
    total = t.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = max(1, math.ceil(2 * total / limit))
    for k in range(n):
        rows = t.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        if rows:
            yield sorted(((r[0], r[1].encode("utf-8", "replace")) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def rare_seeds(docs: DataFrame, block: list[tuple[int | None, bytes]]) -> Shared:
    """The block's seeds, chosen by the number of documents that hold each pair of its
    items: counted in each task, summed by Spark, a row for each pair of the block."""
    spark, seeds = docs.sparkSession, Seeds(block)
    sent = Shared(spark, seeds)

    def run(batches):
        s = sent.value
        held = np.zeros(len(s.all_grams), np.int64)
        for b in batches:
            for _, _, texts in byte_slices(b.column(0)):
                for t in texts:
                    grams = s._grams(s.numbers(t))
                    at = s._among(grams, s.all_grams)
                    held[np.unique(np.searchsorted(s.all_grams, grams[at]))] += 1
        at = np.flatnonzero(held)
        yield batch_of([("gram", pa.int64()), ("df", pa.int64())], at, held[at])

    df = np.zeros(len(seeds.all_grams), np.int64)
    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, df long").groupBy("gram").agg(F.sum("df").alias("df"))
    for r in counted.toLocalIterator():
        df[r["gram"]] = r["df"]
    return Shared(spark, seeds.choose(df))


def contaminated(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document row and test item found in it: doc_id, item_id,
    score (of a perfect copy's: MIN_SCORE to 1, or less for a run of EXCERPT words of
    a long item), end_word (where the first of the best passages ends).

    Words are compared with A-Z in lower case. Items are distinct rows (item_id,
    text): two texts of one id are two items. Items of fewer than MIN_WORDS words
    count only where all their words occur in a row, once for each document. Null or
    empty texts and items hold nothing; null ids stay null; repeated documents, and
    rows that share an id, each have their rows. Empty tables give no rows; other
    columns are ignored."""
    out = None
    cols = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = [("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64())]
    for block in blocks_of(items, block_bytes):
        def run(batches, seeds=rare_seeds(docs, block)):
            own = seeds.value
            for b in batches:
                for i, j, texts in byte_slices(b.column(1)):
                    rows = [(d, *f) for d, t in zip(b.column(0).slice(i, j - i).to_pylist(), texts) for f in own.scores(t)]
                    yield batch_of(schema, *([r[k] for r in rows] for k in range(4)))

        found = cols.mapInArrow(run, "doc_id long, item_id long, score double, end_word long")
        out = found if out is None else out.union(found)
    return out if out is not None else cols.select(
        "doc_id", F.lit(0).cast("long").alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("end_word")).limit(0)


def drop_contaminated(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents in which no test item is found, with all their columns."""
    names, out = docs.columns, docs
    for block in blocks_of(items, block_bytes):
        sent, at = with_text(out, names)

        def run(batches, seeds=rare_seeds(docs, block), at=at):
            own = seeds.value
            for b in batches:
                for i, j, texts in byte_slices(b.column(at)):
                    clean = [not own.scores(t) for t in texts]
                    yield b.slice(i, j - i).filter(pa.array(clean, pa.bool_())).select(names)

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
        out = sent.mapInArrow(run, schema)
    return out
